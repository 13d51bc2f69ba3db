"""Texts that were cut off by a field limit or lost their end in transfer.

Three kinds of evidence, from sure to statistical:

* structure: a stack automaton reads the text to its end and reports unclosed quotes, brackets, braces and
  markup, a broken character, or an escape or tag that stops half-way. What counts is held against the habits of
  the source: what may be half an escape or not, as a percent sign, is evidence only where that kind of escape is in
  use, and a sign left open after a full stop only where the source hardly ever leaves one open;
* the source's baseline: a length at which the unterminated texts of a source pile up, and beyond
  which it has none, is its field limit (in characters or bytes, with or without a mark at the cut);
* the ending: a text without a terminator is compared with how the same characters go on elsewhere.
  After its last characters the corpus either ends a sentence (then only the full stop is missing, or
  it is a title) or goes on (then the text was cut).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

from .lookalike import plain_points

#: Lengths of the contexts before an ending, longest first; 0 stands for the whole sentence so far.
CONTEXTS = (0, 32, 24, 18, 14, 11, 9, 8, 7, 6, 5, 4, 3)
#: Occurrences that make a context count: of 5 characters or more, and of fewer. The longest that counts decides.
EVIDENCE = (1, 3)
#: Bits per context asked about, of the filter by which others are skipped; a full filter costs time, no result.
FILTER_SHARE = 16
#: Contexts that one filter serves: its 32 MB are what a broadcast may hold. More are served block by block of their hashes.
BLOCK_CONTEXTS = 1 << 24
#: Unterminated texts of one length that make a field limit, at least.
LEAST_PILE = 4
#: Share of the terminated texts with an opening sign that may leave it open for that to be unusual.
OPEN_SHARE = 0.05

_OPEN = {"(": ")", "（": "）", "[": "]", "［": "］", "{": "}", "「": "」", "『": "』", "【": "】", "〔": "〕", "《": "》", "«": "»", "“": "”", "‘": "’", "¿": "?", "¡": "!"}
_CLOSE = frozenset(_OPEN.values())
_SIGN = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?(/?)>|[\"" + re.escape("".join(_OPEN) + "".join(sorted(_CLOSE))) + "]")
_OPENING = re.compile(r"[\"<(（\[［{「『【〔《«“‘]")
# Elements that need no end tag.
_NO_END = frozenset("area base br col embed hr img input link meta source track wbr p li dt dd td th tr option".split())
#: Kinds of escape and markup: the sign each begins with, what a whole one looks like, half of one at the end of a text where
#: the kind is in use, and half of one that is nothing else anywhere (null: there is none).
ESCAPES = {
    "entity": ("&", r"&#?[A-Za-z0-9]+;", re.compile(r"&#?[A-Za-z0-9]*"), re.compile(r"&(?:#[xX]?[0-9A-Fa-f]*|am?p?|lt|gt|qu?o?t?|ap?o?s?|nb?s?p?)(?<=[a-z#0-9A-F]{2})")),
    "backslash": ("\\", r"\\(?:u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|[nrt\"'/\\])", re.compile(r"\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?"), re.compile(r"\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)")),
    "percent": ("%", r"%[0-9A-Fa-f]{2}", re.compile(r"%[0-9A-Fa-f]?"), None),
    "tag": ("<", r"</?[A-Za-z][^<>]*>", re.compile(r"<(?:/?[A-Za-z][^<>]*)?"), re.compile(r"</?[A-Za-z][A-Za-z0-9]*|</|<[A-Za-z][A-Za-z0-9]*\s+[A-Za-z\-]+=[^<>]*")),
}
_MARK = re.compile(r"\s*(?:\[(?:…|\.\.\.)\]|\((?:…|\.\.\.)\)|…+|\.{2,}|>>>?|\+)\s*$")
_TERMINATOR = "[.!?。！？…—♪♥]"
_CLOSER = "[\"'”’」』)）\\]］】»〉》〕]"
#: An apostrophe closes a text after a terminator only: elsewhere it stands inside a word.
_END = re.compile(rf"{_TERMINATOR}+{_CLOSER}*\s*$|(?!['’]){_CLOSER}\s*$")
_SENTENCE = re.compile(r"([.!?。！？…—]+)")
_SOFT = re.compile(r"…|\.{2,}")
#: What follows a context: the end of a sentence, the end without a terminator, more text, nothing to count, the end with an ellipsis.
_CLOSED, _STOPS, _GOES_ON, _IGNORED, _SOFTLY = range(5)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Ending:
    """What the automaton saw: `broken` is sure evidence, `unclosed` the signs still open, `terminated` a regular end."""

    broken: bool
    unclosed: str
    terminated: bool


def read_ending(text: str, escapes: frozenset[str] = frozenset()) -> Ending:
    """Reads the signs of the whole text with a stack of those still open. escapes: the kinds that are in use where the text comes from."""
    stack: list[str] = []
    for found in _SIGN.finditer(text):
        char = found[0]
        if char[0] == "<":
            ends, name, empty = found[1], found[2].lower(), found[3]
            if ends:
                _pop(stack, f"<{name}")
            elif not empty and name not in _NO_END:
                stack.append(f"<{name}")
        elif char == '"':
            if '"' in stack:
                _pop(stack, char)
            elif not text[: found.start()][-1:].isdigit():  # inches
                stack.append(char)
        elif char in _OPEN:
            stack.append(char)
        else:
            for k in range(len(stack) - 1, -1, -1):
                if _OPEN.get(stack[k]) == char:
                    del stack[k:]
                    break
    body = text.rstrip()
    broken = body.endswith("\ufffd") or any(_ends_in_half(body, kind, kind in escapes) for kind in ESCAPES)
    return Ending(broken, "".join(c[0] for c in stack), bool(_END.search(text)))


def _pop(stack: list[str], opened: str) -> None:
    if opened in stack:
        del stack[len(stack) - 1 - stack[::-1].index(opened) :]


def _ends_in_half(body: str, kind: str, in_use: bool) -> bool:
    sign, _, half, sure = ESCAPES[kind]
    at = body.rfind(sign)
    return at >= 0 and any(p is not None and p.fullmatch(body, at) for p in (sure, half if in_use else None))


def capture_source(column):
    """The part of source_file before the first slash; null where there is none."""
    return F.when(F.instr(column, "/") > 1, F.substring_index(column, "/", 1))


def field_limits(events: DataFrame) -> DataFrame:
    """(source, unit, n): the field limit of each source that has one; unit is `chars` or `bytes`.

    Per source the lengths of the texts that do not end with a firm terminator are counted. A limit is a
    length at which they pile up (five times the usual number around it) and beyond which the source has
    hardly any text.
    """
    firm = F.col("text").rlike(r"[.!?。！？—]+[\"'”’」』)）\]］】»]*$") & ~F.col("text").rlike(r"\.{2,}$")
    sized = events.filter("source is not null and text is not null and text <> ''").select(
        "source", F.when(firm, 0).otherwise(1).alias("open"),
        F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.char_length("text").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.octet_length("text").alias("n")))).alias("m"))
    counts = sized.groupBy("source", "m.unit", "m.n").agg(F.sum("open").alias("open"), F.count("*").alias("all"))
    by = Window.partitionBy("source", "unit")
    near = by.orderBy("n").rangeBetween(-8, 8)
    beyond = by.orderBy("n").rangeBetween(4, Window.unboundedFollowing)
    marked = counts.withColumns({
        "around": (F.sum("open").over(near) - F.col("open")) / 16, "beyond": F.coalesce(F.sum("all").over(beyond), F.lit(0)), "total": F.sum("all").over(by)})
    found = marked.filter((F.col("open") >= LEAST_PILE) & (F.col("open") >= 5 * F.col("around")) & (F.col("beyond") <= 0.002 * F.col("total") + 0.02 * F.col("open")))
    best = F.struct("open", F.when(F.col("unit") == "chars", 1).otherwise(0).alias("chars"), "n")
    return found.groupBy("source").agg(F.max_by(F.struct("unit", "n"), best).alias("m")).select("source", "m.unit", "m.n")


def source_habits(events: DataFrame) -> DataFrame:
    """(source, escapes array<string>, closes): the kinds of escape that each source uses, those that are whole more often than their
    sign stands alone; and whether it hardly ever leaves a sign open in a text that ends with a terminator."""
    text = F.col("text")
    whole = {k: F.when(F.contains(text, F.lit(sign)), F.regexp_count(text, F.lit(pattern))) for k, (sign, pattern, _, _) in ESCAPES.items()}
    signs = {k: F.when(F.contains(text, F.lit(sign)), F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))) for k, (sign, *_) in ESCAPES.items()}
    pairs = [(a, b) for a, b in _OPEN.items() if a not in "¿¡"]
    opening = text.rlike("[" + re.escape("".join(a for a, _ in pairs)) + "]")
    times = lambda c: F.char_length(text) - F.char_length(F.replace(text, F.lit(c), F.lit("")))
    left = F.lit(False)
    for a, b in pairs:
        left = left | (times(a) > times(b))
    ended = text.rlike(_TERMINATOR + _CLOSER + "*$")
    counts = events.filter("text is not null").groupBy("source").agg(
        *[F.sum(c).alias(f"{k}_whole") for k, c in whole.items()], *[F.sum(c).alias(f"{k}_signs") for k, c in signs.items()],
        F.count_if(opening & ended).alias("opening"), F.count_if(F.when(opening & ended, left).otherwise(False)).alias("left"))
    used = F.array_compact(F.array(*[F.when(2 * F.col(f"{k}_whole") > F.col(f"{k}_signs"), k) for k in ESCAPES]))
    return counts.select("source", used.alias("escapes"), (F.col("left") <= OPEN_SHARE * F.col("opening")).alias("closes"))


@lru_cache(maxsize=200_000)
def _folded(sentence: str) -> str:
    """Spaces, digits and characters in one form. Case stays, since titles differ by it, but for shouted sentences."""
    plain = re.sub(r"\d+", "0", " ".join(plain_points(sentence).split()))
    return plain.capitalize() if len(plain) > 6 and plain.isupper() else plain


def _split(text: str) -> tuple[list[tuple[str, int]], str]:
    """The closed sentences of a text with how they end, and its unclosed tail, folded for comparison."""
    parts = _SENTENCE.split(text)
    closed = [(_folded(p), _SOFTLY if _SOFT.search(e) else _CLOSED) for p, e in zip(parts[:-1:2], parts[1::2])]
    return [c for c in closed if c[0]], _folded(parts[-1])


def _tail(text: str) -> str:
    """The last sentence without a mark at its end."""
    return _split(_MARK.sub("", text))[1]


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, np.uint64(base))), dtype=np.uint64)


def _hashes(sentences: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each context (rows) that ends at each character (columns) of all sentences, 0 where the
    sentence is too short; the number of each character's sentence; whether it is its last one."""
    marked = ["\x02" + s for s in sentences]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    owner = np.repeat(np.arange(len(marked)), size)
    first = np.repeat(np.cumsum(size) - size, size)
    at = np.arange(len(points))
    place = at - first
    power, inverse = _powers(_BASE, int(size.max())), _powers(_INVERSE, int(size.max()))
    # running sums of point * base^place, modulo 2^64; a difference times base^-start no longer depends on the place
    total = np.cumsum((points * np.uint64(0x2545F4914F6CDD1D) + np.uint64(1)) * power[place], dtype=np.uint64)
    whole = total - np.where(first > 0, total[first - 1], np.uint64(0))
    out = np.zeros((len(CONTEXTS), len(points)), dtype=np.uint64)
    for row, k in enumerate(CONTEXTS):
        if k == 0:
            span, known = whole, place > 0
        else:
            start = np.maximum(at - k, 0)
            known = place >= k
            span = (whole - whole[start]) * inverse[np.where(known, place - k + 1, 0)]
        span = (span ^ (span >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(row * 2 + 1)
        span ^= span >> np.uint64(29)
        out[row] = np.where(known, span | np.uint64(1), np.uint64(0))
    return out, owner, np.append(owner[1:] != owner[:-1], True)


@dataclass
class _Sources:
    """What the corpus says about its sources: limits, kinds of escape in use, and which ones close what they open."""

    of: dict[str, tuple[str, int]]
    escapes: dict[str | None, frozenset[str]] = field(default_factory=dict)
    closes: frozenset[str | None] = frozenset()

    def at(self, source: str | None, text: str) -> bool:
        """The text has exactly the length of its source's limit; of any source's if it names none."""
        if isinstance(source, str):
            limit = self.of.get(source)
            return limit is not None and (len(text) if limit[0] == "chars" else len(text.encode("utf-8", "replace"))) == limit[1]
        return any(self.at(s, text) for s in self.of)


_NONE: frozenset[str] = frozenset()


def _judge(source: str | None, text: str, sources: _Sources) -> str:
    """`whole`, `broken`, `limit`, or `ask` where the ending has to be compared with the corpus."""
    if text[-1] in ".!?。！？" and text[-2:-1] != "." and not _OPENING.search(text):
        return "whole"  # what reading it to the end would say, too
    source = source if isinstance(source, str) else None
    ending = read_ending(text, sources.escapes.get(source, _NONE))
    if ending.broken:
        return "broken"
    marked = bool(_MARK.search(text))
    unclosed = set(ending.unclosed) - {"¿", "¡"}
    if unclosed and (not ending.terminated or source in sources.closes and not marked):
        return "broken"
    if ending.terminated and not marked:
        # a blank after the full stop at the very limit: more was to follow
        return "limit" if text.endswith(" ") and not text.endswith("  ") and sources.at(source, text) else "whole"
    if sources.at(source, text) and not marked:
        return "limit"
    return "ask"


#: Capture sources are devices and channels that people name; more than this are taken for an error.
MAX_SOURCES = 100_000


def _slices(texts: list[str], limit: int = 150_000) -> Iterator[tuple[int, int]]:
    low, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield low, k + 1
            low, held = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _suspects(events: DataFrame, sources: _Sources) -> DataFrame:
    """(video_id, event_id, source, verdict, at_limit, marked, unclosed, contexts): every event whose text is not plainly whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["verdict"] = [_judge(s, t, sources) for s, t in zip(batch["source"], batch["text"])]
            batch = batch[batch["verdict"] != "whole"].reset_index(drop=True)
            texts = batch["text"].tolist()
            batch["at_limit"] = [sources.at(s, t) for s, t in zip(batch["source"], texts)]
            batch["marked"] = [bool(_MARK.search(t)) for t in texts]
            batch["unclosed"] = [bool(read_ending(t).unclosed) for t in texts]
            contexts: list[list[int]] = [[] for _ in texts]
            tails = [(_tail(t), k) for k, t in enumerate(texts) if batch["verdict"][k] == "ask"]
            tails = [(t, k) for t, k in tails if t]
            for low, high in _slices([t for t, _ in tails]):
                hashed, owner, last = _hashes([t for t, _ in tails[low:high]])
                for column in np.flatnonzero(last):
                    contexts[tails[low + owner[column]][1]] = hashed[:, column].view(np.int64).tolist()
            batch["contexts"] = contexts
            yield batch[["video_id", "event_id", "source", "verdict", "at_limit", "marked", "unclosed", "contexts"]]

    return events.mapInPandas(run, "video_id string, event_id string, source string, verdict string, at_limit boolean, marked boolean, unclosed boolean, contexts array<bigint>")


def _wanted(contexts: DataFrame, size: int) -> np.ndarray:
    """The filter of the hashes in `contexts`, packed to one bit per hash value modulo `size`, a power of two."""
    slot = F.col("hash").bitwiseAND(F.lit(size - 1))
    words = contexts.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("bits"))
    found = words.toPandas()  # at most size / 64 rows of two numbers
    filled = np.zeros(size // 64, dtype=np.int64)
    filled[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return filled


def _context_counts(events: DataFrame, sources: _Sources, wanted: np.ndarray) -> DataFrame:
    """(hash, closed, soft, open, on): how often the corpus ends a sentence after a context, with an ellipsis,
    stops there without a terminator, or goes on. wanted: the filter of the contexts to count."""
    shared = events.sparkSession.sparkContext.broadcast(wanted)  # BLOCK_CONTEXTS * FILTER_SHARE / 8 bytes at most
    mask = np.uint64(len(wanted) * 64 - 1)

    def count(bits: np.ndarray, seen: Counter) -> Iterator[pd.DataFrame]:
        items = list(seen.items())
        for low, high in _slices([s for (s, _), _ in items]):
            part = items[low:high]
            hashed, owner, last = _hashes([s for (s, _), _ in part])
            kind = np.where(last, np.array([k for (_, k), _ in part])[owner], _GOES_ON)
            times = np.array([n for _, n in part])[owner]
            slot = hashed & mask
            asked = bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)).astype(np.int64) & 1
            rows, columns = np.nonzero((asked > 0) & (hashed != 0) & (kind != _IGNORED)[None, :])
            keys, inverse = np.unique(hashed[rows, columns], return_inverse=True)
            kinds, weights = kind[columns], times[columns]
            sums = {n: np.bincount(inverse[kinds == k], weights=weights[kinds == k], minlength=len(keys)).astype(np.int64)
                    for n, k in (("closed", _CLOSED), ("soft", _SOFTLY), ("open", _STOPS), ("on", _GOES_ON))}
            yield pd.DataFrame({"hash": keys.view(np.int64), **sums})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        seen: Counter = Counter()  # equal sentences are hashed once
        for batch in batches:
            for source, text in zip(batch["source"], batch["text"]):
                closed, tail = _split(text)
                seen.update(closed[:-1])
                if not tail and closed and closed[-1][1] == _CLOSED:
                    seen[closed[-1]] += 1
                    continue
                verdict, at_limit = _judge(source, text, sources), sources.at(source, text)
                if closed:
                    marked = verdict == "ask" and not tail and at_limit and bool(_MARK.search(text))
                    seen[(closed[-1][0], _IGNORED) if marked else closed[-1]] += 1  # the mark may stand at a cut
                if tail:
                    seen[(tail, _STOPS if verdict in ("whole", "ask") and not at_limit else _IGNORED)] += 1
            if len(seen) > 100_000:
                yield from count(bits, seen)
                seen.clear()
        yield from count(bits, seen)

    counted = events.select("source", "text").mapInPandas(run, "hash bigint, closed bigint, soft bigint, open bigint, on bigint")
    return counted.groupBy("hash").agg(*[F.sum(c).alias(c) for c in ("closed", "soft", "open", "on")])


def detect_cuts(events: DataFrame) -> DataFrame:
    """(video_id, event_id, source, why): the events whose text was cut; why is `broken`, `limit` or `ending`.

    events: (video_id, event_id, source_file, text). Redelivered rows count once, with the greatest text
    and source. Null and empty texts are whole; so is a text that ends with a terminator, and a
    sentence that its speaker breaks off with a dash. Texts are read whole. Other columns are not read.
    An empty table gives no rows.
    """
    rows = events.filter("text is not null and text <> ''").select("video_id", "event_id", capture_source(F.col("source_file")).alias("source"), "text")
    once = cut_lineage(rows.groupBy("video_id", "event_id").agg(F.max("source").alias("source"), F.max("text").alias("text")))
    found = field_limits(once).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} capture sources")
    habits = source_habits(once).limit(MAX_SOURCES + 1).collect()
    if len(habits) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} capture sources")
    sources = _Sources({r.source: (r.unit, r.n) for r in found}, {r.source: frozenset(r.escapes) for r in habits}, frozenset(r.source for r in habits if r.closes))
    suspects = cut_lineage(_suspects(once, sources))
    # equal endings are decided once, so a text that a third of all events repeat is no hot key
    facts = ["contexts", "at_limit", "marked", "unclosed"]
    asked = suspects.filter("verdict = 'ask'").withColumn("ending", F.xxhash64(*facts))
    endings = asked.select("ending", *facts).distinct()
    each = cut_lineage(endings.select("ending", "at_limit", "marked", F.posexplode("contexts").alias("level", "hash")).filter("hash <> 0"))
    n = each.count()
    blocks = max(1, -(-n // BLOCK_CONTEXTS))
    size = 1 << max(16, (FILTER_SHARE * -(-n // blocks) - 1).bit_length())
    parts = [_context_counts(once, sources, _wanted(each.filter(F.pmod(F.shiftright("hash", 40), F.lit(blocks)) == block), size)) for block in range(blocks)]
    # a context that the filter of another block lets through by chance is counted there, too: the greatest count is the whole one
    counts = parts[0] if blocks == 1 else reduce(DataFrame.unionByName, parts).groupBy("hash").agg(*[F.max(c).alias(c) for c in ("closed", "soft", "open", "on")])
    # the text itself is one of the open ends
    own = F.when(F.col("at_limit"), 0).otherwise(1)
    others = F.greatest(F.col("open") - own, F.lit(0))
    # a mark at the very limit is the author's ellipsis only where the corpus has one in that place
    by_limit = F.col("at_limit") & F.col("marked")
    ends = F.when(by_limit, F.col("soft")).otherwise(F.col("closed") + F.col("soft") + others)
    seen = F.col("closed") + F.col("soft") + others + F.col("on")
    enough = seen >= F.when(F.col("level") <= CONTEXTS.index(5), EVIDENCE[0]).otherwise(EVIDENCE[1])
    told = each.join(counts, "hash").filter(enough).withColumn("share", ends / seen)
    verdict = told.groupBy("ending").agg(F.min_by("share", "level").alias("share"))
    cut = endings.join(verdict, "ending", "left").filter(F.coalesce(F.col("share") < 0.5, F.col("unclosed") | F.col("at_limit"))).select("ending")
    ending = asked.join(cut, "ending").select("video_id", "event_id", "source", F.lit("ending").alias("why"))
    sure = suspects.filter("verdict in ('broken', 'limit')").select("video_id", "event_id", "source", F.col("verdict").alias("why"))
    return sure.unionByName(ending)


def cut_shares(events: DataFrame) -> DataFrame:
    """(source, n_events, n_cut, n_flagged, cut_share): per capture source how many events were cut, and how many of
    those review_required marks. Events without a source are reported under a null source."""
    cuts = detect_cuts(events).select("video_id", "event_id", F.lit(1).alias("cut"))
    once = events.groupBy("video_id", "event_id").agg(
        F.max(capture_source(F.col("source_file"))).alias("source"), F.max("review_required").alias("flagged"))
    joined = once.join(cuts, ["video_id", "event_id"], "left")
    return joined.groupBy("source").agg(
        F.count("*").alias("n_events"), F.count("cut").alias("n_cut"),
        F.count_if(F.col("flagged") & F.col("cut").isNotNull()).alias("n_flagged"),
        F.round(F.count("cut") / F.count("*"), 6).alias("cut_share"))

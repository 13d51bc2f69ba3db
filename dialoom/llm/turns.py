"""Raw transcripts into clean, ordered speaker turns.

Labels come from the speaker column or stand in the text. They are compared with the roster of the
work (canonical names, aliases, given names, special speakers); labels that no entry equals are
blocked by their sound and assigned to the roster entries of their transcript at the least total cost.
Timestamps, annotations and fillers are stripped, rows without words drop out, unlabelled rows go on
with the speaker before them, and neighbouring rows of one speaker become a turn.

Every text is parsed once, before anything is shuffled. The parsed rows are then ranged by (video, event),
so that one hot video spreads over all tasks, row by row; only the turns at the borders of tasks are
joined by a window over the video.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

from .lookalike import plain_points
from .names import bare, edits

#: Rosters are dictionaries that people keep; more names than this in all of them are taken for an error.
MAX_NAMES = 1_000_000

_TIME = re.compile(r"^\s*[\[(<{【（]?\s*(\d{1,2}):(\d{2})(?::(\d{2}))?(?:[.,](\d{1,3}))?\s*[\])>}】）]?\s*(?:-->|[-–—|]+)?\s*")
_ARROW = re.compile(r"^\s*(?:>{1,3}|[-–—•*#]+(?=\s))\s*")
_NOTE = re.compile(r"\[[^\[\]]*\]|\([^()]*\)|（[^（）]*）|【[^【】]*】|〔[^〔〕]*〕|［[^［］]*］|<[^<>]*>|\{[^{}]*\}|\*[^*]+\*|[♪♫♬♩]+[～~]*")
_NOTE_SIGN = re.compile(r"[\[(（【〔［<{*♪♫♬♩]")
_ASIDE = re.compile(r"\s*(?:\([^()]*\)|（[^（）]*）)\s*$")
_SEPARATOR = re.compile(r"\s*[:：]\s*|\s+[-–—]+\s+")
_PARENTHESES = re.compile(r"[()（）]")
_EDGES = " \t　:：-–—>*#|,，"
# Words that carry no meaning of their own; the second group and the later Chinese and Japanese ones do so
# before a comma or at an end only.
_HESITATION = re.compile(r"(?:[,，]\s*)?(?<![\w'’])(?:u+h+m*|u+m+|e+r+m*|h+m+m+|m+h+m*|e+h+m*|a+h+e+m+)(?![\w'’?？!！])[\s,，、.…]*", re.I)
_PHRASE = re.compile(r"(?:[,，]\s*)?(?<![\w'’])(?:i mean|you know|sort of|kind of|o sea|este|bueno|pues)\s*(?:[,，]|\.{2,}|…+|$)\s*", re.I)
_UNSPACED_FILLER = re.compile(
    r"(?:嗯+|呃+|唔+|额)[,，、。.…\s]*|(?<![一-鿿])(?:啊|那个|这个|就是)(?:[,，、…]+|$)\s*"
    r"|(?<![ぁ-ヿ一-鿿])(?:えー?っと|ええと|えーと|あの[うー]*|うー+ん|うーん|そのー|まあ|ええ)(?:[、，,。.…]+|$)\s*")
#: What has to be in a text for these to find anything; cheaper to look for.
_MAY_HESITATE = re.compile(r"\b(?:u+h+m*|u+m+|e+r+m*|h+m+m+|m+h+m*|e+h+m*|a+h+e+m+)\b", re.I)
_PHRASES = ("i mean", "you know", "sort of", "kind of", "o sea", "este", "bueno", "pues")
_MAY_FILL = re.compile("[嗯呃唔额啊那这就えあうそま]")
_WORD = re.compile(r"\w")
_CLASS = str.maketrans("bfpvcgjkqsxzdtlmnr", "111122222222334556")

_ROW = ("video_id string, work_id string, event_id string, number bigint, start_ms bigint, end_ms bigint, speaker string, "
        "open_label string, open_form string, text string")
_ROW_COLUMNS = [x.split(" ")[0] for x in _ROW.split(", ")]
_PIECE = ("video_id string, chunk int, piece int, n_pieces int, speaker string, first_event_id string, last_event_id string, "
          "text string, n_rows bigint, start_ms bigint, end_ms bigint")
_COLUMNS = [x.split(" ")[0] for x in _PIECE.split(", ")]


def label_form(label: str) -> str:
    """A label without arrows, brackets, colons, asides and case."""
    form = plain_points(label)
    while True:
        before = form
        form = _ARROW.sub("", form).strip(_EDGES)
        form = _ASIDE.sub("", form) if len(_ASIDE.sub("", form).strip(_EDGES)) else form
        if len(form) > 2 and (form[0], form[-1]) in (("[", "]"), ("【", "】"), ("［", "］"), ("(", ")"), ("（", "）"), ("<", ">")):
            form = form[1:-1]
        if form == before:
            return " ".join(form.casefold().split())


def roster(aliases: dict[str, list[str]] | None, special: dict[str, str] | None) -> dict[str, str]:
    """Label form -> speaker. Canonical names win over aliases, these over given names; a given name that two share names nobody."""
    out: dict[str, str] = {}
    given: dict[str, set[str]] = {}
    for name in aliases or {}:
        parts = [p for p in re.split(r"[\s・·=＝]+", name) if p]
        first = parts[0] if len(parts) == 2 else name[1:] if len(name) == 3 and all("㐀" <= c <= "鿿" for c in name) else None
        if first:
            given.setdefault(label_form(first), set()).add(name)
    for form, names in given.items():
        if len(names) == 1:
            out[form] = next(iter(names))
    for name, typed in (aliases or {}).items():
        for alias in typed or []:
            if alias and label_form(alias):
                out[label_form(alias)] = name
    for name in aliases or {}:
        out[label_form(name)] = name
    for typed, meant in (special or {}).items():
        if meant is not None:
            for form in (label_form(typed), label_form(meant)):
                if form:
                    out[form] = meant
    return out


def sound_key(form: str) -> str:
    """What a name sounds like: its first letter and the classes of its consonants; kana without marks of length; else the last character."""
    form = bare(form)
    if form.isascii():
        letters = re.sub(r"[^a-z]", "", form)
        coded = re.sub(r"[aeiouyhw]", "", letters[1:]).translate(_CLASS)
        return letters[:1] + re.sub(r"(.)\1+", r"\1", coded)
    short = re.sub(r"[ーッっ・\s]", "", form)
    return short[:2] if re.search(r"[ぁ-ヺ]", short) else short[-1:]


def least_cost_assignment(cost: np.ndarray) -> list[int]:
    """For each row a column of its own such that the sum of the costs is least; -1 where rows outnumber columns.

    The Hungarian method with potentials; the matrices are as small as the cast of one transcript.
    """
    rows, columns = cost.shape
    if rows > columns:
        cost = np.concatenate([cost, np.full((rows, rows - columns), cost.max() + 1 if cost.size else 1.0)], axis=1)
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    match, way = np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while True:
            used[j] = True
            row = match[j]
            gap = cost[row - 1] - u[row] - v[1:]
            better = ~used[1:] & (gap < least[1:])
            least[1:][better], way[1:][better] = gap[better], j
            free = np.where(used[1:], np.inf, least[1:])
            following = int(free.argmin()) + 1
            delta = free[following - 1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j = following
            if match[j] == 0:
                break
        while j:
            match[j] = match[way[j]]
            j = way[j]
    out = [-1] * rows
    for j in range(1, m + 1):
        if match[j] and match[j] <= rows and j <= columns:
            out[match[j] - 1] = j - 1
    return out


def _label_in(text: str, names: dict[str, str], longest: int) -> tuple[str, str] | None:
    """(speaker, rest) where the text begins with a known label and a separator, however long the asides in the label are."""
    opened = at = 0
    for mark in _SEPARATOR.finditer(text):
        for sign in _PARENTHESES.findall(text, at, mark.start()):
            opened = max(0, opened + (1 if sign in "(（" else -1))
        at = mark.start()
        if opened:
            continue  # inside an aside
        form = label_form(text[:at])
        name = names.get(form)
        if name is not None:
            return name, text[mark.end() :]
        if len(form) > longest:
            return None
    return None


@lru_cache(maxsize=50_000)
def _words_of(rest: str) -> str:
    """A text without annotations and fillers; '' if no word is left."""
    if _NOTE_SIGN.search(rest):
        rest = _NOTE.sub(" ", rest)
    while True:
        before = rest
        if _MAY_HESITATE.search(rest):
            rest = _HESITATION.sub(" ", rest)
        low = rest.lower()
        if any(p in low for p in _PHRASES):
            rest = _PHRASE.sub(" ", rest)
        if _MAY_FILL.search(rest):
            rest = _UNSPACED_FILLER.sub(" ", rest)
        if rest == before:
            break
    rest = re.sub(r"\s+([,，.。!！?？…、])", r"\1", " ".join(rest.split()))
    if "," in rest or "，" in rest or "、" in rest:
        rest = re.sub(r"([,，、])\s*(?=[,，、.。…])", "", rest)
    rest = rest.lstrip(" ,，、.。…-–—")
    if not _WORD.search(rest):
        return ""
    return rest[0].upper() + rest[1:] if rest[0].islower() else rest


def parse_row(text: str | None, names: dict[str, str], longest: int | None = None) -> tuple[int | None, str | None, str]:
    """(time in ms, speaker, clean text) that a text holds; a text without words gives ''. longest: of the forms in names."""
    rest = plain_points(text or "").strip()
    time = speaker = None
    longest = max(map(len, names), default=0) if longest is None else longest
    while True:
        before = rest
        found = _TIME.match(rest)
        if found:
            if time is None:
                time = _milliseconds(*found.groups())
            rest = rest[found.end() :]
        rest = _ARROW.sub("", rest)
        if speaker is None and names:
            label = _label_in(rest, names, longest)
            if label:
                speaker, rest = label
        note = _NOTE.match(rest) if _NOTE_SIGN.match(rest) else None
        if note:
            rest = rest[note.end() :].lstrip()
        if rest == before:
            break
    return time, speaker, _words_of(rest)


def _milliseconds(a: str, b: str, c: str | None, fraction: str | None) -> int:
    seconds = int(a) * 3600 + int(b) * 60 + int(c) if c is not None else int(a) * 60 + int(b)
    return seconds * 1000 + (int(fraction.ljust(3, "0")) if fraction else 0)


def _rosters(configs: DataFrame) -> dict[str, dict[str, str]]:
    """work_id -> roster. Their size is counted before they come to the driver."""
    known = configs.filter("work_id is not null").select("work_id", "speaker_aliases", "special_speakers")
    names = F.size(F.flatten(F.map_values("speaker_aliases"))) + F.size("speaker_aliases")
    size = known.agg(F.sum(F.greatest(F.coalesce(names, F.lit(0)), F.lit(0)) + F.greatest(F.coalesce(F.size("special_speakers"), F.lit(0)), F.lit(0)) + 1)).first()[0] or 0
    if size > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names in the rosters")
    return {r.work_id: roster(r.speaker_aliases, r.special_speakers) for r in known.collect()}


def _parsed(rows: DataFrame, rosters: dict[str, dict[str, str]]) -> DataFrame:
    """The rows that hold words, with their time, clean text and speaker. open_label and open_form hold a label that no roster
    entry equals; the speaker then is the one that stands in the text."""
    shared = rows.sparkSession.sparkContext.broadcast(rosters)  # at most MAX_NAMES names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longest = {work: max(map(len, names), default=0) for work, names in shared.value.items()}
        for batch in batches:
            out = []
            columns = [batch[c] for c in ("video_id", "work_id", "event_id", "number", "start_ms", "end_ms", "label", "text")]
            for video, work, event, number, begin, end, label, text in zip(*columns):
                names = shared.value.get(work, {})
                time, speaker, words = parse_row(text, names, longest.get(work, 0))
                if not words:
                    continue
                open_label = form = None
                if label and label.strip():
                    form = label_form(label)
                    name = names.get(form)
                    if name is not None or not form:
                        speaker, form = name or speaker, None
                    else:
                        open_label = plain_points(label).strip(_EDGES)
                begin = begin if begin == begin else time
                out.append((video, work, event, number, begin, end if end == end else begin, speaker, open_label, form, words))
            frame = pd.DataFrame(out, columns=_ROW_COLUMNS)
            yield frame.astype({"number": "Int64", "start_ms": "Int64", "end_ms": "Int64"})

    return rows.mapInPandas(run, _ROW)


def assign_labels(labels: DataFrame, configs: DataFrame) -> DataFrame:
    """(video_id, open_form, assigned): labels that no roster entry equals, assigned to entries that sound like them.

    labels: distinct (video_id, work_id, open_form). Per transcript and sound the labels are assigned at the least
    total number of edits; more than two edits, or a third of the label, is no assignment. Several spellings may
    go to one entry; where that makes no difference in edits they spread over as many entries as can be.
    """
    forms = "work_id string, entry string, name string, sound string"

    def entries_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(work, form, name, sound_key(form)) for work, aliases, special in zip(batch["work_id"], batch["aliases"], batch["special"])
                   for form, name in roster({k: list(v) for k, v in aliases}, dict(special)).items()]
            yield pd.DataFrame(out, columns=["work_id", "entry", "name", "sound"])

    none = F.array().cast("array<string>")
    known = configs.filter("work_id is not null").select(
        "work_id", F.transform(F.map_entries(F.coalesce("speaker_aliases", F.create_map().cast("map<string,array<string>>"))),
                               lambda e: F.struct(e["key"], F.coalesce(e["value"], none))).alias("aliases"),
        F.map_entries(F.coalesce("special_speakers", F.create_map().cast("map<string,string>"))).alias("special"))
    entries = known.mapInPandas(lambda batches: entries_of(_pairs(batches)), forms)
    sound = F.pandas_udf(lambda s: s.map(sound_key), "string")
    pairs = labels.withColumn("sound", sound("open_form")).join(entries, ["work_id", "sound"])

    def assign(group: pd.DataFrame) -> pd.DataFrame:
        cost: dict[str, dict[str, float]] = {}
        for form, entry, name in zip(group["open_form"], group["entry"], group["name"]):
            found = edits(form, entry, 2) if len(form) >= 6 else edits(form, entry, 1) if len(form) >= 3 else np.inf
            if found < np.inf:
                fits = cost.setdefault(form, {})
                fits[name] = min(fits.get(name, np.inf), found)
        chosen = assign_spellings(cost)
        return pd.DataFrame([(group["video_id"].iloc[0], form, name) for form, name in chosen.items()], columns=["video_id", "open_form", "assigned"])

    return pairs.groupBy("video_id", "sound").applyInPandas(assign, "video_id string, open_form string, assigned string")


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrays of (key, value) structs as lists of pairs."""
    for batch in batches:
        for column in ("aliases", "special"):
            batch[column] = [[tuple(e.values()) for e in entries] for entries in batch[column]]
        yield batch


def assign_spellings(cost: dict[str, dict[str, float]]) -> dict[str, str]:
    """spelling -> name at the least sum of costs; among such choices the names are used as evenly as can be.

    A spelling with one cheapest name takes it. For the others the cheapest names are columns of an assignment,
    each as often as there are spellings, and every further use of a name costs a little more.
    """
    out, used = {}, dict.fromkeys(sorted({n for fits in cost.values() for n in fits}), 0)
    tied: dict[str, list[str]] = {}
    for spelling in sorted(cost):
        least = min(cost[spelling].values())
        names = sorted(n for n, c in cost[spelling].items() if c == least)
        if len(names) == 1:
            out[spelling] = names[0]
            used[names[0]] += 1
        else:
            tied[spelling] = names
    if tied:
        rows, names = list(tied), sorted({n for names in tied.values() for n in names})
        columns = [(n, k) for n in names for k in range(len(rows))]
        far = float(len(rows) + max(used.values()) + 1) ** 2
        matrix = np.array([[float(used[n] + k) if n in tied[r] else far for n, k in columns] for r in rows])
        for row, column in zip(rows, least_cost_assignment(matrix)):
            out[row] = columns[column][0]
    return out


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The turns inside each part of a video. Rows come sorted by (video_id, number, event_id); one that was delivered again follows
    the first one."""
    chunk = TaskContext.get().partitionId()
    video: str | None = None
    seen: tuple | None = None
    done: list[list] = []

    def closed() -> list[tuple]:
        return [(video, chunk, k, len(done), t[0], t[1], t[2], " ".join(t[3]), t[4], t[5], t[6]) for k, t in enumerate(done)]

    def emit(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=_COLUMNS).astype({"start_ms": "Int64", "end_ms": "Int64"})

    for batch in batches:
        out: list[tuple] = []
        begin, end = (batch[c].astype(object).where(batch[c].notna(), None) for c in ("start_ms", "end_ms"))
        for who, event, speaker, text, b, e in zip(batch["video_id"], batch["event_id"], batch["speaker"], batch["text"], begin, end):
            if (who, event) == seen:
                continue
            seen = (who, event)
            if who != video:
                out += closed()
                video, done = who, []
            if done and (speaker is None or speaker == done[-1][0]):
                turn = done[-1]
                turn[2] = event
                turn[3].append(text)
                turn[4] += 1
                turn[5] = b if turn[5] is None else turn[5] if b is None else min(turn[5], b)
                turn[6] = e if turn[6] is None else turn[6] if e is None else max(turn[6], e)
            else:
                done.append([speaker, event, event, [text], 1, b, e])
        yield emit(out)
    yield emit(closed())


def speaker_turns(events: DataFrame, runs: DataFrame, configs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per turn: video_id, speaker, first_event_id, last_event_id, text, n_rows, start_ms, end_ms.

    Time order is that of the numbers at the end of the event ids, then of the ids: they count up in time also
    where start_ms is null or only written in the text, in whole seconds. Ids without a number come first. Rows without
    words belong to no turn and pass on no label. Redelivered rows count once. Rows before the first label form a
    turn with a null speaker. A label that fits no roster entry, or of a work without a roster, names a speaker
    of its own, as it is written. Rows without video_id or event_id are dropped, null texts have no
    words, an empty table gives no rows. Other columns are not read. parts: of the sorted rows; the result does not depend on it.
    """
    work = runs.select("video_id", "work_id").dropDuplicates(["video_id"])
    rows = events.filter("video_id is not null and event_id is not null").select(
        "video_id", "event_id", F.regexp_extract("event_id", r"(\d{1,18})$", 1).try_cast("bigint").alias("number"), F.col("start_ms").cast("bigint").alias("start_ms"),
        F.col("end_ms").cast("bigint").alias("end_ms"), F.col("speaker").alias("label"), "text").join(work, "video_id", "left")
    parsed = cut_lineage(_parsed(rows, _rosters(configs)))
    labelled = parsed.filter("open_form is not null")
    columns = ["video_id", "number", "event_id", "start_ms", "end_ms", "speaker", "text"]
    spoken = parsed.select(*columns)
    if not labelled.isEmpty():
        assigned = assign_labels(labelled.select("video_id", "work_id", "open_form").distinct(), configs)
        # only rows with such a label are joined, so what most rows share is no hot key
        named = labelled.join(assigned, ["video_id", "open_form"], "left").withColumn("speaker", F.coalesce("assigned", "speaker", "open_label"))
        spoken = parsed.filter("open_form is null").select(*columns).unionByName(named.select(*columns))
    keys = ["video_id", "number", "event_id"]
    ranged = spoken.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys)
    pieces = cut_lineage(ranged.mapInPandas(_pieces, _PIECE))

    # the first two turns of a part and its last may belong together with those beyond the border
    order = Window.partitionBy("video_id").orderBy("chunk", "piece")
    at_border = (F.col("piece") <= 1) | (F.col("piece") == F.col("n_pieces") - 1)
    border = pieces.filter(at_border).withColumn("speaker", F.coalesce(
        "speaker", F.last("speaker", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))))
    same_chunk = F.lag("chunk").over(order) == F.col("chunk")
    next_to = F.when(same_chunk, F.col("piece") == F.lag("piece").over(order) + 1).otherwise(F.lag("chunk").over(order).isNotNull())
    goes_on = next_to & F.lag("speaker").over(order).eqNullSafe(F.col("speaker"))
    numbered = border.withColumn("goes_on", F.coalesce(goes_on, F.lit(False))).withColumn(
        "turn", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("chunk", "piece")
    merged = numbered.groupBy("video_id", "turn").agg(
        F.min_by("speaker", place).alias("speaker"), F.min_by("first_event_id", place).alias("first_event_id"),
        F.max_by("last_event_id", place).alias("last_event_id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece", "text"))), lambda p: p["text"]), " ").alias("text"),
        F.sum("n_rows").alias("n_rows"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    out = ["video_id", "speaker", "first_event_id", "last_event_id", "text", "n_rows", "start_ms", "end_ms"]
    return pieces.filter(~at_border).select(*out).unionByName(merged.select(*out))

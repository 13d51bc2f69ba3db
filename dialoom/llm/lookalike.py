"""One consistent form for text that looks the same but is made of different characters.

Code points fall into look-alike classes by union-find over the pairs below; the classes carry over to
strings, whose class is the string of their characters' representatives (the skeleton). Among the
spellings of a class that the corpus holds the most frequent one represents the class, and an
automaton over all deviating spellings rewrites the values from left to right, longest match first.

Characters that never differ from their plain form in meaning (invisible characters, other spaces, wide
and narrow forms, ligatures, radicals, decomposed accents) are rewritten wherever they stand. Letters
of another script are rewritten only where they imitate: inside a word of another script, or where the
plain spelling of the whole word is the more frequent one. Words really written in another script,
typographic punctuation and emoji sequences stay.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

# Letters of the same look. The first string of a line has the Latin letters, the second
# the Cyrillic ones, the third the Greek ones, in the same order; a blank stands for none.
LOOKALIKE_LETTERS = [
    ("ABCEHIJKMOPSTXYaceijopsvxyhdqw", "АВСЕНІЈКМОРЅТХУасеіјорѕѵхуһԁԛԝ", "ΑΒ ΕΗΙ ΚΜΟΡ ΤΧΥ    ϳο  ν      "),
    ("NZGVgl", "  ԌѴ ӏ", "ΝΖ    "),
]
# Latin letters of other shape that pass for the plain ones, in the same order.
LOOKALIKE_LATIN = ("iug", "ıᴜɡ")
# Chinese characters and the katakana of the same look, in the same order.
LOOKALIKE_KANJI, LOOKALIKE_KANA = "力夕口二八工卜一千三又才", "カタロニハエトーチミヌオ"
# Signs of the same look as an ASCII sign, in the same order.
LOOKALIKE_SIGNS = ("‐‑‒−ʼ‵ǃ∶։٪⁎∕⁄ǀ‚", "----''!::%*//|,")

_INVISIBLE = frozenset("\u115f\u1160\u17b4\u17b5\u3164\uffa0\u180b\u180c\u180d\u180f")
_EMOJI_JOINED = regex.compile("(?<=[\\p{Extended_Pictographic}\\p{EMod}\ufe0f])\u200d(?=\\p{Extended_Pictographic})")
_EMOJI_STYLED = regex.compile("(?<=\\p{Extended_Pictographic})[\ufe0e\ufe0f]|(?<=[0-9#*])\ufe0f(?=\u20e3)")
_PLAIN = regex.compile(r"[\x20-\x7e¡-¬®-ÿ–-‟…、-〩ぁ-ゖ゛-ヿ一-鿿！-／：-＠［-｀｛-･]*")
_WORD = regex.compile(r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Nd}][\p{Latin}\p{Greek}\p{Cyrillic}\p{Nd}\p{M}'’\-" + LOOKALIKE_SIGNS[0] + "]*")
_KANA_RUN = regex.compile(f"[{LOOKALIKE_KANJI}ァ-ヺー・]*[ァ-ヺ][{LOOKALIKE_KANJI}ァ-ヺー・]*")
_KANJI = frozenset(LOOKALIKE_KANJI)
#: Deviating spellings up to which their table is broadcast.
BROADCAST_ROWS = 200_000
_SCRIPT = {"LATIN": "L", "CYRILLIC": "C", "GREEK": "G"}


class UnionFind(dict):
    """Classes of equal things; `find` gives the least member of a class."""

    def find(self, x):
        root = x
        while self.get(root, root) != root:
            root = self[root]
        while self.get(x, x) != root:
            self[x], x = root, self[x]
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        low, high = min(a, b), max(a, b)
        self[high] = self[low] = low


def _classes() -> tuple[UnionFind, dict[str, str]]:
    classes = UnionFind()
    for latin, cyrillic, greek in LOOKALIKE_LETTERS:
        for a, b, c in zip(latin, cyrillic, greek):
            for other in (b, c):
                if other != " ":
                    classes.union(a, other)
    for pair in ((LOOKALIKE_KANJI, LOOKALIKE_KANA), LOOKALIKE_SIGNS, LOOKALIKE_LATIN):
        for a, b in zip(*pair):
            classes.union(a, b)
    return classes, {c: classes.find(c) for c in list(classes)}


_CLASSES, _SKELETON = _classes()
_TO_SKELETON = str.maketrans({c: r for c, r in _SKELETON.items() if c not in LOOKALIKE_KANJI} | dict(zip(LOOKALIKE_KANJI, LOOKALIKE_KANA)))


def script(char: str) -> str:
    """L, C or G for Latin, Cyrillic and Greek letters, else an empty string."""
    if char.isascii():
        return "L" if char.isalpha() else ""
    if not char.isalpha():
        return ""
    return _SCRIPT.get(unicodedata.name(char, "").split(" ")[0], "")


def _plain_point(char: str) -> str:
    """What a character is rewritten to wherever it stands; the character itself for most."""
    category = unicodedata.category(char)
    if category == "Zs":
        return " "
    if category == "Cf" or char in _INVISIBLE or "\ufe00" <= char <= "\ufe0f" or (category == "Cc" and char not in "\t\n\r"):
        return ""
    tag, _, rest = unicodedata.decomposition(char).rpartition(">")
    if not tag:
        return char
    kind = unicodedata.normalize("NFKC", char)
    if tag in ("<wide", "<narrow", "<font"):
        return kind if kind.isalnum() or kind == "ー" or category == "Lm" else char
    if tag == "<compat" and ("\u2e80" <= char <= "\u2fdf" or "\ufb00" <= char <= "\ufb4f" or "\u0132" <= char <= "\u01f3"):
        return kind
    return char


class _Points(dict):
    def __missing__(self, code: int) -> str:
        self[code] = value = _plain_point(chr(code))
        return value


_POINTS = _Points()
# radicals that have no compatible character of their own
_POINTS.update({0x2ED4: "门"})
# parts of emoji sequences are put aside as private characters while the others are rewritten
_ASIDE = {"\u200d": "\U0010fff0", "\ufe0f": "\U0010fff1", "\ufe0e": "\U0010fff2"}
_BACK = str.maketrans({v: k for k, v in _ASIDE.items()})


def _put_aside(match) -> str:
    return _ASIDE[match[0]]


def plain_points(text: str) -> str:
    """The text with every character that has one plain form rewritten to it."""
    if _PLAIN.fullmatch(text):
        return text
    if any(c in text for c in _ASIDE):
        text = _EMOJI_STYLED.sub(_put_aside, _EMOJI_JOINED.sub(_put_aside, text))
        text = text.translate(_POINTS).translate(_BACK)
    else:
        text = text.translate(_POINTS)
    return unicodedata.normalize("NFC", text)


def skeleton(word: str) -> str:
    return word.translate(_TO_SKELETON)


_LETTERS = str.maketrans({c: r for c, r in _SKELETON.items() if c not in LOOKALIKE_KANJI and c not in LOOKALIKE_KANA})
_TO_KANA = str.maketrans(LOOKALIKE_KANJI, LOOKALIKE_KANA)


def comparable(text: str) -> str:
    """The text with look-alike letters as Latin ones, and look-alike Chinese characters as katakana inside katakana only."""
    text = text.translate(_LETTERS)
    return _KANA_RUN.sub(lambda m: m[0].translate(_TO_KANA), text)


def _kinds(word: str) -> set[str]:
    return {s for s in map(script, word) if s}


def forced(word: str) -> str | None:
    """The spelling of a word whose letters come from several scripts, in the script that all of them can take; else None."""
    if not word.isascii() and any(c in _KANJI for c in word) and any("ァ" <= c <= "ヺ" for c in word):
        # a Chinese character between katakana
        return "".join(_TO_SKELETON[ord(c)] if c in _KANJI and 0 < k < len(word) - 1 and _kana(word[k - 1]) and _kana(word[k + 1]) else c for k, c in enumerate(word))
    kinds = _kinds(word)
    if len(kinds) < 2:
        return None
    counts = Counter(s for s in map(script, word) if s)
    for target, _ in sorted(counts.items(), key=lambda kv: (kv[0] != "L", -kv[1])):
        out = "".join(c if script(c) in ("", target) else _in_script(c, target) or "\0" for c in word)
        if "\0" not in out:
            return out
    return None


def _kana(char: str) -> bool:
    return "ァ" <= char <= "ヺ" or char in "ー・" or char in _KANJI


def _in_script(char: str, target: str) -> str | None:
    root = _SKELETON.get(char)
    return next((c for c, r in _SKELETON.items() if r == root and script(c) == target), None) if root else None


def words(text: str) -> list[str]:
    """The words of a value with plain points, and its katakana runs."""
    found = _WORD.findall(text)
    if not text.isascii():
        found += _KANA_RUN.findall(text)
    return found


def is_suspect(word: str) -> bool:
    """Some character could stand for another of its look."""
    if word.isascii():
        return False
    return any(c in _SKELETON and not c.isascii() and (c in _KANJI or not _kana(c)) for c in word)


def spelling_counts(values: DataFrame) -> DataFrame:
    """(skeleton, spelling, n): how often each spelling occurs in the values, summed within partitions first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(skeleton(w), w, n) for w, n in total.items()], columns=["skeleton", "spelling", "n"])
            total.clear()
            return out

        for batch in batches:
            for value, n in Counter(batch["value"].dropna()).items():
                for word in words(plain_points(value)):
                    total[word] += n
            if len(total) > 300_000:
                yield flush()
        yield flush()

    counted = values.select("value").mapInPandas(run, "skeleton string, spelling string, n bigint")
    return counted.groupBy("skeleton", "spelling").agg(F.sum("n").alias("n"))


def representatives(values: DataFrame) -> DataFrame:
    """(spelling, representative) of every deviating spelling.

    A class is represented by its most frequent spelling. A word that mixes scripts yields to the spelling
    in one script, however rare that is.
    """
    return _with_forced(spelling_counts(values))


def _with_forced(counts: DataFrame) -> DataFrame:
    schema = "skeleton string, spelling string, n bigint, forced string, suspect boolean"

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["forced"] = [forced(w) if is_suspect(w) else None for w in batch["spelling"]]
            batch["suspect"] = [is_suspect(w) for w in batch["spelling"]]
            yield batch

    marked = counts.mapInPandas(mark, schema)
    best = marked.groupBy("skeleton").agg(
        F.max_by("spelling", F.struct("n", F.struct(~F.col("suspect"), "spelling"))).alias("most"),
        F.max("n").alias("most_n"),
        F.collect_list(F.when(F.col("suspect"), F.struct("spelling", "forced", "n"))).alias("odd"))
    odd = best.filter(F.size("odd") > 0).select("most", "most_n", F.explode("odd").alias("o"))
    frequent = F.col("most_n") > F.col("o.n")
    chosen = F.when(frequent, F.col("most")).otherwise(F.coalesce(F.col("o.forced"), F.col("o.spelling")))
    return odd.select(F.col("o.spelling").alias("spelling"), chosen.alias("representative")).filter("spelling <> representative")


class Rewriter:
    """Rewrites whole words from left to right with an automaton over the deviating spellings."""

    def __init__(self, pairs: dict[str, str]):
        self.automaton = ahocorasick.Automaton()
        for spelling, representative in pairs.items():
            self.automaton.add_word(spelling, (spelling, representative))
        if pairs:
            self.automaton.make_automaton()
        self.empty = not pairs

    def __call__(self, text: str) -> str:
        if self.empty:
            return text
        spans = {m.span() for m in _WORD.finditer(text)} | {m.span() for m in _KANA_RUN.finditer(text)}
        out, at = [], 0
        for end, (spelling, representative) in self.automaton.iter_long(text):
            start = end + 1 - len(spelling)
            if start >= at and (start, end + 1) in spans:
                out += [text[at:start], representative]
                at = end + 1
        return "".join([*out, text[at:]])


def normal_forms(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, value, normal): the distinct values that need another form, with their keys and consistent form.

    Null and empty values need none. Repeated rows give one row; ties between equally frequent spellings
    go to the plain one; values are read whole, whatever their length; an empty table gives no rows.
    Other columns are not read, so their names do not matter.
    """
    values = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("_v"))
    values = values.select(*keys, "_v.field", "_v.value").filter("value is not null and value <> ''")
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.select(*keys).schema.fields)
    counted = ["_skeleton", "_spelling", "_n"]
    schema = f"{key_schema}, field string, value string, plain string, suspects array<string>, _skeleton string, _spelling string, _n bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The values that may need another form, and the spellings of all values, counted within the task."""
        total: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(skeleton(w), w, n) for w, n in total.items()], columns=counted)
            total.clear()
            return out.reindex(columns=[*keys, "field", "value", "plain", "suspects", *counted]).astype({c: object for c in (*keys, "field", "value", "plain", "suspects")}).where(lambda f: f.notna(), None)

        for batch in batches:
            plain = [plain_points(v) for v in batch["value"]]
            found = [words(p) for p in plain]
            for w in found:
                total.update(w)
            suspects = [[] if p.isascii() else sorted({x for x in w if is_suspect(x)}) for p, w in zip(plain, found)]
            keep = [p != v or bool(s) for p, v, s in zip(plain, batch["value"], suspects)]
            out = batch.assign(plain=plain, suspects=suspects)[keep]
            yield out.assign(_skeleton=None, _spelling=None, _n=pd.array([pd.NA] * len(out), dtype="Int64"))
            if len(total) > 300_000:
                yield flush()
        yield flush()

    seen = cut_lineage(values.mapInPandas(run, schema))  # every text is parsed once
    odd = seen.filter("_spelling is null").drop(*counted).distinct()
    counts = seen.filter("_spelling is not null").groupBy(F.col("_skeleton").alias("skeleton"), F.col("_spelling").alias("spelling")).agg(F.sum("_n").alias("n"))
    changes = cut_lineage(_with_forced(counts))
    if changes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        changes = F.broadcast(changes)  # else the join shuffles, and adaptive execution splits what is skewed
    pairs = odd.filter(F.size("suspects") > 0).select(*keys, "field", F.explode("suspects").alias("spelling"))
    known = pairs.join(changes, "spelling").groupBy(*keys, "field").agg(
        F.collect_set(F.struct("spelling", "representative")).alias("pairs"))
    joined = odd.join(known, [*keys, "field"], "left").select(*keys, "field", "value", "plain", "pairs")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table = {p["spelling"]: p["representative"] for ps in batch["pairs"] if ps is not None for p in ps}
            rewriter = Rewriter(table)
            batch["normal"] = [rewriter(p) if ps is not None else p for p, ps in zip(batch["plain"], batch["pairs"])]
            yield batch.loc[batch["normal"] != batch["value"], [*keys, "field", "value", "normal"]]

    return joined.mapInPandas(rewrite, f"{key_schema}, field string, value string, normal string")

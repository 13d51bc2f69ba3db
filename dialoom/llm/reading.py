"""Reading level of each document.

A language's words are ranked by their frequency in the corpus. The coverage rank of a document at
share q is the size of the smallest frequency-ranked vocabulary that covers a share q of its words.
Coverage ranks at several shares and the complexity of the sentences are calibrated to the raters'
levels by least squares; the sums of the normal equations come from SQL over all labels.

Words are letter runs in scripts with spaces and pairs of neighbouring characters in Chinese and
Japanese. Words that are nearly always capitalised are names and carry no rank; all others count, those
outside the vocabulary with the rank behind it.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.session import cut_lineage

#: Shares of a document's words that the vocabularies have to cover.
SHARES = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
#: Size of the ranked vocabulary of a language; rarer words share the rank behind it.
VOCABULARY = 30_000
#: Languages with a vocabulary of their own, the most frequent ones first.
LANGUAGES = 32
MIN_CHARS = 80
#: A word with this share of capitalised uses is a name.
NAME_SHARE = 0.9

_WORD = re.compile(r"[^\W\d_]+")
_MARKUP = re.compile(r"<[^<>]*>|&#?\w+;")
_LABEL = re.compile(r"^[ \t]*\[?\d{1,2}:\d\d:\d\d[.,\d]*\]?\s*[^:：\n]+[:：]", re.M)
_TIME = re.compile(r"\d:\d\d:\d\d")
_SENTENCE_END = re.compile(r"[.!?。！？…]+")
_COMMA = re.compile(r"[,，、;；]")
#: Pieces that are remembered between documents.
_REMEMBERED = 400_000
_ENDS, _COMMAS = ".!?。！？…\n", ",，、;；"
_N_FEATURES = len(SHARES) + 6


def _clean(text: str) -> str:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if "<" in text or "&" in text:
        text = _MARKUP.sub(" ", text)
    if _TIME.search(text):
        text = _LABEL.sub("", text)
    return text


def _cjk(points: np.ndarray) -> np.ndarray:
    return ((points >= 0x3040) & (points <= 0x30FF)) | ((points >= 0x3400) & (points <= 0x4DBF)) | ((points >= 0x4E00) & (points <= 0x9FFF))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)


def is_cjk(text: str) -> bool:
    """More Chinese or Japanese characters than others, spaces aside, in at least a third of the text."""
    points = _points(text)
    return bool(3 * _cjk(points).sum() > (points > 32).sum())


def _pairs(points: np.ndarray) -> np.ndarray:
    inside = _cjk(points)
    at = np.flatnonzero(inside[:-1] & inside[1:])
    return (points[at] << 21) | points[at + 1]


def _pair_name(key: int) -> str:
    return chr(key >> 21) + chr(key & 0x1FFFFF)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per part of a partition: (lang, word, n, n_capital), summed before anything is shuffled."""
    total: dict[tuple[str, str], list[int]] = {}

    def flush() -> pd.DataFrame:
        out = pd.DataFrame([(a, b, n, c) for (a, b), (n, c) in total.items()], columns=["lang", "word", "n", "n_capital"])
        total.clear()
        return out

    for batch in batches:
        pieces: dict[str, Counter] = {}
        pairs: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            text = _clean(text)
            if is_cjk(text):
                pairs.setdefault(lang, []).append(_pairs(_points(text)))
            else:
                pieces.setdefault(lang, Counter()).update(text.split())
        for lang, found in pairs.items():
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            for key, k in zip(keys.tolist(), n.tolist()):
                total.setdefault((lang, _pair_name(key)), [0, 0])[0] += k
        for lang, counter in pieces.items():
            for piece, k in counter.items():
                for word in _WORD.findall(piece):
                    low = word.lower()
                    entry = total.setdefault((lang, low), [0, 0])
                    entry[0] += k
                    entry[1] += k * (word != low)
        if len(total) > 300_000:
            yield flush()
    yield flush()


def word_counts(docs: DataFrame, size: int = VOCABULARY, languages: int = LANGUAGES) -> DataFrame:
    """(lang, word, n, n_capital) over all texts. One without a language counts for the one whose vocabulary, ranked without such texts, knows most of its words."""
    schema = "lang string, word string, n bigint, n_capital bigint"
    texts = docs.filter("text is not null").select("lang", "text")

    def summed(counted: DataFrame) -> DataFrame:
        return cut_lineage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("n_capital").alias("n_capital")))

    words, unnamed = summed(texts.filter("lang is not null").mapInPandas(_counts, schema)), texts.filter("lang is null")
    if unnamed.isEmpty():
        return words
    shared = docs.sparkSession.sparkContext.broadcast(_word_lists(_ranked(words, size, languages)))

    def guess(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = {lang: _Ranks(w) for lang, w in shared.value.items()} or {"": _Ranks([])}
        for batch in batches:
            cleaned = batch["text"].map(_clean)
            yield batch.assign(lang=[max(ranks, key=lambda option: _features(text, ranks[option])[1]) for text in cleaned])

    return summed(words.unionByName(unnamed.mapInPandas(guess, "lang string, text string").mapInPandas(_counts, schema)))


def _most_used(words: DataFrame, which: Column, languages: int) -> DataFrame:
    """The words for which `which` holds, of the languages with most words of any kind."""
    most = words.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(languages).select("lang")
    return words.filter(which).join(F.broadcast(most), "lang")


def _ranked(words: DataFrame, size: int, languages: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    return (_most_used(words, F.col("n_capital") < NAME_SHARE * F.col("n"), languages)
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)  # in this form Spark keeps the first rows of each task only
            .select("lang", "word", (F.col("place") - 1).alias("rank")))


def vocabularies(docs: DataFrame, size: int = VOCABULARY, languages: int = LANGUAGES) -> DataFrame:
    """(lang, word, rank): the `size` most frequent words of each of the `languages` most frequent languages; 0 is the first rank."""
    return _ranked(word_counts(docs, size, languages), size, languages)


def _word_lists(vocabulary: DataFrame) -> dict[str, list[str]]:
    words: dict[str, list[str]] = {}
    for lang, word, _ in vocabulary.orderBy("lang", "rank").collect():  # at most VOCABULARY * LANGUAGES words
        words.setdefault(lang, []).append(word)
    return words


def _mark(word: str) -> int:
    """Eight bytes that stand for a word."""
    return int.from_bytes(blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def name_marks(words: DataFrame, languages: int = LANGUAGES) -> dict[str, np.ndarray]:
    """lang -> the sorted marks of its names, all of them; eight bytes a name reach the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(lang, np.array([_mark(w) for w in part], dtype=np.uint64).tobytes()) for lang, part in batch.groupby("lang")["word"]]
            yield pd.DataFrame(out, columns=["lang", "marks"])

    names = _most_used(words, F.col("n_capital") >= NAME_SHARE * F.col("n"), languages)
    parts: dict[str, list[bytes]] = {}
    for lang, marks in names.select("lang", "word").mapInPandas(run, "lang string, marks binary").collect():
        parts.setdefault(lang, []).append(bytes(marks))
    return {lang: np.sort(np.frombuffer(b"".join(p), dtype=np.uint64)) for lang, p in parts.items()}


class _Ranks:
    """The ranked vocabulary of one language and the marks of its names; `pieces` remembers what pieces of text consist of."""

    def __init__(self, words: list[str], names: np.ndarray | None = None):
        self.rank = {w: k for k, w in enumerate(words)}
        self.unknown = len(words)
        self.names = np.zeros(0, dtype=np.uint64) if names is None else names
        pairs = sorted((ord(w[0]) << 21 | ord(w[1]), k) for w, k in self.rank.items() if len(w) == 2)
        self.keys = np.array([k for k, _ in pairs] or [-1], dtype=np.int64)
        self.at = np.array([k for _, k in pairs] or [0], dtype=np.int64)
        self.pieces: dict[str, range] = {}
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def of(self, word: str) -> int:
        """The rank of a word in lower case: that behind the vocabulary for a word outside it, -1 for a name."""
        rank = self.rank.get(word)
        if rank is None:
            mark = np.uint64(_mark(word))
            at = self.names.searchsorted(mark)
            rank = -1 if at < len(self.names) and self.names[at] == mark else self.unknown
        return rank

    def piece(self, piece: str) -> range:
        """The numbers of the rows of a piece. A row for each word: its rank or -1, letters, long words, commas, sentence ends, words; the marks stand in the last one."""
        ranked = [(w, self.of(w.lower())) for w in _WORD.findall(piece)]
        rows = [(rank, len(w), int(len(w) >= 9), 0, 0, 1) if rank >= 0 else (-1, 0, 0, 0, 0, 1) for w, rank in ranked] or [(-1, 0, 0, 0, 0, 0)]
        rows[-1] = (*rows[-1][:3], len(_COMMA.findall(piece)), len(_SENTENCE_END.findall(piece)), rows[-1][5])
        codes = self.pieces[piece] = range(len(self.rows), len(self.rows) + len(rows))
        self.rows += rows
        return codes

    def forget(self) -> None:
        self.pieces, self.rows = {}, []


def _spaced(text: str, ranks: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float, float]:
    if len(ranks.pieces) > _REMEMBERED:
        ranks.forget()
    get, codes = ranks.pieces.get, []
    for line in text.split("\n"):
        pieces = line.split()
        for piece in pieces:
            codes += get(piece) or ranks.piece(piece)
        if pieces:
            codes.append(-1)
    rows = np.array([ranks.rows[c] if c >= 0 else (-1, 0, 0, 0, 1, 0) for c in codes] or [(-1, 0, 0, 0, 1, 0)], dtype=np.int64)
    known = rows[:, 0] >= 0
    n = max(1, int(known.sum()))
    sentence = np.cumsum(rows[:, 4] > 0) - (rows[:, 4] > 0)
    words = np.bincount(sentence, weights=known)
    commas = np.bincount(sentence, weights=rows[:, 3])
    seen = int((known & (rows[:, 0] < ranks.unknown)).sum()) / max(1, int(rows[:, 5].sum()))
    return rows[known, 0], words, commas, rows[:, 1].sum() / n, rows[:, 2].sum() / n, seen


def _unspaced(text: str, ranks: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float, float]:
    points = _points(text)
    pairs = _pairs(points)
    at = np.minimum(np.searchsorted(ranks.keys, pairs), len(ranks.keys) - 1)
    hit = ranks.keys[at] == pairs
    inside = _cjk(points)
    end = np.isin(points, [ord(c) for c in _ENDS])
    sentence = np.cumsum(end) - end
    words = np.bincount(sentence, weights=inside)
    commas = np.bincount(sentence, weights=np.isin(points, [ord(c) for c in _COMMAS]))
    ideographs = (inside & (points >= 0x3400)).sum() / max(1, inside.sum())
    return np.where(hit, ranks.at[at], ranks.unknown), words, commas, float(ideographs), 0.0, float(hit.mean()) if len(hit) else 0.0


def _features(text: str, ranks: _Ranks) -> tuple[list[float], float]:
    found, words, commas, letters, long, seen = _unspaced(text, ranks) if is_cjk(text) else _spaced(text, ranks)
    real = words >= 2
    words, commas = (words[real], commas[real]) if real.any() else (np.ones(1), np.zeros(1))
    if not len(found):
        found = np.array([ranks.unknown])
    ordered = np.log1p(np.sort(found))
    last = len(ordered) - 1
    cover = [float(ordered[min(last, int(np.ceil(q * len(ordered))) - 1)]) for q in SHARES]
    return [*cover, float(ordered.mean()), float(np.log(words.mean())), float(commas.mean()), float((commas >= 1).mean()),
            float((commas >= 2).mean()), letters + 4 * long], seen


def document_features(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", names: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(id_col, lang, x array<double>): a row per document with at least MIN_CHARS characters.

    A null language becomes the one whose vocabulary knows most of the words; a language without a
    vocabulary keeps its name and is measured by that language's.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_word_lists(vocabulary), names or {}))
    key_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, marks = shared.value
        ranks = {lang: _Ranks(w, marks.get(lang)) for lang, w in words.items()} or {"": _Ranks([])}
        for batch in batches:
            out = []
            for key, lang, text in zip(batch["key"], batch["lang"], batch["text"]):
                text = _clean(text)
                options = [lang] if lang in ranks else list(ranks)
                scored = []
                for option in options:
                    x, seen = _features(text, ranks[option])
                    scored.append((seen, option, x))
                seen, option, x = max(scored, key=lambda s: s[0])
                out.append((key, lang if isinstance(lang, str) else option, x))
            yield pd.DataFrame(out, columns=["key", "lang", "x"])

    long = docs.filter(F.char_length("text") >= MIN_CHARS).select(F.col(id_col).alias("key"), "lang", "text")
    return long.mapInPandas(run, f"key {key_type}, lang string, x array<double>").withColumnRenamed("key", id_col)


def _expand(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -4, 4)
    return np.concatenate([np.ones((len(z), 1)), z, z**2], axis=1)


def calibrate(features: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """lang -> (mean, spread, weights) by least squares on every label; the key "" holds the model of all languages together.

    The sums of the normal equations are aggregated in SQL; what reaches the driver is bounded by the
    number of languages and features.
    """
    n = _N_FEATURES
    level = labels.filter("level between 1 and 4").groupBy(id_col).agg(F.sum("level").alias("level"), F.count("*").alias("raters"))
    known = features.join(level, id_col)
    both = F.explode(F.array(F.col("lang"), F.lit("")))
    moments = known.select(both.alias("lang"), "x").groupBy("lang").agg(
        F.count("*").alias("n"), *[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(n)],
        *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(n)]).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    scale = {r.lang: (np.array([r[f"m{k}"] for k in range(n)]), np.array([max(r[f"s{k}"], 1e-6) for k in range(n)])) for r in moments}

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name in ["", *batch["lang"].unique()]:
                part = batch if name == "" else batch[batch["lang"] == name]
                if name not in scale or not len(part):
                    continue
                a = _expand(np.stack(part["x"].to_numpy()), *scale[name])
                w = part["raters"].to_numpy(dtype=float)[:, None]
                s = np.concatenate([(a * w).T @ a, a.T @ part["level"].to_numpy(dtype=float)[:, None]], axis=1)
                sums[name] = sums.get(name, 0) + s
        out = [(k, i, j, float(v)) for k, s in sums.items() for (i, j), v in np.ndenumerate(s)]
        yield pd.DataFrame(out, columns=["lang", "i", "j", "v"])

    size = 2 * n + 1
    total = known.select("lang", "x", "level", "raters").mapInPandas(products, "lang string, i int, j int, v double")
    matrix: dict[str, np.ndarray] = {}
    for lang, i, j, v in total.groupBy("lang", "i", "j").agg(F.sum("v")).collect():
        matrix.setdefault(lang, np.zeros((size, size + 1)))[i, j] = v
    models = {}
    for lang, m in matrix.items():
        if lang == "" or m[0, 0] >= 4 * size:  # too few labels: the common model serves the language
            models[lang] = (*scale[lang], np.linalg.solve(m[:, :size] + 0.1 * np.eye(size), m[:, size]))
    return models


def levels(features: DataFrame, models: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]], id_col: str = "doc_id") -> DataFrame:
    """(id_col, level int, score double) of every row of `features`; without any label the level is null."""
    key_type = features.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = np.full(len(batch), np.nan)
            names = batch["lang"].where(batch["lang"].isin(list(models)), "")
            for name in names.unique():
                if name in models:
                    at = np.flatnonzero((names == name).to_numpy())
                    mean, spread, weights = models[name]
                    score[at] = _expand(np.stack(batch["x"].to_numpy()[at]), mean, spread) @ weights
            level = pd.Series(np.clip(np.floor(np.nan_to_num(score) + 0.5), 1, 4)).astype("Int32").mask(np.isnan(score))
            yield pd.DataFrame({"key": batch["key"], "level": level, "score": score})

    renamed = features.withColumnRenamed(id_col, "key")
    return renamed.mapInPandas(run, f"key {key_type}, level int, score double").withColumnRenamed("key", id_col)


def reading_levels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, level, score): the level 1 to 4 of every document with at least MIN_CHARS characters of text.

    docs: (id_col, text, lang); other columns are not read. Null, empty and short texts give no row,
    repeated rows give a row each, an empty table gives none. Texts are read whole.
    """
    docs = docs.select(id_col, "text", "lang")
    words = word_counts(docs)
    features = cut_lineage(document_features(docs, _ranked(words, VOCABULARY, LANGUAGES), id_col, name_marks(words)))
    return levels(features, calibrate(features, labels, id_col), id_col)

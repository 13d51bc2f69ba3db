"""Encoding of a corpus with a public byte-level BPE tokenizer.

The merges run as batched numpy rounds: the symbols of many words lie in one flat array, the pairs of
a round are looked up by binary search over the sorted pair keys, and every word merges its
lowest-ranked pair. Words that have been encoded before come from a pool, which only saves time.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files; every function here takes another one as a parameter.
TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the pattern that splits text into words before the merges of this vocabulary.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NO_RANK = np.iinfo(np.int64).max


class Merges:
    """The merge table of a byte-level BPE vocabulary as sorted arrays (about 1 MB for 50,000 merges)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, names = model["vocab"], _byte_names()
        self.size = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[names[b]] for b in range(256)], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made, self.rank = keys[order], made[order], order.astype(np.int64)
        # bytes that stand side by side in some token: between any others no merge can reach across
        byte = np.array([[names.index(c) for c in pair] for pair in {t[k : k + 2] for t in vocab for k in range(len(t) - 1)} if set(pair) <= set(names)])
        self.side = np.zeros((256, 256), dtype=bool)
        self.side[byte[:, 0], byte[:, 1]] = True

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and the number of ids of each word."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.of_byte[data]
        owner = np.repeat(np.arange(len(words)), sizes)
        # words fall apart where no merge reaches across, which leaves long words few rounds
        unit = np.append(False, (owner[:-1] != owner[1:]) | ~self.side[data[:-1], data[1:]])[: len(data)]
        word = np.cumsum(unit)
        of_unit = owner[np.append(True, unit[1:])[: len(data)]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.rank[at], _NO_RANK), _NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            length = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), length)
            over = least == _NO_RANK
            if over.any():
                done.append((word[over], sym[over]))
            merge = (rank == least) & ~over
            # a pair that overlaps itself (aaa) merges from the left: every second place of such a run
            places = np.flatnonzero(merge)
            if len(places):
                run = np.append(True, np.diff(places) != 1)
                start = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - start) % 2 == 0]
                sym[places] = self.made[at[places]]
                keep = ~over
                keep[places + 1] = False
                sym, word = sym[keep], word[keep]
            else:
                break
        if not done:
            return np.zeros(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        ids = np.concatenate([s for _, s in done])[order].astype(np.int32)
        return ids, np.bincount(of_unit[word], minlength=len(words))


def _byte_names() -> list[str]:
    """The character by which the vocabulary file writes each byte: printable bytes stand for themselves,
    the others follow from code point 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class _Codes(dict):
    """Piece of text -> its number in the pool; unknown pieces get the next number and are noted."""

    def __init__(self, next_code: Iterator[int], prefix: str = ""):
        self.next_code, self.prefix = next_code, prefix
        self.new: list[str] = []
        self.new_codes: list[int] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = next(self.next_code)
        self.new.append(self.prefix + piece)
        self.new_codes.append(code)
        return code

    def taken(self) -> tuple[list[str], np.ndarray]:
        new, codes = self.new, np.array(self.new_codes, dtype=np.int64)
        self.new, self.new_codes = [], []
        return new, codes


class Encoder:
    """Encodes batches of texts. The pool of known pieces is emptied beyond `pool_ids` ids, which bounds memory."""

    def __init__(self, merges: Merges, pool_ids: int = 8_000_000):
        self.merges, self.limit = merges, pool_ids
        self.pattern = regex.compile(WORD_PATTERN)
        # a blank between a blank and a blank or the end would not start a word
        self.odd = regex.compile(r"\s (?=\s|\Z)")
        self._clear()

    def _clear(self) -> None:
        codes = count()
        self.words, self.first, self.later = _Codes(codes), _Codes(codes), _Codes(codes, " ")
        self.pool = np.zeros(0, dtype=np.int32)
        self.size = self.start = np.zeros(0, dtype=np.int64)

    def _learn(self) -> None:
        pieces, piece_codes = self.first.taken()
        more, more_codes = self.later.taken()
        split = [self.pattern.findall(x) for x in pieces + more]
        words = self.words
        of_piece = np.array([words[w] for w in chain.from_iterable(split)], dtype=np.int64)
        new, codes = words.taken()
        self._store(codes, *self.merges.encode_words([w.encode("utf-8", "surrogatepass") for w in new]))
        if split:
            owner = np.repeat(np.arange(len(split)), [len(x) for x in split])
            sizes = np.bincount(owner, weights=self.size[of_piece], minlength=len(split)).astype(np.int64)
            ids = self.pool[_spans(self.start[of_piece], self.size[of_piece])]
            self._store(np.append(piece_codes, more_codes), ids, sizes)

    def _store(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if not len(codes):
            return
        room = int(codes.max()) + 1 - len(self.size)
        if room > 0:
            self.size = np.append(self.size, np.zeros(room, dtype=np.int64))
            self.start = np.append(self.start, np.zeros(room, dtype=np.int64))
        self.start[codes] = len(self.pool) + np.cumsum(sizes) - sizes
        self.size[codes] = sizes
        self.pool = np.append(self.pool, ids)

    def _codes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pool) > self.limit:
            self._clear()
        first, later, words, odd, findall = self.first, self.later, self.words, self.odd.search, self.pattern.findall
        codes: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            before = len(codes)
            if text.count(" ") * 24 < len(text) or odd(text):
                codes += [words[w] for w in findall(text)]
            else:  # a blank before anything else always starts a word, so texts fall apart there
                pieces = text.split(" ")
                if pieces[0]:
                    codes.append(first[pieces[0]])
                codes += [later[p] for p in pieces[1:]]
            counts[k] = len(codes) - before
        self._learn()
        return np.array(codes, dtype=np.int64), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text; 0 for empty and null texts."""
        codes, counts = self._codes(texts)
        ids = self.pool[_spans(self.start[codes], self.size[codes])]
        return ids, _per_text(self.size[codes], counts)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        codes, counts = self._codes(texts)
        return _per_text(self.size[codes], counts)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _per_text(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(sizes))
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def _slices(texts: pa.Array, limit: int = 16_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about `limit` bytes of text, one row at least."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    total, low = np.cumsum(size), 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + limit, side="right")))
        yield low, high
        low = high


def _shared(df: DataFrame, tokenizer: str, tokenizer_dir: str):
    path = os.path.join(tokenizer_dir, f"{tokenizer}.json")
    return df.sparkSession.sparkContext.broadcast(Merges(path))  # bounded by the vocabulary, about 1 MB


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "ids",
                  tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id_col, out_col array<int>): the token ids of every row's whole text, without special tokens.

    Null and empty texts give an empty list. Rows are independent: repeated rows and null ids stay as
    they are, other columns are not read, an empty table gives an empty table. No shuffle; a text of any
    length is encoded whole.
    """
    merges = _shared(df, tokenizer, tokenizer_dir)
    pair = df.select(df[id_col].alias("key"), df[text_col].alias("text"))
    key_type = pair.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges.value)
        for batch in batches:
            for low, high in _slices(batch.column(1)):
                ids, sizes = encoder.encode(batch.column(1).slice(low, high - low).to_pylist())
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists], ["key", "ids"])

    out = pair.mapInArrow(run, f"key {key_type}, ids array<int>")
    return out.toDF(id_col, out_col)


def count_tokens(df: DataFrame, text_col: str = "text", out_col: str = "n_tokens", tokenizer: str = "byte_bpe_50k",
                 tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """The other columns of `df` with the number of tokens of `text_col` in its place (0 for null and empty texts)."""
    merges = _shared(df, tokenizer, tokenizer_dir)
    rest = [c for c in df.columns if c != text_col]
    if out_col in rest:
        raise ValueError(f"column {out_col} is already there")
    pair = df.select(*rest, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges.value)
        for batch in batches:
            texts = batch.column(len(rest))
            for low, high in _slices(texts):
                n = encoder.count(texts.slice(low, high - low).to_pylist())
                columns = [batch.column(k).slice(low, high - low) for k in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], [*rest, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pair.schema.fields[:-1])
    return pair.mapInArrow(run, f"{schema}, `{out_col}` bigint" if schema else f"`{out_col}` bigint")


def tokenizer_callable(tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> Callable[[str], list[int]]:
    """A plain function text -> ids, for tests and small uses."""
    encoder = Encoder(Merges(os.path.join(tokenizer_dir, f"{tokenizer}.json")))
    return lambda text: encoder.encode([text])[0].tolist()

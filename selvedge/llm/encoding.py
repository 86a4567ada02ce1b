"""Encoding whole corpora with public tokenizers, by a monoid tree reduction over each text.

The element of a stretch of text is its list of token ids. Two neighbours a and b are joined by
re-encoding a window around their seam; the window grows until it starts and ends at stable
points, and the tokens outside it are kept as they are. A stable point is a place where the
tokenizer always ends one pre-token and begins another, whatever surrounds it: between a
character that is no white space and one that is, after a letter before a non-letter, after a
digit before a non-digit. No pre-token of the byte-level pattern runs across such a place, and
the only lookahead of that pattern is for white space, so neither side depends on the other.
Joining is associative and gives exactly the ids of the whole text. Decoding goes up the same
tree by concatenating bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvedge.functions.skew import spread_for_cpu
#: Characters that are encoded in one piece; a longer text is halved until its parts are no longer than this.
LEAF_CHARS = 16_384
#: First half-width in characters of the window around a seam.
WINDOW_CHARS = 64
#: Characters encoded at a time by one task.
CHUNK_CHARS = 2_000_000

SPACES = r"[ \t\n\r]"
STABLE = regex.compile(rf"(?<=\p{{L}})(?=\P{{L}})|(?<=\p{{N}})(?=\P{{N}})|(?<=[\p{{L}}\p{{N}}\p{{P}}\p{{S}}])(?={SPACES})")


def tokenizer_path(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Where the vocabulary file lies: folder, else the environment's TOKENIZERS_DIR, else /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), name)


class Encoder:
    """A byte-level BPE tokenizer: whole texts to ids and back."""

    def __init__(self, path: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to the other tasks
        from tokenizers import Tokenizer

        self.leaf, self.window = leaf, window
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._bytes: list[bytes] | None = None

    def pieces(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id. Byte-level vocabularies write a byte as a printable character: itself where it is one, else 256 onwards in order."""
        if self._bytes is None:
            plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
            back = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
            vocab = self.tokenizer.get_vocab()
            self._bytes = [b""] * (max(vocab.values()) + 1)
            for token, i in vocab.items():
                self._bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
            self._lengths = np.array([len(b) for b in self._bytes], np.int64)
        return self._bytes

    def decode(self, ids: list[int]) -> str:
        table = self.token_bytes()
        return b"".join(table[i] for i in ids).decode("utf-8", errors="replace")

    def _window(self, text: str, lo: int, mid: int, hi: int) -> tuple[int, int]:
        """The smallest tried window around mid within [lo, hi) that starts and ends at stable points or at the ends."""
        if STABLE.match(text, mid):
            return mid, mid
        a, b, width = lo, hi, self.window
        while True:
            left, right = max(lo, mid - width), min(hi, mid + width)
            found = None
            for m in STABLE.finditer(text, left, mid):
                if m.start() > left or left == 0:
                    found = m.start()
                    break
            after = STABLE.search(text, mid + 1, min(len(text), right + 1))
            a = found if found is not None else (lo if left == lo else None)
            b = after.start() if after and after.start() < hi else (hi if right == hi else None)
            if a is not None and b is not None:
                return a, b
            width *= 2

    def _cut(self, ids: np.ndarray, text_bytes: int, front: bool) -> np.ndarray:
        """The first (front) or last tokens of ids that cover exactly text_bytes bytes."""
        if not text_bytes:
            return ids[:0]
        self.token_bytes()
        sums = np.cumsum(self._lengths[ids] if front else self._lengths[ids[::-1]])
        n = int(np.searchsorted(sums, text_bytes)) + 1
        if sums[n - 1] != text_bytes:
            raise AssertionError("a token runs across a stable point")
        return ids[:n] if front else ids[len(ids) - n :]

    def join(self, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
        a, b = self._window(text, lo, mid, hi)
        if a == b:
            return np.concatenate([left, right])
        kept_left = self._cut(left, len(text[lo:a].encode()), True)
        kept_right = self._cut(right, len(text[b:hi].encode()), False)
        return np.concatenate([kept_left, np.array(self.pieces([text[a:b]])[0], np.int32), kept_right])

    def _leaves(self, lo: int, hi: int) -> list[tuple[int, int]]:
        if hi - lo <= self.leaf:
            return [(lo, hi)]
        mid = (lo + hi) // 2
        return self._leaves(lo, mid) + self._leaves(mid, hi)

    def _reduce(self, text: str, lo: int, hi: int, leaves: Iterator[list[int]]) -> np.ndarray:
        if hi - lo <= self.leaf:
            return np.array(next(leaves), np.int32)
        mid = (lo + hi) // 2
        left = self._reduce(text, lo, mid, leaves)
        return self.join(text, lo, mid, hi, left, self._reduce(text, mid, hi, leaves))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for null and empty ones."""
        spans = [self._leaves(0, len(t)) if t else [] for t in texts]
        parts = iter(self.pieces([t[a:b] for t, s in zip(texts, spans) for a, b in s]))
        return [self._reduce(t, 0, len(t), parts) if t else np.array([], np.int32) for t in texts]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x.as_py() or "")
        if size >= CHUNK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _mapped(path: str, counts: bool, drop: str):
    out = pa.int64() if counts else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for a, b in _chunks(whole[drop]):
                batch = whole.slice(a, b - a)
                ids = enc.encode_all(batch[drop].to_pylist())
                if counts:
                    column = pa.array([len(x) for x in ids], out)
                else:
                    offsets = np.zeros(len(ids) + 1, np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else [], pa.int32()))
                names = [n for n in batch.schema.names if n != drop]
                yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], column], names=[*names, "n_tokens" if counts else "ids"])

    return run


def encode(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """keep and ids (array of int): each text's ids without special tokens; [] for null and empty texts.

    A narrow pass: rows stay where they are read (tables of fewer partitions than cores are spread), whole texts are encoded, and
    a text of any length is built up from leaves of LEAF_CHARS characters. keep must not hold a
    column named ids.
    """
    rows = spread_for_cpu(df.select(*keep, F.col(text).alias("_text")))
    return rows.mapInArrow(_mapped(path or tokenizer_path(), False, "_text"), f"{rows.drop('_text').schema.simpleString()[7:-1]}, ids: array<int>".lstrip(", "))


def count_tokens(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """keep and n_tokens: the length of each text in tokens; 0 for null and empty texts."""
    rows = spread_for_cpu(df.select(*keep, F.col(text).alias("_text")))
    return rows.mapInArrow(_mapped(path or tokenizer_path(), True, "_text"), f"{rows.drop('_text').schema.simpleString()[7:-1]}, n_tokens: bigint".lstrip(", "))


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids, by concatenating the bytes of its tokens; null for null."""
    where = path or tokenizer_path()

    @F.pandas_udf("string")
    def decode(batch: pd.Series) -> pd.Series:
        enc = encoder(where)
        return batch.map(lambda x: None if x is None else enc.decode(list(x)))

    return decode(ids)

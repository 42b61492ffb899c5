"""Texts as flat arrays, for operators that run on Arrow batches inside Spark tasks.

All helpers work on one chunk of rows at a time. A chunk holds a few MB of text (or one text, if
that is longer), so memory does not follow the number of rows in an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 1024
_U = np.uint64


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS
) -> Iterator[pa.RecordBatch]:
    """Cuts batches: at most ``rows`` rows, and ``limit`` bytes of ``column`` or one row, in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, side="right")))
            last = min(last, first + rows)
            yield batch.slice(first, last - first)
            first = last


def schema_with(df: DataFrame, columns: str) -> StructType:
    """The columns of ``df``, all nullable, and those of a DDL string."""
    own = [StructField(f.name, f.dataType) for f in df.schema]
    return StructType(own + list(StructType.fromDDL(columns)))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the n + 1 offsets of the texts; null counts as empty."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, starts, content = texts.buffers()
    offsets = np.frombuffer(starts, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    if content is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(content, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    return data, offsets.astype(np.int64) - int(offsets[0])


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit. Works in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers; a longer table starts with the shorter one."""
    start = _U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mixed((np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) ^ start)


#: Bytes of a word: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = True
_LETTERS = random_words(256, 1)


@dataclass
class Words:
    """Words of a chunk in order: byte spans, 64-bit hash, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # n + 1 positions in the arrays above, one span per text

    def texts(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES) -> Words:
    """Runs of word bytes; a word never crosses from one text into the next."""
    inside = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, _U), np.zeros(len(offsets), np.int64))
    kept = np.flatnonzero(inside)
    first = np.searchsorted(kept, starts)
    lengths = np.diff(first, append=len(kept))
    # arrays of 8 bytes a letter: two beside the values at most
    place = np.arange(len(kept))
    place -= np.repeat(first, lengths)
    letters = data[kept]
    del kept
    values = _LETTERS[letters]
    values *= (random_words(int(lengths.max()), 2) | _U(1))[place]
    del place
    hashes = mixed(np.add.reduceat(values, first) + lengths.astype(_U))
    return Words(starts, starts + lengths, hashes, np.searchsorted(starts, offsets))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and n + 1 bounds of the texts.

    A text of fewer words has one window of all its words; a text without words has none.
    """
    counts = np.diff(w.bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(w.bounds[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    stop = np.repeat(w.bounds[1:], n)
    odd = random_words(size, 3) | _U(1)
    out = np.zeros(len(first), _U)
    for k in range(size):
        there = first + k < stop
        out += np.where(there, w.hashes[np.minimum(first + k, len(w.hashes) - 1)], _U(0)) * odd[k]
    return mixed(out), bounds


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of every element, from the rows' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def reduced(op: np.ufunc, values: np.ndarray, bounds: np.ndarray, empty) -> np.ndarray:
    """``op`` over the elements of each row; rows without elements get ``empty``."""
    n = len(bounds) - 1
    out = np.full(n, empty, values.dtype if op is not np.logical_or else bool)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = op.reduceat(values, bounds[:-1][full])
    return out

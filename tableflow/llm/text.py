"""Words and hashes of whole Arrow batches, computed in numpy on the UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 19

# Per byte: what it becomes in a word, or 0 where it separates words.
_space = [0x20, *range(0x09, 0x0E)]
SPACED = np.arange(256, dtype=np.uint8)
SPACED[_space] = 0
ALPHANUMERIC = np.arange(256, dtype=np.uint8)
ALPHANUMERIC[: ord("0")] = 0
ALPHANUMERIC[ord("9") + 1 : ord("a")] = 0
ALPHANUMERIC[ord("z") + 1 : 128] = 0
ALPHANUMERIC[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)

_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def fold(doc_id: Column, folds: int) -> Column:
    """The fold a row belongs to: CRC-32 of its id as text, modulo the number of folds."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes (a longer row is a run of its own): the number of rows,
    their bytes, and where each row begins. A null is an empty text."""
    begins, data = _bytes(texts)
    for row, end in _cuts(begins, size):
        yield end - row, data[begins[row] : begins[end]], begins[row : end + 1] - begins[row]


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of a text column."""
    begins, _ = _bytes(batch.column(column))
    for row, end in _cuts(begins, size):
        yield batch.slice(row, end - row)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins (and the last one ends), and all bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, where, data = texts.buffers()
    begins = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return begins, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def _cuts(begins: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    row, last = 0, len(begins) - 1
    while row < last:
        end = max(row + 1, int(np.searchsorted(begins, begins[row] + size, side="right")) - 1)
        yield row, end
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base below the n-th, and their inverses, modulo 2 to the 64."""
    if n > max(_powers, default=-1):
        size = max(n, CHUNK_BYTES + 1)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers.clear()
        _powers[size] = (both[0], both[1])
    return next(iter(_powers.values()))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any span of the bytes follows."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the bytes; equal spans hash alike wherever they are."""
    _, down = powers(len(sums))
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a chunk of rows: byte spans, hashes, and the row of each word."""

    def __init__(self, rows: int, data: np.ndarray, begins: np.ndarray, table: np.ndarray):
        self.rows, self.begins, self.bytes = rows, begins, table[data]
        inside = np.zeros(len(data) + 1, dtype=bool)
        inside[: len(data)] = self.bytes != 0
        first = np.zeros(len(data) + 1, dtype=bool)
        first[begins] = True
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | first))
        self.ends = np.flatnonzero(before & (~inside | first))
        # The words of row r are those from bounds[r] to bounds[r + 1].
        self.bounds = np.searchsorted(self.starts, begins)
        self.counts = np.diff(self.bounds)
        self.row = np.repeat(np.arange(rows), self.counts)
        self.hashes = span_hashes(prefix_hashes(self.bytes), self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the words from each position on, and whether they lie in one row."""
        n = max(0, len(self.hashes) - size + 1)
        out = self.hashes[:n].copy()
        for j in range(1, size):
            out = out * np.uint64(_BASE) + self.hashes[j : j + n]
        return mix(out), self.row[:n] == self.row[size - 1 : size - 1 + n]

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value of every word, per row."""
        return np.bincount(self.row, weights=values, minlength=self.rows)


def lists(values: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=pa.list_(kind))

"""Words and hashes of many texts at once, as numpy arrays.

Texts come as Arrow batches. They are cut into chunks of whole texts of a few MB, so that
the arrays of a chunk stay small whatever the batch; one longer text is a chunk alone.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Chunk:
    """Rows ``first`` to ``first + len(starts)`` of a batch; ``data`` holds their bytes."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts in row order; a null is an empty text."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        begin, end = offsets[row], offsets[stop]
        cut = offsets[row : stop + 1] - begin
        yield Chunk(row, data[begin:end], cut[:-1], cut[1:])
        row = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(size, BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n at least."""
    return _powers(1 << max(21, int(n).bit_length()))


class Spans:
    """Hashes of any spans of one array of bytes, each in a few steps whatever its length."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.total[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.total[ends] - self.total[starts]) * self.down[starts]
        return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(32)))

    def every(self, n: int) -> np.ndarray:
        """The hash of each span of ``n`` bytes, by where it begins."""
        value = self.total[n:] - self.total[:-n]
        value *= self.down[: len(value)]
        value ^= np.uint64(n << 32)
        return mix(value)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span."""
    return Spans(data).hashes(starts, ends)


@dataclass
class Words:
    """Words of a chunk: byte spans, and for each text its first word and the one after."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    stop: np.ndarray


def words(chunk: Chunk, data: np.ndarray | None = None) -> Words:
    data = chunk.data if data is None else data
    inside = ~IS_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    begins = chunk.starts[chunk.starts < chunk.ends]
    starts[begins] = inside[begins]
    lasts = chunk.ends[chunk.starts < chunk.ends] - 1
    ends[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(
        starts, ends, np.searchsorted(starts, chunk.starts), np.searchsorted(starts, chunk.ends)
    )


def ngram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of tokens[i:i+n] for every i at which n tokens are left."""
    size = len(tokens) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(size, np.uint64(n))
    for j in range(n):
        out = (out ^ tokens[j : j + size]) * BASE
        out ^= out >> np.uint64(29)
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.repeat(starts - shift, lengths) + np.arange(total)


def row_of(first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For the items first..stop of every row, one after the other, the row's number."""
    return np.repeat(np.arange(len(first)), stop - first)

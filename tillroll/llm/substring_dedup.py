"""Substring de-duplication of word sequences with a compressed index per shard.

A shard's fragments (see ``repeats``) are indexed by their Burrows-Wheeler transform in a
wavelet tree of packed bits. Backward search then extends a match to the left by one word
in two rank queries per level. The documents' own fragments are streamed through it: for
every place the length of the longest indexed string that begins there, up to the window,
is its matching statistic, and the interval of the index that holds it says where it is.
Statistics that reach WINDOW_WORDS are reported with the interval's smallest document.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.repeats import NOBODY, Unit, without_repeats
from tillroll.llm.suffix_dedup import sorted_suffixes

WINDOW_WORDS = 13
ANCHOR_WORDS = 5


class BitVector:
    """Packed bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are ones."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Rank of any symbol; the levels go from the highest bit of a symbol to the lowest."""

    def __init__(self, symbols: np.ndarray, n_bits: int):
        self.n_bits = n_bits
        self.levels, self.zeros = [], []
        for bit in range(n_bits - 1, -1, -1):
            bits = (symbols >> bit) & 1
            self.levels.append(BitVector(bits))
            self.zeros.append(len(symbols) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        # Where the places of a symbol begin on the last level depends on the symbol alone.
        every = np.arange(1 << n_bits)
        self.begin = self._down(every, np.zeros_like(every))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` places lead on the last level, along the bits of a symbol."""
        for level, (vector, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbols >> (self.n_bits - 1 - level)) & 1 == 1
            ones = vector.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are the given one."""
        return self._down(symbols, at) - self.begin[symbols]


class FMIndex:
    """Backward search over pieces of symbols from 1 up; 0 ends a piece."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_symbols: int):
        # Each piece gets a 0 behind it; a suffix never looks beyond.
        sizes = ends - starts
        text = np.insert(symbols, ends, 0)
        ends = ends + np.arange(1, len(ends) + 1)
        self.order = sorted_suffixes(text, ends - sizes - 1, ends)[0]
        self.tree = WaveletTree(text[self.order - 1], max(1, int(n_symbols).bit_length()))
        counts = np.bincount(text, minlength=n_symbols + 2)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the strings with one more symbol in front."""
        base = self.smaller[symbols]
        return base + self.tree.rank(symbols, low), base + self.tree.rank(symbols, high)

    def matching_statistics(
        self, symbols: np.ndarray, at: np.ndarray, window: int, own: bool = False
    ):
        """For the places ``at``: length of the match that ends ``window`` symbols on.

        All places go a step back together, from the interval of their last symbol; a match
        that dies keeps its length. Also the interval of the matches of full length. ``own``
        says that the places are of the index itself: then a match of a single suffix is the
        place, and is followed no further.
        """
        last = symbols[at + window - 1]
        low, high = self.smaller[last], self.smaller[last + 1]
        length, least = (low < high).astype(np.int64), 2 if own else 1
        alive = np.arange(len(at))
        for step in range(1, window):
            alive = alive[high[alive] - low[alive] >= least]
            symbol = symbols[at[alive] + window - 1 - step]
            low[alive], high[alive] = self.extend(symbol, low[alive], high[alive])
            alive = alive[low[alive] < high[alive]]
            length[alive] += 1
        return length, low, high


def _range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high] for non-empty ranges, from minima of doubling widths."""
    out = np.empty(len(low), dtype=values.dtype)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    table, reach = values, 1
    for step in range(int(level.max(initial=0)) + 1):
        own = level == step
        out[own] = np.minimum(table[low[own]], table[high[own] - reach])
        table = np.minimum(table[:-reach], table[reach:])
        reach *= 2
    return out


def lowest_by_index(values, starts, ends, lows, window=WINDOW_WORDS) -> np.ndarray:
    """The solver: see ``repeats.Solver``. An index holds a piece once, with its smallest document."""
    distinct, symbols = np.unique(values, return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    index = FMIndex(symbols, starts, ends, len(distinct))
    docs = np.repeat(lows, ends - starts + 1)[index.order]
    left = np.repeat(ends, ends - starts) - np.arange(len(symbols))
    at = np.flatnonzero(left >= window)
    length, low, high = index.matching_statistics(symbols, at, window, own=True)
    lowest = np.full(len(symbols), NOBODY)
    full = length >= window
    lowest[at[full]] = _range_minimum(docs, low[full], high[full])
    return lowest


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept; one row for each row.

    Words are what stands between ASCII white space. Every word covered by WINDOW_WORDS
    words that also stand in a document with a smaller doc_id is removed; ``kept`` is the
    rest, joined by spaces, in UTF-8. A null text has no words. Rows with the same doc_id
    are one document as to "smaller"; a null doc_id is larger than any other. Words are
    told apart by 64-bit hashes.
    """
    unit = Unit(by_word=True, window=WINDOW_WORDS, gram=ANCHOR_WORDS)
    return without_repeats(docs, unit, lowest_by_index, id_column, text, **options).select(
        "doc_id", F.col("n_tokens").alias("n_words"), "n_removed", "n_spans", "kept"
    )

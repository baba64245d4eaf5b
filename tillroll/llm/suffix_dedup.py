"""Suffix-array de-duplication of byte strings.

A shard's fragments (see ``repeats``) are concatenated, their suffixes of WINDOW_BYTES or
more sorted, and the lengths of the common prefixes of neighbours (LCP) found: an enhanced suffix array. A scan
with a stack walks its tree of LCP intervals. An interval of length L holds all suffixes
that begin with one string of L bytes; if the bytes before them differ, the string can't
be extended to the left either, and the interval is a maximal repeat group with all its
occurrences, not only neighbouring ones. An occurrence in a fragment is one wherever that
fragment stands; equal fragments were combined before. A group's smallest document keeps its bytes, all
other occurrences of at least WINDOW_BYTES go.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import ragged
from tillroll.llm.repeats import NOBODY, Unit, without_repeats

WINDOW_BYTES = 50
ANCHOR_BYTES = 20


@dataclass
class SuffixArray:
    """Order of the suffixes, as places of their first token, and common prefix of each
    with the one before."""

    order: np.ndarray
    lcp: np.ndarray


def sorted_suffixes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the suffixes of at least ``least`` tokens in order, their tokens, and lengths.

    A suffix ends with its piece. Pieces are short, so a row of tokens holds any suffix,
    zeros behind its end; of rows that are then equal the shorter suffix comes first, and
    equal suffixes stay in their order of place.
    """
    left = np.repeat(ends, ends - starts) - np.arange(len(values))
    at = np.flatnonzero(left >= least)
    width = int((ends - starts).max())
    lengths = left[at].astype(np.uint16) if width < 1 << 16 else left[at]
    at = at[np.argsort(lengths, kind="stable")]
    if values.itemsize > 1:
        values = values.astype(np.uint32)
    padded = np.concatenate([values, np.zeros(width, values.dtype)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    rows *= np.arange(width) < left[at][:, None]
    if rows.itemsize > 1:
        rows = rows.astype(">u4")  # compared byte by byte
    order = np.argsort(rows.view(f"S{width * rows.itemsize}").ravel(), kind="stable")
    return at[order], rows[order], left[at[order]]


def suffix_array(values, starts, ends, least: int) -> SuffixArray:
    order, rows, left = sorted_suffixes(values, starts, ends, least)
    lcp = np.zeros(len(order), dtype=np.int64)
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    lcp[1:] = np.minimum(common, np.minimum(left[1:], left[:-1]))
    return SuffixArray(order, lcp)


def maximal_repeats(
    array: SuffixArray, before: np.ndarray, low: np.ndarray, least: int
) -> Iterator[tuple[int, int, int, int]]:
    """(length, first, last, lowest) of each left-diverse LCP interval of ``least`` or more.

    first and last are places in the order; ``before`` is the token before each suffix, -1
    where a piece begins, which differs from everything; ``low`` is each suffix's document.
    """
    lcp, order = array.lcp, array.order
    at = np.flatnonzero(lcp >= least)
    if not len(at):
        return
    # Only suffixes in some interval are scanned; lengths below ``least`` close them all.
    breaks = np.flatnonzero(np.diff(at) > 1) + 1
    firsts = at[np.append(0, breaks)] - 1
    stops = at[np.append(breaks, len(at)) - 1] + 1
    suffixes = order[ragged(firsts, stops - firsts)]
    every_char, every_low = before[suffixes].tolist(), low[suffixes].tolist()
    every_length = lcp[ragged(firsts, stops - firsts)].tolist()
    done = 0
    for first, stop in zip(firsts.tolist(), stops.tolist(), strict=True):
        begin, done = done, done + stop - first
        chars, lows = every_char[begin:done], every_low[begin:done]
        lengths = every_length[begin + 1 : done]
        stack: list[list[int]] = []  # length, left bound, common byte before (-1: diverse), lowest
        for i, length in enumerate([*lengths, 0]):
            bound, char, lowest = first + i, chars[i], lows[i]
            while stack and stack[-1][0] > length:
                size, bound, own, least_doc = stack.pop()
                char = own if own == char else -1
                lowest = min(lowest, least_doc)
                if char == -1:
                    yield size, bound, first + i, lowest
            if not length:
                break
            if stack and stack[-1][0] == length:
                top = stack[-1]
                top[2] = top[2] if top[2] == char else -1
                top[3] = min(top[3], lowest)
            else:
                stack.append([length, bound, char, lowest])


def lowest_by_suffixes(values, starts, ends, lows, window=WINDOW_BYTES) -> np.ndarray:
    """The solver: see ``repeats.Solver``."""
    low = np.repeat(lows, ends - starts)
    before = np.concatenate([[-1], values[:-1].astype(np.int64)])
    before[starts] = -1
    array = suffix_array(values, starts, ends, window)
    lowest = np.full(len(values), NOBODY)
    groups = list(maximal_repeats(array, before, low, window))
    if groups:
        length, first, last, least = (np.array(x) for x in zip(*groups, strict=True))
        count = last - first + 1
        places = array.order[ragged(first, count)]
        n_windows = np.repeat(length - window + 1, count)
        at = ragged(places, n_windows)
        np.minimum.at(lowest, at, np.repeat(np.repeat(least, count), n_windows))
    return lowest


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept; one row for each row.

    Every byte covered by a string of WINDOW_BYTES that also starts in a document with a
    smaller doc_id is removed; ``kept`` is what is left, as bytes, since a removed span
    may begin inside a character. A null text is empty. Rows with the same doc_id are
    one document as to "smaller"; a null doc_id is larger than any other.
    """
    unit = Unit(by_word=False, window=WINDOW_BYTES, gram=ANCHOR_BYTES)
    return without_repeats(docs, unit, lowest_by_suffixes, id_column, text, **options).select(
        "doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed", "n_spans", "kept"
    )

"""Language-model scores by stupid backoff, as joins of n-gram tables.

The n-grams of the training texts are counted per order; every table is hash-partitioned
by n-gram and also holds the counts of the n-gram's history, of its ending (the n-gram
without its first word) and of the ending's history. Texts to score are exploded into their
distinct n-grams of each order, joined to the table of that order and summed per document.

An n-gram that a table knows has an ending that the table below knows. So every word starts
from the share of the word alone, and each longer n-gram found adds what it is better than
its ending: log share - log share of the ending - log BACKOFF. The sum is the stupid-backoff
score, and n-grams that no table knows end at the join instead of going on to the next one.

The n-grams of ``k`` words are worked off in ``k`` slices of the hash space, one after the
other, so that what lies on the executors' disks at one time is about the same for all orders.

A document that is scored by a model of which it is a part must not be its own evidence:
its own counts are subtracted (``leave_out``), as if the model had been made without it.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import (
    BASE,
    CHUNK_BYTES,
    LOWER,
    Chunk,
    mix,
    ngram_hashes,
    ragged,
    span_hashes,
    text_chunks,
    words,
)
from tillroll.llm.common import discard, saved_at, text_or_empty

ORDER = 3
BACKOFF = 0.4
#: What a word never seen counts.
UNSEEN = 0.5
EXPLODED = ("rid", "g", "owns", "end_owns")
#: Texts are exploded so many bytes at a time that the arrays stay in a core's cache.
EXPLODED_BYTES = 1 << 18


def _word_hashes(chunk: Chunk):
    data = LOWER[chunk.data]
    found = words(chunk, data)
    return span_hashes(data, found.starts, found.ends), found.first, found.stop


def _in_slice(grams: np.ndarray, part: int, slices: int) -> np.ndarray:
    return np.flatnonzero(grams % np.uint64(slices) == np.uint64(part))


def _grams(order: int, part: int, slices: int):
    """Function for mapInArrow: texts to (g, history, ending) of each n-gram in them.

    An n-gram's history lacks its last word, its ending the first. Single words have neither:
    of them (g, n), part of the counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", CHUNK_BYTES if order == 1 else EXPLODED_BYTES):
                tokens, first, stop = _word_hashes(chunk)
                at = ragged(first, np.maximum(stop - first - order + 1, 0))
                grams = ngram_hashes(tokens, order)[at]
                chosen = _in_slice(grams, part, slices)
                at, grams = at[chosen], grams[chosen]
                if order > 1:  # few repeat in a chunk; the aggregate combines them
                    shorter = ngram_hashes(tokens, order - 1)
                    arrays = [x.view(np.int64) for x in (grams, shorter[at], shorter[at + 1])]
                    names = ["g", "history", "ending"]
                else:
                    grams, n = np.unique(grams, return_counts=True)
                    arrays, names = [grams.view(np.int64), n], ["g", "n"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)

    return count


def _paired(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Two counts in one long. A batch's texts have less than 2**31 bytes, so both fit."""
    return high << 32 | low


def _exploded(order: int, part: int, slices: int):
    """Function for mapInArrow: rows to their distinct n-grams of one order.

    Beside each n-gram is how often the row has it and its history (``owns``), its ending and
    the ending's history (``end_owns``), see ``_paired``. Of the empty n-gram a row has as many
    as words.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text", EXPLODED_BYTES):
                tokens, first, stop = _word_hashes(chunk)
                sizes = stop - first
                row = np.repeat(np.arange(len(sizes)), sizes)
                at = ragged(first, sizes)
                place = at - first[row]
                salt = mix(row.astype(np.uint64) * BASE)

                def ending_at(k: int, places: np.ndarray) -> np.ndarray:
                    """The n-grams of k words that end at these places."""
                    return ngram_hashes(tokens, k)[at[places] - k + 1]

                def own(k: int) -> np.ndarray:
                    """For each place, how often its row has the n-gram of k words ending there."""
                    if k <= 0:
                        return sizes[row]
                    places = np.flatnonzero(place >= k - 1)
                    _, group, n = np.unique(
                        mix(ending_at(k, places) ^ salt[places]),
                        return_inverse=True,
                        return_counts=True,
                    )
                    counts = np.zeros(len(at), dtype=np.int64)
                    counts[places] = n[group]
                    return counts

                places = np.flatnonzero(place >= order - 1)
                grams = ending_at(order, places)
                chosen = _in_slice(grams, part, slices)
                places, grams = places[chosen], grams[chosen]
                _, where, n = np.unique(
                    mix(grams ^ salt[places]), return_index=True, return_counts=True
                )
                by_row = np.argsort(where)
                places, grams, n = places[where[by_row]], grams[where[by_row]], n[by_row]
                before = places - 1 if order > 1 else places
                shorter = own(order - 1)
                take = pa.array(row[places] + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid").take(take),
                        pa.array(grams.view(np.int64)),
                        pa.array(_paired(n, shorter[before])),
                        pa.array(_paired(shorter[places], own(order - 2)[before])),
                    ],
                    names=list(EXPLODED),
                )

    return explode


class _Tables:
    """The n-gram tables of one order after the other, slice by slice.

    Only n-grams that occur ``least`` times are kept: with a document's own counts left out,
    one that occurs once is evidence for nobody.
    """

    def __init__(self, train: DataFrame, text: str, least: int):
        self.rows = train.select(text_or_empty(text).alias("text"))
        self.spark, self.least = train.sparkSession, least
        self.total = 0

    def counts(self, order: int, part: int, slices: int) -> DataFrame:
        names = ("g", "n") if order == 1 else ("g", "history", "ending")
        grams = self.rows.mapInArrow(
            _grams(order, part, slices), ", ".join(f"{c} long" for c in names)
        ).groupBy("g")
        if order == 1:
            return grams.agg(F.sum("n").alias("n"))
        return grams.agg(
            F.first("history").alias("history"),
            F.first("ending").alias("ending"),
            F.count("*").alias("n"),
        )

    def single_words(self) -> tuple[DataFrame, str]:
        counts, path = saved_at(self.counts(1, 0, 1), "grams-1", drop_shuffles=True)
        self.total = counts.agg(F.sum("n")).first()[0] or 0
        none = F.lit(None).cast("long")
        return counts.select(
            "g",
            "n",
            F.lit(self.total).cast("long").alias("past"),
            none.alias("n_end"),
            none.alias("past_end"),
        ), path

    def longer(
        self, order: int, part: int, slices: int, lower: DataFrame
    ) -> tuple[DataFrame, str]:
        """One slice: g, n, past, n_end, past_end. ``lower`` is the whole table below."""
        counts = self.counts(order, part, slices).filter(F.col("n") >= self.least)
        counts, path = saved_at(counts, f"counts-{order}", drop_shuffles=True)
        history = lower.select(F.col("g").alias("history"), F.col("n").alias("past"))
        ending = lower.select(
            F.col("g").alias("ending"), F.col("n").alias("n_end"), F.col("past").alias("past_end")
        )
        table = counts.join(history, "history").join(ending, "ending")
        table = table.select("g", "n", "past", "n_end", "past_end")
        table, table_path = saved_at(table, f"grams-{order}", drop_shuffles=True, hash_joins=True)
        discard(self.spark, path)
        return table, table_path


def _summed(
    exploded: DataFrame, table: DataFrame, k: int, order: int, leave_out: bool, total: int
) -> DataFrame:
    """rid, score, n, n_words: what the n-grams of order ``k`` add to each row's score."""

    low = F.lit((1 << 32) - 1)
    exploded = exploded.select(
        "rid",
        "g",
        F.shiftright("owns", 32).alias("own"),
        F.col("owns").bitwiseAND(low).alias("own_past"),
        F.shiftright("end_owns", 32).alias("own_end"),
        F.col("end_owns").bitwiseAND(low).alias("own_past_end"),
    )

    def others(counted: str, own: str, absent: Column | None = None) -> Column:
        count = F.col(counted) if absent is None else F.coalesce(counted, absent)
        return (count - F.col(own) if leave_out else count).cast("double")

    if k == 1:
        n = F.greatest(others("n", "own", F.lit(0)), F.lit(UNSEEN))
        past = F.greatest(others("past", "own_past", F.lit(total)), F.lit(1.0))
        met = exploded.join(table, "g", "left").withColumn(
            "gain", F.log(n / past) + math.log(BACKOFF) * (order - 1)
        )
        words_counted, n_words = F.sum("own"), F.max("own_past")
    else:
        n, past = others("n", "own"), others("past", "own_past")
        n_end, past_end = others("n_end", "own_end"), others("past_end", "own_past_end")
        met = (
            exploded.join(table, "g")
            .filter((n > 0) & (past > 0) & (n_end > 0) & (past_end > 0))
            .withColumn("gain", F.log(n / past) - F.log(n_end / past_end) - math.log(BACKOFF))
        )
        words_counted = n_words = F.lit(0).cast("long")
    return met.groupBy("rid").agg(
        F.sum(F.col("own") * F.col("gain")).alias("score"),
        words_counted.alias("n"),
        n_words.alias("n_words"),
    )


def stupid_backoff(
    docs: DataFrame,
    train: DataFrame,
    leave_out: bool = True,
    id_column: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    slices: int = 1,
) -> DataFrame:
    """doc_id, n_words, score (sum of natural logarithms), mean_score; one row for each row.

    Words are what stands between ASCII white space, A-Z lower-cased. ``leave_out`` needs
    ``docs`` to be part of ``train``. A word the model lacks counts UNSEEN times. A text
    without words, or null, has score 0 and no mean. Sums are rounded to 6 digits.

    ``slices`` times as many slices need less disk and read the texts more often; the result
    does not depend on it.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text")
    )
    document = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    keyed = keyed.withColumn("rid", F.xxhash64(document, "text"))
    rows = keyed.select("rid", "text")
    tables = _Tables(train, text, 2 if leave_out else 1)
    lower, path = tables.single_words()
    below, scores = [path], None
    for k in range(1, order + 1):
        now, paths, parts = None, [], slices * k if k > 1 else 1
        for part in range(parts):
            table = lower
            if k > 1:
                table, path = tables.longer(k, part, parts, lower)
                paths.append(path)
                now = table if now is None else now.unionAll(table)
            exploded = rows.mapInArrow(
                _exploded(k, part, parts),
                ", ".join(f"{c} long" for c in EXPLODED),
            )
            part_sums = _summed(exploded, table, k, order, leave_out, tables.total)
            part_sums = saved_at(
                part_sums, f"scores-{k}", drop_shuffles=True, hash_joins=True
            )[0]
            scores = part_sums if scores is None else scores.unionAll(part_sums)
            if k == order and k > 1:
                discard(spark, paths.pop())
        if k > 1:
            for path in below:
                discard(spark, path)
            lower, below = now, paths
    for path in below:
        discard(spark, path)
    # Rows that repeat a doc_id and a text were summed together.
    scores = scores.groupBy("rid").agg(
        (F.sum("score") * F.max("n_words") / F.sum("n")).alias("score"),
        F.max("n_words").alias("n_words"),
    )
    return keyed.select("doc_id", "rid").join(scores, "rid", "left").select(
        "doc_id",
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"),
        F.round(F.col("score") / F.col("n_words"), 6).alias("mean_score"),
    )

"""Packing texts into padded batches: optimal length buckets, then token budgets.

A batch pads its texts to one length. Lengths are counted in one global histogram; a
dynamic program over it finds the at most ``n_buckets`` upper bounds with the least
padding in all. Texts of a bucket fill batches of as many rows as the token budget holds
at the bucket's length; a longer text than the budget is a batch of its own.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.arrays import ragged
from tillroll.llm.common import discard, saved_at
from tillroll.llm.token_cache import token_number

N_BUCKETS = 16
TOKEN_BUDGET = 16384
ADDED = ("n_tokens", "bucket_len", "batch_id", "slot")


def _one_more_bucket(
    cost: np.ndarray, top: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """From ``cost`` with k buckets, that with k + 1 and where the last bucket then begins.

    The best beginning grows with j, so the beginning for a middle j bounds those of the j on
    both sides. All middles of one depth are tried together: a step in numpy for each of the
    log2(n) depths, over about n values.
    """
    n = len(top)
    fresh, choice = cost.copy(), np.zeros(n + 1, dtype=np.int64)
    low, high, first, last = (np.array([x]) for x in (1, n, 0, n - 1))
    while len(low):
        middle = (low + high) // 2
        tries = np.minimum(last, middle - 1) - first + 1
        begins = np.cumsum(tries) - tries
        i, j = ragged(first, tries), np.repeat(middle, tries)
        value = cost[i] + top[j - 1] * (size[j] - size[i])
        least = np.minimum.reduceat(value, begins)
        hits = np.flatnonzero(value == np.repeat(least, tries))
        at = i[hits[np.searchsorted(hits, begins)]]
        fresh[middle], choice[middle] = least, at
        low, high, first, last = (
            np.concatenate(pair)
            for pair in ((low, middle + 1), (middle - 1, high), (first, at), (at, last))
        )
        some = low <= high
        low, high, first, last = low[some], high[some], first[some], last[some]
    return fresh, choice


def best_bounds(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Bucket bounds with the least total padding for a histogram sorted by length.

    cost[j] is the least sum of padded lengths of the first j lengths with at most k buckets.
    A bucket over (i, j] costs lengths[j] * (number of texts in it), which satisfies the
    quadrangle inequality. Whole numbers, so the bounds are exact. Each is a length of the
    histogram.
    """
    n = len(lengths)
    if not n:
        return []
    size = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    top = np.asarray(lengths, dtype=np.int64)
    cost = np.concatenate([[0], top * size[1:]])
    choices = []
    for _ in range(min(n_buckets, n) - 1):
        cost, choice = _one_more_bucket(cost, top, size)
        choices.append(choice)
    bounds, j = [], n
    for choice in reversed(choices):
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
        if not j:
            break
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def packed(
    rows: DataFrame,
    n_buckets: int = N_BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    id_column: str = "doc_id",
) -> DataFrame:
    """The columns of ``rows``, of which n_tokens is the length, and those of the batch.

    bucket_len: what the text is padded to, a length that occurs; batch_id:
    ``<bucket_len>-<number>``; slot: place in the batch, from 0. Columns of these names in
    ``rows`` give way. Within a bucket, texts are batched by (n_tokens, id); rows that tie in
    both take any order. Texts without tokens get bucket 0, and as they cost nothing,
    ``token_budget`` of them share a batch. A null id counts as the least. No rows give no rows.

    The histogram on the driver has a row for each length that occurs, so at most as many as
    the longest text has tokens.
    """
    spark = rows.sparkSession
    counted, counted_path = saved_at(
        rows.drop(*ADDED[1:]).select(
            F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col("n_tokens").alias("size")
        ),
        "packing-lengths",
    )
    histogram = counted.filter("size > 0").groupBy("size").agg(F.count("*").alias("n")).toArrow()
    histogram = histogram.sort_by("size")
    bounds = best_bounds(histogram["size"].to_numpy(), histogram["n"].to_numpy(), n_buckets)
    bucket = F.lit(0).cast("long")
    for bound in reversed(bounds):
        bucket = F.when(F.col("size") <= bound, F.lit(bound).cast("long")).otherwise(bucket)
    bucket = F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(bucket)
    # Sorted over all partitions: a bucket of any size is spread over many of them, and so is
    # an id with any number of rows. A row's number in its bucket is its number in the
    # partition plus an offset.
    place = ["bucket_len", "size", "id", "tie"]
    ordered, _ = saved_at(
        counted.withColumns({"bucket_len": bucket, "tie": F.monotonically_increasing_id()})
        .repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .select(
            "row",
            "bucket_len",
            F.monotonically_increasing_id().alias("at"),
            F.spark_partition_id().alias("part"),
        ),
        "packing",
        drop_shuffles=True,
    )
    discard(spark, counted_path)
    # One row for each partition and bucket in it, at most partitions + buckets in all.
    parts = ordered.groupBy("bucket_len", "part").agg(
        F.min("at").alias("first_at"), F.count("*").alias("n")
    )
    earlier = W.partitionBy("bucket_len").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        "bucket_len", "part", "first_at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    number = F.col("at") - F.col("first_at") + F.col("offset")
    rows_in_batch = F.greatest(
        F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.lit(1), F.col("bucket_len")))
    )
    batch = F.concat_ws("-", F.col("bucket_len"), F.floor(number / rows_in_batch))
    return ordered.join(F.broadcast(offsets), ["bucket_len", "part"]).select(
        "row.*", "bucket_len", batch.alias("batch_id"), (number % rows_in_batch).alias("slot")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    n_buckets: int = N_BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    id_column: str = "doc_id",
    text: str = "text",
    by_word: bool = True,
    whole_rows: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, bucket_len, batch_id, slot for each row.

    ``tokenizer_path`` and ``by_word`` are as in ``token_counts``; a null text has no tokens.
    With ``whole_rows`` all columns of ``docs`` come in place of doc_id, unchanged but for
    those whose names the added ones take.
    """
    tokens = token_number(text, tokenizer_path, by_word).alias("n_tokens")
    if whole_rows:
        others = [c for c in docs.columns if c.lower() not in ADDED]
        return packed(
            docs.select(*(docs[f"`{c}`"] for c in others), tokens), n_buckets, token_budget, id_column
        )
    return packed(docs.select(F.col(id_column).alias("doc_id"), tokens), n_buckets, token_budget)

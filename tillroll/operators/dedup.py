"""Dropping rows whose content hash is already in the target table, or in the same batch.

Rows are equal if their hashes are; one meaning for both checks.

An anti join can only broadcast its right side, here the whole history. So the small
side is turned around where its size allows:

* up to ``broadcast_limit`` batch rows: the batch hashes are broadcast to one scan of
  the history, the hashes found there (no more than were sent) are broadcast back.
  Neither the history nor the batch is shuffled;
* beyond that: a shuffled anti join against the distinct hashes of the history. Copies in
  the history collapse before the shuffle; a hash with very many copies in the batch is
  split by adaptive execution.

Both give the rows of a plain anti join, copies included.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.orders import row_hash
from tillroll.schema import ROW_HASH

#: Hashes that may be broadcast; about 100 bytes each once in a join's hash table.
BROADCAST_LIMIT = 1_000_000
#: Bytes put behind a hash that is no MD5, one more than an MD5 has.
LONGER = 17


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, row_hash())


def hashes_of(table: DataFrame) -> DataFrame:
    """The hash of every table row, as one column.

    Stored hashes are used where the table keeps them. Rows from before it did are
    hashed from their columns; as separate scans, each half can skip the files of the
    other by their null counts, and the first reads a single column.
    """
    if ROW_HASH not in table.columns:
        return table.select(row_hash().alias(ROW_HASH))
    stored = table.filter(F.col(ROW_HASH).isNotNull()).select(ROW_HASH)
    missing = table.filter(F.col(ROW_HASH).isNull()).select(row_hash().alias(ROW_HASH))
    return stored.unionAll(missing)


def drop_copies(df: DataFrame) -> DataFrame:
    """One row for each ``row_hash``: the least of its rows, column by column, nulls first.

    The least row is an aggregate, so each task keeps one row of a hash before the shuffle,
    and a hash with a third of all rows costs no more there than any other.
    """
    return unpacked(least_rows(packed(df)))


def least_rows(df: DataFrame) -> DataFrame:
    """As ``drop_copies``, for hashes that are packed or not."""
    # The hash is the same in all rows that are compared, and is sent once, as the key.
    least = F.min(F.struct(*(c for c in df.columns if c != ROW_HASH))).alias("row")
    rows = df.groupBy(ROW_HASH).agg(least)
    return rows.select(*(ROW_HASH if c == ROW_HASH else f"row.`{c}`" for c in df.columns))


def packed(df: DataFrame) -> DataFrame:
    """The rows with ``row_hash`` as bytes for a shuffle; rows of one hash, and only they, agree.

    An MD5 of 32 hex digits goes as its 16 bytes. Any other text keeps its bytes, with as many
    behind them as make it longer than that.
    """
    digest = F.unhex(ROW_HASH)
    plain = (F.length(ROW_HASH) == 32) & (F.lower(F.hex(digest)) == F.col(ROW_HASH))
    other = F.concat(F.encode(ROW_HASH, "UTF-8"), F.unhex(F.lit("00" * LONGER)))
    return df.withColumn(ROW_HASH, F.when(plain, digest).otherwise(other))


def unpacked(df: DataFrame) -> DataFrame:
    """The rows with ``row_hash`` as it was before ``packed``."""
    key = F.col(ROW_HASH)
    text = F.decode(F.substring(key, F.lit(1), F.octet_length(key) - LONGER), "UTF-8")
    digest = F.lower(F.hex(key))
    return df.withColumn(ROW_HASH, F.when(F.octet_length(key) < LONGER, digest).otherwise(text))


def drop_known_rows(
    batch: DataFrame,
    known: DataFrame,
    row_bound: int,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Rows of ``batch`` whose ``row_hash`` is not in ``known``.

    ``known`` is a one-column frame of hashes (see ``hashes_of``). ``row_bound`` is the
    number of batch rows, or any upper bound of it; it decides what may be broadcast.
    """
    if row_bound > broadcast_limit:
        return batch.join(known.distinct(), ROW_HASH, "left_anti")
    sent = F.broadcast(batch.select(ROW_HASH))
    hits = known.join(sent, ROW_HASH, "left_semi").distinct()
    return batch.join(F.broadcast(hits), ROW_HASH, "left_anti")


def mark_known_rows(batch: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """The batch with a column that says whether ``known`` has the ``row_hash``.

    Batch and distinct hashes are shuffled, as in ``drop_known_rows`` beyond its limit.
    """
    marks = known.distinct().hint("merge").withColumn(name, F.lit(True))
    return batch.join(marks, ROW_HASH, "left").withColumn(name, F.col(name).isNotNull())

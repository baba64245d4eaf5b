"""Most frequent items of each group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_items(
    counts: DataFrame, group: str, item: str, count: str, k: int, carry: Sequence[str] = ()
) -> DataFrame:
    """Keep the ``k`` most frequent items of each group, with their ``rank``.

    ``counts`` has one row per (group, item). Ties go to the smaller item. The filter
    on the rank lets Spark cut every partition to ``k`` rows per group before the
    shuffle, so a group with very many items does not travel whole to one task.

    ``carry`` names further columns of ``counts`` that must not be pruned, so that its
    shuffle is the same as in another use of it and is computed once. They sort last,
    where they decide nothing: an item occurs once per group.
    """
    order = Window.partitionBy(group).orderBy(F.desc(count), F.asc(item), *carry)
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_items(df: DataFrame, group: str, item: str, k: int, count: str = "item_count") -> DataFrame:
    """(group, item, count, rank) of the ``k`` most frequent items of each group."""
    counts = df.groupBy(group, item).agg(F.count(F.lit(1)).alias(count))
    return rank_items(counts, group, item, count, k)


def attach_to_groups(stats: DataFrame, found: DataFrame, group: str, name: str) -> DataFrame:
    """Left-join column ``name`` of ``found``, one row per group, to group statistics.

    Equality as in SQL: the group with a null key keeps its row and gets null. It is
    joined null-safe and blanked after, though. A plain join would filter the null key
    from one side only, and two sides with a common shuffle could no longer share it.
    """
    right = found.select(F.col(group).alias("_group"), F.col(name).alias("_found"))
    joined = stats.join(right, F.col(group).eqNullSafe(F.col("_group")), "left")
    matched = F.when(F.col(group).isNotNull(), F.col("_found"))
    return joined.withColumn(name, matched).drop("_group", "_found")


def items_by_rank(top: DataFrame, group: str, item: str, name: str) -> DataFrame:
    """One ordered array per group from ranked items; at most ``k`` values are gathered."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", item)))
    known = F.filter(F.transform(ranked, lambda r: r[item]), lambda v: v.isNotNull())
    return top.groupBy(group).agg(known.alias(name))

"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs to rows (node, component), the smallest node of the component.

    Alternates two steps until nothing changes: link a node's larger neighbours to its
    smallest one, then its smaller neighbours and itself. Each keeps the components and
    flattens them to stars in a few rounds. Minima are combined before the shuffle, and no
    node's neighbours are gathered. Self-loops count as edges.
    """
    stars = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.filter("v >= u")
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        stars = saved(
            small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).distinct(),
            "stars",
        )
        # The stars are final once no round changes them.
        now = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))

"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query runs to its last row into a sink that drops them, so
neither the driver nor the disk is measured; the ingest queries include the writing of
their inbox and table. A first pass over a smaller scale warms up the JVM; each figure is
the median of three runs, or the only run of a query that takes longer than LONG seconds.
"""

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.registry.queries import QUERIES  # noqa: E402

WARM_UP_DIR = "/root/testdata/sf0.01"
HEADLINE = (
    "v_age_preferences",
    "v_gender_preferences",
    "v_location_preferences",
    "v_age_gender_category",
    "vip_premium",
    "anomalies",
    "satisfaction_by_segment",
    "high_clv",
    "clv_by_segment",
    "high_potential",
    "clv_trend",
    "enrich_orders",
    "dedup_against_table",
    "dedup_by_shuffle",
    "dedup_within_batch",
    "stream_ingest",
)
REPEATS = 3
LONG = 5.0


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def measured(spark: SparkSession, name: str, sf_dir: str) -> float:
    times = [run(spark, name, sf_dir)]
    while len(times) < REPEATS and times[0] <= LONG:
        times.append(run(spark, name, sf_dir))
    return median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    for name in HEADLINE:
        run(spark, name, WARM_UP_DIR)
    times = {name: measured(spark, name, sf_dir) for name in HEADLINE}
    spark.stop()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

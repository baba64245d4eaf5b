"""What the operators share: reading, folders, row keys."""

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.paths import new_shared_folder

#: ASCII white space, the only word separators of this package.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
HASH_JOIN_LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
PARTITION_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it.

    Enough for one machine or a package installed alike everywhere; else ship it with
    ``--py-files``. No effect if the session already has a path for its workers.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back.

    This cuts the lineage: a lost executor costs its running tasks only, and values that
    depend on the order of rows, such as generated ids, stay as they were written.
    """
    return saved_at(df, purpose)[0]


def saved_at(
    df: DataFrame,
    purpose: str,
    *partitions: str,
    drop_shuffles: bool = False,
    hash_joins: bool = False,
) -> tuple[DataFrame, str]:
    """As ``saved``, with the folder, which ``discard`` takes once nothing reads it.

    ``drop_shuffles`` is for steps that shuffle more than they write. Spark else keeps the
    files until the driver collects the frame as garbage, so that the steps of an operator
    add up on the executors' disks; a written result needs them no more. ``hash_joins``
    joins without sorting where each partition of a side was measured to be small.
    """
    spark = df.sparkSession
    path = f"{new_shared_folder(spark, purpose)}/rows"
    settings = {}
    if drop_shuffles:
        settings[SHUFFLE_CLEANUP] = "true"
    if hash_joins:
        settings[HASH_JOIN_LIMIT] = spark.conf.get(PARTITION_SIZE)
    with _settings(spark, settings):
        df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate result that no frame will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def kept_rows(docs: DataFrame, kept: DataFrame, id_column: str, key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and ``key`` are in ``kept``, its two columns.

    One row for each id and key, whichever comes first; a null id is found like any other. All
    columns are unchanged, whatever their names: they travel as one struct.
    """
    wanted = kept.toDF("kept_id", "kept_key")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_column).alias("own_id"), key.alias("own_key")
    )
    found = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_key") == F.col("kept_key"))
    return (
        rows.join(wanted, found, "left_semi").dropDuplicates(["own_id", "own_key"]).select("row.*")
    )

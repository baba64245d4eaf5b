"""The target table: snapshot read and append, for files or a connector."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions.orders import row_hash
from tillroll.schema import (
    BATCH_ID,
    PROCESSED_DATE,
    PROCESSED_TIME,
    ROW_HASH,
    STORED_SCHEMA,
    STREAM_ID,
    TABLE_SCHEMA,
)
from tillroll.sources.paths import (
    DROP_SHUFFLES,
    delete_folder,
    folder_exists,
    matching_folders,
    set_for_now,
)

FILE_FORMATS = frozenset({"parquet", "orc", "json"})
_ABSENT = frozenset({"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"})
CLUSTER_COLUMNS = ("category", "location")
#: Folders of a file table: day, then the stream and batch that wrote the rows.
PARTITIONS = (PROCESSED_DATE, STREAM_ID, BATCH_ID)
#: Stream of rows that no stream wrote.
LOADED = "loaded"
#: Spark sorts rows by their folder, unless a task may keep a file open for each of so many.
OPEN_FOLDERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
#: A batch is stamped with one time, so a task writes to one folder; beyond these it sorts.
OPEN_FOLDERS = 2


@dataclass(frozen=True)
class OrdersTable:
    """Where orders are kept.

    ``location`` is a folder for the file formats, else the connector's ``table`` option.
    ``store_hash`` keeps the row hash as a column, so that checking a batch against the
    table reads that one column and not the eighteen it is made of. ``cluster`` sorts
    each written file by category and location, and keeps the files of a load that spans
    many days few. ``absent_texts`` are parts of the messages by which a connector says that
    its table does not exist; Spark's own errors are known.
    """

    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    store_hash: bool = False
    cluster: bool = False
    absent_texts: tuple[str, ...] = ()

    @property
    def is_files(self) -> bool:
        return self.format in FILE_FORMATS

    def snapshot(self, spark: SparkSession) -> DataFrame | None:
        """The stored rows with their helper columns; None while there is no table.

        Only a missing table counts as empty. Any other failure is raised: taking an
        unreadable table for an empty one would append every row again. Files are read
        under the declared schema: rows from before a column was added have null there,
        and no file footer is opened to find out.
        """
        if self.is_files:
            if not folder_exists(spark, self.location):
                return None
            rows = spark.read.format(self.format).options(**self.options)
            return rows.schema(self.file_schema()).load(self.location)
        else:
            try:
                return spark.read.format(self.format).options(**self._connector()).load()
            except Exception as failure:
                if self._says_absent(failure):
                    return None
                raise

    def _says_absent(self, failure: Exception) -> bool:
        known = isinstance(failure, AnalysisException) and failure.getCondition() in _ABSENT
        return known or any(text in str(failure) for text in self.absent_texts)

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows under the table schema."""
        stored = self.snapshot(spark)
        if stored is None:
            return spark.createDataFrame([], TABLE_SCHEMA)
        missing = {
            f.name: F.lit(None).cast(f.dataType)
            for f in TABLE_SCHEMA
            if f.name not in stored.columns
        }
        return stored.withColumns(missing).select(*TABLE_SCHEMA.names)

    def between(self, spark: SparkSession, first: str, last: str) -> DataFrame:
        """The rows ingested from day ``first`` to ``last``, both included.

        Of a file table only the folders of these days are opened.
        """
        stored = self.snapshot(spark)
        if stored is None:
            return self.read(spark)
        day = F.col(PROCESSED_DATE) if self.is_files else F.to_date(PROCESSED_TIME)
        days = stored.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        return days.select(*(c for c in TABLE_SCHEMA.names if c in days.columns))

    def append(self, rows: DataFrame) -> int:
        """Append rows, aligned or enriched, and return how many there were.

        Files go to one folder per ingest day; an append of no rows writes no file. The
        rows are computed once: counted on their way to the files, or persisted for a
        connector, which may run them more than once.
        """
        rows = self._laid_out(rows, LOADED, 0)
        if self.is_files:
            written = Observation()
            self._write(rows.observe(written, F.count(F.lit(1)).alias("rows")))
            return written.get["rows"]
        rows = rows.persist()
        try:
            count = rows.count()
            self._write(rows)
        finally:
            rows.unpersist()
        return count

    def write_batch(self, rows: DataFrame, stream_id: str, batch_id: int) -> int:
        """Make ``rows`` all the rows of a stream's batch, and return how many they are.

        A batch has folders of its own, so one that is delivered again after a failure first
        removes what the earlier attempt left, all of it or a part, on whatever day. ``rows``
        must not be read from there. The rows are counted in the files written. A connector
        has no such folders: there the rows are appended.
        """
        if not self.is_files:
            return self.append(rows)
        spark = rows.sparkSession
        for folder in self._batch_folders(spark, stream_id, batch_id):
            delete_folder(spark, folder)
        with set_for_now(spark, {OPEN_FOLDERS_SETTING: OPEN_FOLDERS}):
            self._write(self._laid_out(rows, stream_id, batch_id))
        return self.batch_rows(spark, stream_id, batch_id)

    def batch_rows(self, spark: SparkSession, stream_id: str, batch_id: int) -> int:
        """Stored rows of one batch, by the footers of its files."""
        folders = self._batch_folders(spark, stream_id, batch_id)
        if not folders:
            return 0
        files = spark.read.format(self.format).options(**self.options)
        return files.schema(self.file_schema()).load(folders).count()

    def batch_hashes(self, spark: SparkSession, stream_id: str, batch_id: int) -> DataFrame:
        """The hashes of one batch, read from its folders."""
        folders = self._batch_folders(spark, stream_id, batch_id)
        if not folders:
            return spark.createDataFrame([], f"{ROW_HASH} string")
        files = spark.read.format(self.format).options(**self.options).schema(self.file_schema())
        rows = files.load(folders)
        return rows.select(ROW_HASH if self.store_hash else row_hash().alias(ROW_HASH))

    def _batch_folders(self, spark: SparkSession, stream_id: str, batch_id: int) -> list[str]:
        own = f"{STREAM_ID}={stream_id}/{BATCH_ID}={batch_id}"
        return matching_folders(spark, f"{self.location.rstrip('/')}/{PROCESSED_DATE}=*/{own}")

    def _laid_out(self, rows: DataFrame, stream_id: str, batch_id: int) -> DataFrame:
        if self.store_hash and ROW_HASH not in rows.columns:
            rows = rows.withColumn(ROW_HASH, row_hash())
        elif not self.store_hash:
            rows = rows.drop(ROW_HASH)
        if self.is_files:
            rows = rows.withColumns(
                {
                    PROCESSED_DATE: F.to_date(PROCESSED_TIME),
                    STREAM_ID: F.lit(stream_id),
                    BATCH_ID: F.lit(batch_id).cast("long"),
                }
            )
        return self._clustered(rows) if self.cluster else rows

    def _write(self, rows: DataFrame) -> None:
        writer = rows.write.format(self.format).mode("append")
        with set_for_now(rows.sparkSession, DROP_SHUFFLES):
            if self.is_files:
                writer.options(**self.options).partitionBy(*PARTITIONS).save(self.location)
            else:
                writer.options(**self._connector()).save()

    def _clustered(self, rows: DataFrame) -> DataFrame:
        # A rebalance, unlike a plain repartition, splits a day or category that is too
        # large for one task and merges small ones.
        lead = [PROCESSED_DATE] if self.is_files else []
        by = [*lead, *CLUSTER_COLUMNS]
        return rows.hint("rebalance", *by).sortWithinPartitions(*by)

    def file_schema(self) -> StructType:
        """What lies in the files, with the partition columns."""
        kept = [f for f in STORED_SCHEMA if f.name != ROW_HASH or self.store_hash]
        return StructType(kept)

    def _connector(self) -> dict[str, str]:
        return {"table": self.location, **self.options}


def staged_connector_options(checkpoint: str) -> dict[str, str]:
    """Options of a warehouse connector that loads staged parquet files.

    Files are staged in the bucket of the checkpoint; the table may gain columns.
    """
    scheme, _, rest = checkpoint.partition("://")
    bucket = rest.split("/")[0]
    if not (scheme and bucket):
        raise ValueError(f"no bucket in checkpoint path {checkpoint!r}")
    return {
        "temporaryGcsBucket": bucket,
        "intermediateFormat": "parquet",
        "allowFieldAddition": "true",
        "allowSchemaEvolution": "true",
    }

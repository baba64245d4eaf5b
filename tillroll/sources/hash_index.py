"""The hashes of a table's rows, kept so that a check reads what the batch asks for.

Two parts. ``recent`` has the hashes of each batch in a folder of its own, by stream and
batch, so a batch delivered again replaces them and is never checked against itself.
``settled`` has those of all earlier batches: one folder for each of the first hex digits,
sorted, in small pages with their least and greatest hash. A check skips the folders that no
hash of the batch falls into; a small batch also hands its hashes to the Parquet reader,
which then opens the pages that can hold one of them and no others, however long the
history. A hash that is in both parts, or twice, does no harm.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import BATCH_ID, ROW_HASH, STREAM_ID
from tillroll.sources.paths import delete_folder, folder_exists, matching_folders

#: Hex digits of the folders of the settled part: 256 of them.
PREFIX_DIGITS = 2
#: Up to so many hashes are looked for page by page; the default batch of ten files with 25
#: rows each is below. Beyond, the folders left are scanned.
PUSHED_HASHES = 512
#: Hashes of a page, the least that is read.
PAGE_ROWS = 4_000
PREFIX = "prefix"
RECENT_SCHEMA = f"{ROW_HASH} string, {STREAM_ID} string, {BATCH_ID} bigint"
SETTLED_SCHEMA = f"{ROW_HASH} string, {PREFIX} string"


def any_of(column: Column, values: list[str]) -> Column:
    """``column`` is one of the values, as a balanced tree of comparisons.

    Unlike a long list, which Parquet only sees by its least and greatest value, each
    comparison is tested against the pages by itself.
    """
    tests = [column == value for value in values] or [F.lit(False)]
    while len(tests) > 1:
        pairs = zip(tests[::2], tests[1::2], strict=False)
        tests = [a | b for a, b in pairs] + tests[len(tests) & ~1 :]
    return tests[0]


@dataclass(frozen=True)
class HashIndex:
    """Hashes under ``location``; see the module."""

    location: str
    prefix_digits: int = PREFIX_DIGITS
    pushed_hashes: int = PUSHED_HASHES

    def put_batch(self, hashes: DataFrame, stream_id: str, batch_id: int) -> None:
        """Make ``hashes``, a column of them, those of a stream's batch."""
        folder = f"{self._recent}/{STREAM_ID}={stream_id}/{BATCH_ID}={batch_id}"
        hashes.select(ROW_HASH).write.mode("overwrite").parquet(folder)

    def candidates(self, hashes: DataFrame, n: int, stream_id: str, batch_id: int) -> DataFrame:
        """Stored hashes among which are all that the ``n`` hashes of a batch can meet.

        The batch's own hashes, of an earlier attempt, are left out. The driver gets the
        prefixes of the batch, and its hashes if they are few: bounded by the settings.
        """
        spark = hashes.sparkSession
        own = (F.col(STREAM_ID) == stream_id) & (F.col(BATCH_ID) == batch_id)
        recent = self._read(spark, self._recent, RECENT_SCHEMA).where(~own).select(ROW_HASH)
        settled = self._read(spark, self._current(spark), SETTLED_SCHEMA)
        asked = hashes.select(ROW_HASH).distinct()
        if n <= self.pushed_hashes:
            values = [row[0] for row in asked.collect()]
            wanted = any_of(F.col(ROW_HASH), values)
            recent, settled = recent.where(wanted), settled.where(wanted)
            prefixes = sorted({value[: self.prefix_digits] for value in values})
        else:
            prefixes = [row[0] for row in asked.select(self._prefix()).distinct().collect()]
        return settled.where(F.col(PREFIX).isin(prefixes)).select(ROW_HASH).unionAll(recent)

    def settle(self, spark: SparkSession) -> None:
        """Move the recent hashes into the settled part, written anew.

        For times between batches, say once a day. The last batch of each stream stays, since
        it may be delivered again. Nothing is deleted before the new part is complete, and a
        break in between leaves some hashes in both parts.
        """
        recent = self._read(spark, self._recent, RECENT_SCHEMA)
        last = recent.groupBy(STREAM_ID).agg(F.max(BATCH_ID).alias(BATCH_ID)).collect()
        kept = {f"{STREAM_ID}={r[STREAM_ID]}/{BATCH_ID}={r[BATCH_ID]}" for r in last}
        folders = [
            folder
            for folder in matching_folders(spark, f"{self._recent}/{STREAM_ID}=*/{BATCH_ID}=*")
            if not any(folder.endswith(f"/{own}") for own in kept)
        ]
        if not folders:
            return
        old = self._current(spark)
        moved = spark.read.schema(f"{ROW_HASH} string").parquet(*folders)
        settled = self._read(spark, old, SETTLED_SCHEMA).select(ROW_HASH)
        self._write_settled(settled.unionAll(moved))
        for folder in [*folders, *([old] if old else [])]:
            delete_folder(spark, folder)

    def rebuild(self, hashes: DataFrame) -> None:
        """Settle ``hashes``, those of a table that had no index; batches are kept."""
        old = self._current(hashes.sparkSession)
        self._write_settled(hashes.select(ROW_HASH))
        if old:
            delete_folder(hashes.sparkSession, old)

    @property
    def _recent(self) -> str:
        return f"{self.location.rstrip('/')}/recent"

    def _prefix(self) -> Column:
        return F.substring(ROW_HASH, 1, self.prefix_digits).alias(PREFIX)

    def _current(self, spark: SparkSession) -> str | None:
        """The newest complete version of the settled part."""
        done = matching_folders(spark, f"{self.location.rstrip('/')}/settled/*/_SUCCESS")
        folders = [path.rsplit("/", 1)[0] for path in done]
        return max(folders, key=lambda path: int(path.rsplit("-", 1)[1]), default=None)

    def _write_settled(self, hashes: DataFrame) -> None:
        old = self._current(hashes.sparkSession)
        number = int(old.rsplit("-", 1)[1]) + 1 if old else 0
        (
            hashes.distinct()
            .withColumn(PREFIX, self._prefix())
            .repartitionByRange(PREFIX, ROW_HASH)
            .sortWithinPartitions(PREFIX, ROW_HASH)
            .write.partitionBy(PREFIX)
            .option("parquet.page.row.count.limit", PAGE_ROWS)
            .option("parquet.enable.dictionary", "false")
            .mode("overwrite")  # what an attempt that broke off has left
            .parquet(f"{self.location.rstrip('/')}/settled/version-{number}")
        )

    def _read(self, spark: SparkSession, folder: str | None, schema: str) -> DataFrame:
        if folder is None or not folder_exists(spark, folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(folder)

"""Order files as CSV: batch read, stream, and the split into bounded files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import RAW_SCHEMA, RAW_SCHEMA_WITH_REJECTED, REJECTED

#: Files taken into one micro-batch, rows in one split file.
FILES_PER_TRIGGER = 10
ROWS_PER_FILE = 25
#: Options under which any text comes back as it was written: quotes are doubled, so that a
#: backslash is just a character, and a quoted cell may hold line breaks. A file is then read
#: by one task, whatever its size.
ANY_TEXT = {"multiLine": "true", "escape": '"'}


def _layout(rejected: bool) -> dict:
    """Schema, and the option that names its column of rejected records."""
    if not rejected:
        return {"schema": RAW_SCHEMA, "options": {}}
    return {
        "schema": RAW_SCHEMA_WITH_REJECTED,
        "options": {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED},
    }


def read_orders_csv(
    spark: SparkSession, path: str, rejected: bool = False, **options: str
) -> DataFrame:
    """Order files under the declared schema.

    Columns bind by position whatever the header says; a cell that does not convert
    becomes null, and with ``rejected`` the record's text is kept in a column beside the
    others. Nothing is inferred, so there is no extra pass over the data.
    """
    layout = _layout(rejected)
    reader = spark.read.options(header="true", **layout["options"], **options)
    return reader.schema(layout["schema"]).csv(path)


def stream_orders_csv(
    spark: SparkSession,
    inbox: str,
    files_per_trigger: int | None = FILES_PER_TRIGGER,
    bytes_per_trigger: int | None = None,
    rejected: bool = False,
    **options: str,
) -> DataFrame:
    """New order files of an inbox, oldest first, subfolders left out.

    A micro-batch is bounded by a number of files or, for files of uneven size, by
    bytes; give one of the two. Cells, ``rejected`` and ``options`` as in
    ``read_orders_csv``.
    """
    if (files_per_trigger is None) == (bytes_per_trigger is None):
        raise ValueError("give either files_per_trigger or bytes_per_trigger")
    bound = (
        {"maxFilesPerTrigger": str(files_per_trigger)}
        if bytes_per_trigger is None
        else {"maxBytesPerTrigger": str(bytes_per_trigger)}
    )
    layout = _layout(rejected)
    return (
        spark.readStream.format("csv")
        .options(header="true", latestFirst="false", recursiveFileLookup="false", **bound)
        .options(**layout["options"], **options)
        .schema(layout["schema"])
        .load(inbox)
    )


def split_to_csv(
    df: DataFrame, folder: str, rows_per_file: int = ROWS_PER_FILE, **options: str
) -> None:
    """Write a table as CSV files of at most ``rows_per_file`` rows, a header in each.

    Every partition splits its own rows, so no shuffle and no global row number; the
    last file of a partition may be shorter. White space around a cell's text is kept.
    """
    (
        df.write.option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
        .csv(folder)
    )


def split_report(split: DataFrame) -> DataFrame:
    """Rows of each file behind ``split``, a frame read from files."""
    return split.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def split_totals(report: DataFrame) -> DataFrame:
    """One row: files, rows in all, rows of the largest file."""
    return report.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("largest_file"),
    )

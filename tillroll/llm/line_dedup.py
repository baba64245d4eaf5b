"""Line de-duplication over levelled, sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z lower-cased; long
keys found in many documents are dropped everywhere but in the largest document that holds
them. What is known of the lines so far lies in runs: tables bucketed and sorted by the
hash of the key. Documents come in batches. The hashes of a batch are merge-joined to the
runs: those in none of them become the batch's own run, those already known only add to a
count kept beside it. So no hash is in two runs, a lookup ends at the first hit, and a run
is never shuffled to be joined. ``FANOUT`` runs of a level are merged into one of the next,
so there are few runs however many batches came.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import discard, saved, saved_at, text_or_empty
from tillroll.sources.paths import new_shared_folder

MIN_LENGTH = 40
MIN_DOCS = 5
#: Parts the documents are dealt into by their id.
BATCHES = 6
#: Runs of a level that are merged into one of the next.
FANOUT = 3
#: A key with more than this share of all (line, document) pairs is joined by broadcast,
#: so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.001
SPACE_BYTES = b" \t\n\v\f\r"


class LineRuns:
    """Distinct line hashes with the number of documents and the largest document of each.

    Made of entries (key, n_docs, last), each key once in an ``add``. Every table has a part
    with the keys first seen in its batches and a part, ``known``, with the further counts of
    keys that older runs hold.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = new_shared_folder(spark, "line-runs")
        self.levels: list[list[str]] = []

    @property
    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, entries: DataFrame) -> None:
        """Take in a batch: known keys by merge joins with the runs, the rest as a new run."""
        known = F.lit(False)
        for name in self.tables:
            held = self._run(name).select("key", F.lit(True).alias(name))
            entries = entries.join(held.hint("merge"), "key", "left")
            known = known | F.col(name).isNotNull()
        self._write(entries.select("key", "n_docs", "last", known.alias("known")), level=0)
        self._compact()

    def frequent(self, min_docs: int) -> DataFrame:
        """(key, n_docs, last) of the keys found in at least ``min_docs`` documents."""
        tables = self.tables
        if not tables:
            raise ValueError("no batch was added")
        more = _summed(
            reduce(DataFrame.unionAll, (self.spark.table(t).where("known") for t in tables)), "key"
        ).select("key", F.col("n_docs").alias("more"), F.col("last").alias("later"))
        each = (
            self._run(t)
            .join(more.hint("merge"), "key", "left")
            .select(
                "key",
                (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"),
                F.greatest("last", "later").alias("last"),
            )
            .where(F.col("n_docs") >= min_docs)
            for t in tables
        )
        return reduce(DataFrame.unionAll, each)

    def close(self) -> None:
        """Delete the runs."""
        for name in self.tables:
            self._drop(name)
        self.levels = []

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).where("NOT known").drop("known")

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid4().hex}"
        (
            rows.write.partitionBy("known")
            .bucketBy(self.buckets, "key")
            .sortBy("key")
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(name)
        )
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, f"{self.folder}/{name}")

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            full = self.levels[level]
            if len(full) >= self.fanout:
                rows = reduce(DataFrame.unionAll, (self.spark.table(name) for name in full))
                self._write(_summed(rows, "key", "known"), level + 1)
                self.levels[level] = []
                for name in full:
                    self._drop(name)
            level += 1


def _summed(entries: DataFrame, *by: str) -> DataFrame:
    summed = entries.groupBy(*by).agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))
    return summed.select("key", "n_docs", "last", *(c for c in by if c != "key"))


def line_digest(line: bytes, min_length: int) -> bytes | None:
    """Hash of a line's key; None if the key is shorter. ``line`` has A-Z in lower case."""
    key = line.strip(SPACE_BYTES)
    if len(key) < min_length or (not key.isascii() and len(key.decode()) < min_length):
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def _line_keys(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for i, text in enumerate(batch["text"]):
                lines = text.as_buffer().to_pybytes().lower().split(b"\n")
                found = {line_digest(line, min_length) for line in lines} - {None}
                at += [i] * len(found)
                keys += found
            ids = batch["id"].take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], ["id", "key"])

    return run


def _without_lines(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, gone in zip(batch["text"], batch["gone"], strict=True):
                text = text.as_buffer().to_pybytes()
                lines = left = text.split(b"\n")
                if gone.is_valid:
                    gone = set(gone.as_py())
                    folded = text.lower().split(b"\n")
                    left = [
                        line
                        for line, key in zip(lines, folded, strict=True)
                        if line_digest(key, min_length) not in gone
                    ]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            columns = [
                batch["id"],
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_lines", "n_dropped", "kept"])

    return run


def drop_repeated_lines(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The id, n_lines before dropping, n_dropped and the ``kept`` text of each row.

    Keys of at least ``min_length`` code points found in at least ``min_docs`` documents lose
    all their lines except in the largest document that holds them. Rows that share an id are
    one document, and so are all rows without one, which counts as the smallest. A null or
    empty text is one empty line. Other columns are not read, so any names may be there. No
    rows give no rows. ``batches`` and ``fanout`` change the work, never the result.
    """
    spark = docs.sparkSession
    # Within a struct, nulls compare like values, so they group and join like any id.
    rows = docs.select(F.struct(F.col(id_column)).alias("id"), text_or_empty(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    lines, lines_path = saved_at(
        rows.mapInArrow(_line_keys(min_length), f"id {id_type}, key binary").withColumn(
            "batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
        ),
        "lines",
        "batch",
    )
    runs = LineRuns(spark, fanout)
    for number in range(batches):
        pairs = lines.where(F.col("batch") == number).select("key", "id").distinct()
        runs.add(pairs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("id").alias("last")))
    frequent, frequent_path = saved_at(runs.frequent(min_docs), "frequent")
    runs.close()
    gone = saved(_lines_to_drop(lines, frequent), "dropped")
    discard(spark, lines_path)
    discard(spark, frequent_path)
    # The lists grow with the corpus, and in memory they are some twenty times their files,
    # which Spark would judge them by; so they are never broadcast.
    kept = rows.join(gone.hint("merge"), "id", "left").mapInArrow(
        _without_lines(min_length),
        f"id {id_type}, n_lines bigint, n_dropped bigint, kept string",
    )
    return kept.select(F.col("id")[id_column].alias(id_column), "n_lines", "n_dropped", "kept")


def _lines_to_drop(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(id, gone): the keys each document loses.

    Very frequent keys, few by the definition of HOT_SHARE, are broadcast, so that no task
    gets all documents of one; the others meet their documents in a shuffle.
    """
    hot_from = lines.count() * HOT_SHARE
    hot = F.broadcast(frequent.where(F.col("n_docs") > hot_from).select("key", "last"))
    cold = frequent.where(F.col("n_docs") <= hot_from).select("key", "last")
    pairs = lines.select("key", "id")
    held = pairs.join(hot, "key").unionAll(pairs.join(hot, "key", "left_anti").join(cold, "key"))
    return held.where("id != last").groupBy("id").agg(F.collect_set("key").alias("gone"))

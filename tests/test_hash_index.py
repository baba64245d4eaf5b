import pytest

from pyspark.sql import functions as F
from test_ingest import CrashAfterAppend, Pipeline, ids

from tillroll.operators.dedup import hashes_of
from tillroll.sources.hash_index import HashIndex, any_of
from tillroll.streaming.ingest import Ingest


def hashes(spark, numbers):
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")
    return frame.select(F.md5(F.col("n").cast("string")).alias("row_hash"))


def many(spark, n):
    return spark.range(n).select(F.md5(F.concat(F.lit("x"), "id")).alias("row_hash"))


def found(spark, index, numbers, stream="a", batch=99):
    asked = hashes(spark, numbers)
    candidates = index.candidates(asked, len(numbers), stream, batch)
    return asked.join(candidates, "row_hash", "left_semi").count()


@pytest.mark.parametrize("pushed", [0, 512])
def test_finds_recent_and_settled_hashes(spark, tmp_path, pushed):
    index = HashIndex(str(tmp_path), prefix_digits=1, pushed_hashes=pushed)
    assert found(spark, index, [1, 2]) == 0
    index.put_batch(hashes(spark, [1, 2, 2]), "a", 0)
    index.put_batch(hashes(spark, [3]), "a", 1)
    index.put_batch(hashes(spark, [4]), "b", 0)
    assert found(spark, index, range(10)) == 4
    # A batch is not checked against its own earlier attempt.
    assert found(spark, index, range(10), "a", 0) == 2
    index.put_batch(hashes(spark, [1]), "a", 0)
    assert found(spark, index, range(10)) == 3
    index.settle(spark)
    # The last batch of either stream can still come again.
    recent = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.glob("recent/*/*"))
    assert recent == ["recent/stream_id=a/batch_id=1", "recent/stream_id=b/batch_id=0"]
    assert found(spark, index, range(10)) == 3 and found(spark, index, range(10), "a", 1) == 2
    index.put_batch(hashes(spark, [5]), "a", 2)
    index.settle(spark)
    index.settle(spark)
    assert found(spark, index, range(10)) == 4
    assert [p.name for p in tmp_path.glob("settled/*")] == ["version-1"]
    index.rebuild(hashes(spark, [7, 8]))
    assert found(spark, index, [1, 3, 7, 8]) == 2


def test_a_break_while_settling_loses_nothing(spark, tmp_path):
    index = HashIndex(str(tmp_path), prefix_digits=1)
    index.put_batch(hashes(spark, [1, 2]), "a", 0)
    index.put_batch(hashes(spark, [3]), "a", 1)
    index.settle(spark)
    # A version without its mark is not complete; the next attempt writes it anew.
    broken = tmp_path / "settled" / "version-1" / "prefix=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("half")
    assert found(spark, index, range(5)) == 3
    index.put_batch(hashes(spark, [4]), "a", 2)
    index.settle(spark)
    assert found(spark, index, range(5)) == 4


def test_any_of(spark):
    frame = spark.range(20).selectExpr("CAST(id AS string) AS v")
    for values in ([], ["3"], ["3", "4", "x"], [str(i) for i in range(2, 19)]):
        kept = {r.v for r in frame.where(any_of(F.col("v"), values)).collect()}
        assert kept == {v for v in values if v != "x"}


def test_plan_skips_folders_and_hands_hashes_to_the_reader(spark, tmp_path):
    index = HashIndex(str(tmp_path), prefix_digits=1)
    index.rebuild(many(spark, 500))
    asked = many(spark, 3)
    candidates = index.candidates(asked, 3, "a", 0)
    prefixes = {r.row_hash[:1] for r in asked.collect()}
    candidates.collect()
    plan = candidates._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [prefix" in scan and "EqualTo(row_hash" in scan
    read = candidates.select(F.input_file_name()).collect()
    assert {r[0].split("prefix=")[1][:1] for r in read} == prefixes
    larger = index.candidates(asked, 10_000, "a", 0)
    plan = larger._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [prefix" in plan and "EqualTo(row_hash" not in plan


def test_bytes_read_stay_flat_as_the_history_grows(spark, tmp_path):
    """A hundred times the history, the same batch: the pages it falls into, and no more."""

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    asked = hashes(spark, range(8)).persist()
    asked.count()
    costs = []
    # Bytes of vectored reads are not counted.
    spark._jsc.hadoopConfiguration().set("parquet.hadoop.vectored.io.enabled", "false")
    for size in (50_000, 5_000_000):
        index = HashIndex(str(tmp_path / str(size)), prefix_digits=1)
        index.rebuild(many(spark, size))
        before = bytes_read()
        assert index.candidates(asked, 8, "a", 0).count() == 0
        costs.append(bytes_read() - before)
    stored = sum(f.stat().st_size for f in (tmp_path / "5000000").rglob("*.parquet"))
    spark._jsc.hadoopConfiguration().unset("parquet.hadoop.vectored.io.enabled")
    assert 0 < costs[0] and costs[1] < 3 * costs[0]
    assert costs[1] < stored / 50


@pytest.mark.parametrize("store_hash", [False, True])
def test_ingest_with_an_index(spark, tmp_path, store_hash):
    plain = Pipeline(spark, tmp_path, store_hash=store_hash)
    index = HashIndex(str(tmp_path / "hashes"), prefix_digits=1)
    ingest = Ingest(plain.ingest.table, metrics_path=plain.metrics, index=index)
    plain.deliver("first", *ids(1, 2, 3, 3))
    with pytest.raises(Exception, match="Crash"):
        plain.drain(ingest=CrashAfterAppend(plain.ingest.table, index=index))
    plain.drain(ingest=ingest)
    plain.deliver("second", *ids(3, 4))
    plain.drain(ingest=ingest)
    index.settle(spark)
    plain.deliver("third", *ids(1, 4, 5))
    plain.drain(ingest=ingest)
    assert sorted(r.customer_id for r in plain.rows().collect()) == [1, 2, 3, 3, 4, 5]
    assert plain.totals() == [(4, 4, 0), (2, 1, 1), (3, 1, 2)]


def test_an_index_is_rebuilt_from_a_table(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    pipeline.deliver("first", *ids(1, 2))
    pipeline.drain()
    index = HashIndex(str(tmp_path / "hashes"))
    index.rebuild(hashes_of(pipeline.ingest.table.snapshot(spark)))
    pipeline.deliver("second", *ids(2, 3))
    pipeline.drain(ingest=Ingest(pipeline.ingest.table, index=index))
    assert sorted(r.customer_id for r in pipeline.rows().collect()) == [1, 2, 3]

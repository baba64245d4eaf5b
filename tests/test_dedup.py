import random
from datetime import datetime

import pytest
from helpers import bag, final_plan, orders

from tillroll.operators.dedup import drop_copies, drop_known_rows, hashes_of, with_row_hash

PATHS = {"broadcast": 10_000, "shuffle": 0}


@pytest.fixture(scope="module")
def skewed(spark):
    """One stored and one new order make up a third of the batch each."""
    chance = random.Random(5)
    spread = [{"customer_id": chance.randrange(60)} for _ in range(100)]
    hot_known, hot_new = {"customer_id": 1, "age": None}, {"customer_id": 2, "gender": None}
    batch = orders(spark, *spread, *[hot_known] * 100, *[hot_new] * 100).repartition(6)
    stored = orders(
        spark, *({"customer_id": i} for i in range(0, 60, 2)), *[hot_known] * 200
    )
    return with_row_hash(batch), stored


@pytest.mark.parametrize("path", PATHS)
def test_equals_plain_anti_join(path, skewed):
    batch, stored = skewed
    plain = batch.join(hashes_of(stored), "row_hash", "left_anti")
    ours = drop_known_rows(batch, hashes_of(stored), 300, PATHS[path])
    columns = sorted(batch.columns)
    expected = bag(plain.select(columns))
    assert expected.total() > 100
    assert bag(ours.select(columns)) == expected


@pytest.mark.parametrize("path", PATHS)
def test_empty_sides(path, skewed, spark):
    batch, stored = skewed
    limit = PATHS[path]
    none_known = drop_known_rows(batch, hashes_of(stored.limit(0)), 300, limit)
    assert none_known.count() == batch.count()
    assert drop_known_rows(batch.limit(0), hashes_of(stored), 300, limit).count() == 0
    assert drop_known_rows(batch, batch.select("row_hash"), 300, limit).count() == 0


def test_small_batch_shuffles_neither_side(skewed):
    batch, stored = skewed
    plan = final_plan(drop_known_rows(batch, hashes_of(stored), 300))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2
    # Only the hits, already combined, are shuffled for their distinct.
    assert plan.count("Exchange hashpartitioning(row_hash") == 1


def test_large_batch_combines_the_history_before_its_shuffle(skewed, spark, tmp_path):
    batch, stored = skewed
    batch.write.parquet(str(tmp_path / "batch"))
    stored.write.parquet(str(tmp_path / "stored"))
    history = hashes_of(spark.read.parquet(str(tmp_path / "stored")))
    received = spark.read.parquet(str(tmp_path / "batch"))
    fresh = drop_known_rows(received, history, 300, broadcast_limit=0)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    # The batch and the history are read once each, and each hash is sent once by a task.
    assert plan.count("FileScan parquet") == 2
    below = plan[plan.rindex("Exchange") :]
    assert "HashAggregate(keys=[row_hash" in below


def test_drop_copies(skewed, spark):
    batch, _ = skewed
    assert drop_copies(batch).count() == batch.select("row_hash").distinct().count()
    nulls = with_row_hash(orders(spark, {"age": None}, {"age": None}, {"age": 1}))
    assert drop_copies(nulls).count() == 2
    assert drop_copies(batch).columns == batch.columns
    assert drop_copies(batch.limit(0)).count() == 0


def test_copies_are_rows_of_one_hash(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    same = {"size": None, "color": "M", "processed_time": late}  # nulls are left out of the hash
    rows = with_row_hash(
        orders(spark, same, {"size": "M", "color": None, "processed_time": early}, {"age": 1})
    )
    assert rows.select("row_hash").distinct().count() == 2
    kept = [r for r in drop_copies(rows).collect() if r.age != 1]
    # The least row, null before any size.
    assert [(r["size"], r.color, r.processed_time) for r in kept] == [(None, "M", late)]
    times = with_row_hash(orders(spark, {"processed_time": late}, {"processed_time": early}))
    assert [r.processed_time for r in drop_copies(times).collect()] == [early]
    # And the check against a table agrees with it.
    assert drop_known_rows(rows, hashes_of(orders(spark, same)), 3).count() == 1


def test_copies_are_combined_before_the_shuffle(skewed):
    batch, _ = skewed
    plan = drop_copies(batch)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(row_hash") :]
    assert "partial_min(struct(" in below


def test_stored_hashes_are_preferred(spark):
    mixed = with_row_hash(orders(spark, {}, {"age": 1})).selectExpr(
        "* except (row_hash)", "if(age = 1, 'stored', null) AS row_hash"
    )
    found = {r[0] for r in hashes_of(mixed).collect()}
    expected = with_row_hash(orders(spark, {})).first()["row_hash"]
    assert found == {"stored", expected}

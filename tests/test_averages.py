import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tillroll.operators.averages import averages, mantissa_and_power

INF, NAN = math.inf, math.nan
COUNT = {"rows": (lambda _: F.count(F.lit(1)), F.sum, "*")}


def average(spark, values, parts=3):
    frame = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    row = averages(frame.repartition(parts), ["k"], "v", "a", COUNT).first()
    assert row["rows"] == len(values)
    return row["a"]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1e12, 4e-7, -1e12], 4e-7 / 3),
        ([0.1] * 10, 0.1),
        ([4e-7], 4e-7),
        ([1e12, 1e12 + 2], 1e12 + 1),
        ([0.0, -0.0, 3.0], 1.0),
        ([5e-324, 5e-324], 5e-324),
        ([1.7e308, -1.7e308, 1.0], 1 / 3),
        ([None, 2.0, None], 2.0),
        ([None], None),
        ([1.0, INF], INF),
        ([-INF, 5.0], -INF),
    ],
)
def test_average(spark, values, expected):
    assert average(spark, values) == expected


@pytest.mark.parametrize("values", [[1.0, NAN], [INF, -INF], [NAN, INF, None]])
def test_average_that_is_no_number(spark, values):
    assert math.isnan(average(spark, values))


def test_any_order_gives_the_same_bits(spark):
    chance = random.Random(3)
    values = [chance.uniform(-1, 1) * 10 ** chance.randint(-9, 9) for _ in range(3000)]
    exact = sum(map(Fraction, values)) / len(values)
    found = set()
    for parts in (1, 7, 12):
        chance.shuffle(values)
        found.add(average(spark, values, parts))
    assert len(found) == 1
    assert found.pop() == pytest.approx(float(exact), rel=1e-12)


def test_mantissas_are_whole_and_exact(spark):
    chance = random.Random(4)
    values = [2.0**k for k in range(-1074, 1024, 13)] + [math.nextafter(2.0**k, 0) for k in range(-300, 1024, 7)]
    values += [chance.uniform(-9, 9) for _ in range(200)]
    mantissa, power = mantissa_and_power(F.col("v"))
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", mantissa, power)
    for value, whole, exponent in rows.collect():
        assert Fraction(int(whole)) * Fraction(2) ** exponent == Fraction(value)
        assert 2**52 <= abs(whole) < 2**53


def test_groups_are_combined_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 2 AS k", "CAST(id AS DOUBLE) AS v")
    plan = averages(frame, ["k"], "v", "a", COUNT)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_sum(_mantissa" in below


def test_each_row_takes_one_logarithm_and_two_powers(spark):
    """Worked out again at each mention, they were most of the time of a report."""
    frame = spark.range(100).selectExpr("id % 2 AS k", "CAST(id AS DOUBLE) AS v")
    plan = averages(frame, ["k"], "v", "a", COUNT)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert before_shuffle.upper().count("LOG2(") == 1
    assert before_shuffle.upper().count("POWER(") + before_shuffle.upper().count("POW(") == 2
    assert "decimal" not in before_shuffle


def test_sums_beyond_a_long(spark):
    values = [2.0**53 - 1] * 5000 + [-(2.0**53 - 1)] * 10
    assert average(spark, values) == float((2**53 - 1) * 4990) / 5010

import pytest
from helpers import final_plan, orders

from tillroll.operators.ranking import top_items
from tillroll.plans import reports, views
from tillroll.operators.enrich import enrich_orders


def rows(spark, *facts):
    """Orders given as (key, category, amount, rating)."""
    return orders(
        spark,
        *(
            {
                "gender": key,
                "location": key,
                "category": category,
                "purchase_amount_usd": amount,
                "review_rating": rating,
            }
            for key, category, amount, rating in facts
        ),
    ).repartition(3)


@pytest.fixture(scope="module")
def facts(spark):
    return rows(
        spark,
        ("A", "x", 10.0, 4.0),
        ("A", "x", 20.0, None),
        ("A", "w", None, 2.0),
        ("A", "v", 30.0, 3.0),
        ("A", "u", 40.0, 3.0),
        ("B", "y", None, None),
        ("B", "z", None, None),
        (None, "x", 8.0, 1.0),
        ("C", None, 1.0, 1.0),
    )


def test_gender_preferences(facts):
    found = {r.gender: tuple(r)[1:] for r in views.gender_preferences(facts).collect()}
    assert found == {
        "A": (5, 25.0, 3.0, "x"),
        "B": (2, None, None, "y"),
        None: (1, 8.0, 1.0, None),
        "C": (1, 1.0, 1.0, None),
    }


def test_location_preferences(facts):
    found = {r.location: tuple(r)[1:] for r in views.location_preferences(facts).collect()}
    assert found == {
        "A": (5, 25.0, ["x", "u", "v"]),
        "B": (2, None, ["y", "z"]),
        None: (1, 8.0, []),
        "C": (1, 1.0, []),
    }


def test_age_views(spark):
    people = orders(spark, {"age": 20}, {"age": 64}, {"age": None}, {"age": 80, "gender": None})
    found = {r.age_bucket: r.orders for r in views.age_preferences(people).collect()}
    assert found == {"18-24": 1, "55-64": 1, "65+": 2}
    cells = views.age_gender_category(people).collect()
    assert {(r.age_bucket, r.gender, r.orders) for r in cells} == {
        ("18-24", "Female", 1),
        ("55-64", "Female", 1),
        ("65+", "Female", 1),
        ("65+", None, 1),
    }


def test_top_items_break_ties_by_name(facts):
    ranked = top_items(facts, "gender", "category", 2).collect()
    found = {(r.gender, r.category, r["rank"]) for r in ranked}
    assert {f for f in found if f[0] == "A"} == {("A", "x", 1), ("A", "u", 2)}
    assert {f for f in found if f[0] == "B"} == {("B", "y", 1), ("B", "z", 2)}


def test_views_over_no_orders(facts, spark):
    for view in views.VIEWS.values():
        assert view(facts.limit(0)).collect() == []


def test_registered_views_answer_sql(facts, spark):
    views.register_views(facts)
    for name in views.VIEWS:
        assert spark.sql(f"SELECT sum(orders) FROM {name}").first()[0] == 9


def test_views_read_the_orders_once(facts, spark, tmp_path):
    path = str(tmp_path / "orders")
    facts.write.parquet(path)
    stored = spark.read.parquet(path)
    for view in views.VIEWS.values():
        plan = final_plan(view(stored))
        assert plan.count("FileScan parquet") == 1, plan
    # The ranking is cut to its top rows before the shuffle by location.
    assert "WindowGroupLimit" in final_plan(views.location_preferences(stored))


def test_sorted_reports_spread_equal_values(spark):
    same = enrich_orders(
        orders(spark, *[{"previous_purchases": 12, "purchase_amount_usd": 800.0}] * 40)
    ).repartition(8)
    for report in (reports.vip_premium, reports.anomalies, reports.high_clv):
        found = report(same)
        assert found.count() == 40
        assert "_spread" not in found.columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = reports.high_clv(same).rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 40


def test_sorted_reports_are_sorted(spark):
    rows_ = enrich_orders(
        orders(
            spark,
            *({"previous_purchases": p, "purchase_amount_usd": a} for p in (1, 2, 12, None)
              for a in (250.0, 900.0, 600.0, None)),
        )
    ).repartition(4)
    clv = [r.estimated_clv for r in reports.high_clv(rows_).collect()]
    assert clv == sorted(clv, reverse=True) and min(clv) > 500
    amounts = [r.final_amount_usd for r in reports.anomalies(rows_).collect()]
    assert amounts == sorted(amounts, reverse=True) and len(amounts) == 8
    potential = [r.estimated_clv for r in reports.high_potential(rows_).collect()]
    assert potential == sorted(potential, reverse=True) and len(potential) == 6
    vip = reports.vip_premium(rows_).collect()
    # An unknown amount counts as Premium; its value is unknown and sorts last.
    assert vip[-1].estimated_clv is None and len(vip) == 3
    segments = [r.avg_clv for r in reports.clv_by_segment(rows_).collect()]
    known = [s for s in segments if s is not None]
    assert known == sorted(known, reverse=True)
    plain = rows_.groupBy("customer_segment").avg("estimated_clv").collect()
    found = {r.customer_segment: r.avg_clv for r in reports.clv_by_segment(rows_).collect()}
    assert found == pytest.approx(dict(map(tuple, plain)))
    days = reports.clv_trend(rows_).collect()
    assert {r.customer_segment: r.avg_clv for r in days} == found
    levels = [(r.customer_segment) for r in reports.satisfaction_by_segment(rows_).collect()]
    assert levels == sorted(levels)

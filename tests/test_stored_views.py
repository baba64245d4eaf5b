import pytest
from helpers import bag, orders

from tillroll.operators.enrich import enrich_orders
from tillroll.plans import stored_views, views
from tillroll.sources.orders_table import OrdersTable


@pytest.fixture
def table(spark, tmp_path):
    yield OrdersTable(str(tmp_path / "orders"))
    for name in spark.catalog.listTables():
        if name.name.startswith("shop"):
            kind = "VIEW" if name.tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {name.name}")


CHANGES = [
    {"age": 20, "category": "a"},
    {"age": 20, "category": "b", "gender": None, "location": None},
    {"age": None, "category": "b", "review_rating": None},
    {"age": 70, "category": None, "purchase_amount_usd": None, "location": "Ohio"},
    {"age": 71, "category": "c", "location": "Ohio"},
    {"age": 72, "category": "d", "location": "Ohio"},
    {"age": 73, "category": "e", "location": "Ohio"},
]


def test_views_follow_the_table(spark, table):
    stored_views.register_table(spark, table, "shop")
    names = stored_views.create_views(spark, "shop", "shop_")
    assert names == [f"shop_{view}" for view in views.VIEWS]
    assert all(spark.table(name).count() == 0 for name in names)
    for part in (CHANGES[:3], CHANGES[3:]):
        table.append(enrich_orders(orders(spark, *part)))
        stored_views.refresh(spark, "shop")
        for name, view in zip(names, views.VIEWS.values(), strict=True):
            expected = view(table.read(spark))
            columns = expected.columns
            as_text = [f"CAST({c} AS string) AS {c}" for c in columns]
            found = spark.table(name)
            assert found.columns == columns
            assert bag(found.selectExpr(*as_text)) == bag(expected.selectExpr(*as_text))


def test_views_are_text_in_the_catalog(spark, table):
    stored_views.register_table(spark, table, "shop")
    (name, *_) = stored_views.create_views(spark, "shop", "shop_")
    kept = {t.name: t for t in spark.catalog.listTables()}
    assert kept[name].tableType == "VIEW" and not kept[name].isTemporary
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    assert "min_by(category" in text and "FROM shop" in text
    # Another session with the same catalog has them too.
    table.append(enrich_orders(orders(spark, *CHANGES)))
    other = spark.newSession()
    assert other.table(name).groupBy().sum("orders").first()[0] == len(CHANGES)
    # Creating them again replaces them; the table stays as it is.
    stored_views.register_table(spark, table, "shop")
    stored_views.create_views(spark, "shop", "shop_")
    stored_views.refresh(spark, "shop")
    assert spark.table(name).groupBy().sum("orders").first()[0] == len(CHANGES)


def test_views_read_the_table_once(spark, table):
    table.append(enrich_orders(orders(spark, *CHANGES)))
    stored_views.register_table(spark, table, "shop")
    for name in stored_views.create_views(spark, "shop", "shop_"):
        plan = spark.table(name)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        scan = plan[plan.index("FileScan parquet") :].splitlines()[0]
        assert "item_purchased" not in scan


def test_a_connector_has_its_own_catalog(spark):
    with pytest.raises(ValueError, match="connector"):
        stored_views.register_table(spark, OrdersTable("t", format="warehouse"), "shop")

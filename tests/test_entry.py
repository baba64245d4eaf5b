import __spark_entry__ as contract

from tillroll.registry.oracles import ORACLES
from tillroll.registry.queries import QUERIES
from tillroll.schema import COMPUTED_COLUMNS


def test_entry_runs_on_the_smoke_tables(spark):
    df = contract.entry(spark)
    assert df.columns == ["age_bucket", "orders", "avg_spend", "avg_rating", "top_category"]
    assert df.count() == 6


def test_every_order_operator_is_registered_with_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert {f"enrich_{column}" for column in COMPUTED_COLUMNS} < set(QUERIES)


def test_every_sql_text_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())

"""Rules stated once more in plain Python, over generated values."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import orders
from tillroll.functions.names import clean_names
from tillroll.operators.dedup import drop_known_rows, hashes_of, with_row_hash
from tillroll.operators.enrich import enrich_orders

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@given(st.lists(st.text(max_size=8), max_size=12))
def test_clean_names_are_unique_identifiers(headers):
    names = clean_names(headers)
    assert len(names) == len(set(names)) == len(headers)
    assert all(re.fullmatch(r"[a-z][a-z0-9]*(_[a-z0-9]+)*", name) for name in names)


order = st.fixed_dictionaries(
    {
        "purchase_amount_usd": st.none() | st.floats(-10, 1200),
        "previous_purchases": st.none() | st.integers(0, 20),
        "review_rating": st.none() | st.floats(0, 5),
        "discount_applied": st.sampled_from(["Yes", "No", None]),
        "subscription_status": st.sampled_from(["Yes", "No", None]),
    }
)


@FEW
@given(st.lists(order, min_size=1, max_size=30))
def test_enrichment_follows_the_rules(spark, changes):
    for row in enrich_orders(orders(spark, *changes)).collect():
        amount, prior, rating = row.purchase_amount_usd, row.previous_purchases, row.review_rating
        if amount is not None and row.discount_applied == "Yes":
            amount = amount * 0.9
        assert row.final_amount_usd == amount
        assert row.is_anomaly == (amount is not None and amount > 500)
        sizes = [(50, "Small"), (150, "Medium"), (300, "Large")]
        size = [s for limit, s in sizes if amount is not None and amount < limit]
        assert row.amount_category == (size or ["Premium"])[0]
        segments = [(10, "VIP"), (5, "Regular"), (2, "Occasional")]
        segment = [s for floor, s in segments if prior is not None and prior >= floor]
        assert row.customer_segment == (segment or ["New"])[0]
        delighted = rating is not None and rating >= 4.5
        assert (row.satisfaction_level == "Very Satisfied") == delighted
        yes = row.subscription_status == "Yes"
        points = prior or 0
        loyal = "High" if yes and points >= 5 else "Medium" if yes or points >= 3 else "Low"
        assert row.loyalty_score == loyal


@FEW
@given(
    st.lists(st.integers(0, 6), max_size=40),
    st.sets(st.integers(0, 6)),
    st.sampled_from([0, 1000]),
)
def test_known_rows_are_dropped(spark, batch, known, limit):
    received = with_row_hash(orders(spark, {}, *({"customer_id": i} for i in batch))).filter(
        "customer_id < 7"
    )
    stored = hashes_of(orders(spark, {}, *({"customer_id": i} for i in known)))
    fresh = drop_known_rows(received, stored, max(len(batch), 1), limit)
    assert sorted(r.customer_id for r in fresh.collect()) == sorted(
        i for i in batch if i not in known
    )

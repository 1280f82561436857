"""Golden micro-tables for enriched orders, customers, funnel and marts."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from basketry.operators import intermediate, marts, staging
from tests.conftest import rows_by


def enrich(source, orders, items, users, products):
    return intermediate.int_orders_enriched(
        staging.stg_orders(source("orders", orders)),
        staging.stg_order_items(source("order_items", items)),
        staging.stg_users(source("users", users)),
        staging.stg_products(source("products", products)),
    )


USA = {"country": "United States"}


def test_enriched_order(spark, source):
    got = rows_by(enrich(
        source,
        orders=[
            {"order_id": 1, "user_id": 1, "gender": "M", "status": "Complete"},
            {"order_id": 2, "user_id": 2, "gender": "M"},  # customer abroad
            {"order_id": 3, "user_id": None},  # no customer
            {"order_id": 4, "user_id": 1},  # no items
        ],
        items=[
            {"id": "a", "order_id": 1, "product_id": 1, "sale_price": 30.0},
            {"id": "b", "order_id": 1, "product_id": 1, "sale_price": 20.0, "status": "Returned"},
            {"id": "c", "order_id": 1, "product_id": 9, "sale_price": 10.0},  # unpriced product
            {"id": "d", "order_id": 2, "product_id": None, "sale_price": 5.0},
        ],
        users=[
            {"id": 1, "gender": "F", "state": "Ohio", "age": 30, "traffic_source": "Search", **USA},
            {"id": 2, "gender": "F", "state": "Quebec", "country": "Canada"},
        ],
        products=[
            {"id": 1, "cost": 12.0, "retail_price": 35.0},
            {"id": 9, "cost": 7.0, "retail_price": 0.0},
        ],
    ), "order_id")
    assert set(got) == {"1", "2", "3", "4"}
    one = got["1"]
    assert one["gender"] == "F"  # the customer's, not the order's
    assert (one["customer_state"], one["age_group"]) == ("Ohio", "25-34")
    assert (one["item_count"], one["unique_products"]) == (3, 2)
    assert (one["gross_revenue"], one["returned_revenue"], one["net_revenue"]) == (60.0, 20.0, 40.0)
    # The unpriced product sells without a cost; returned items still carry one.
    assert (one["total_cost"], one["gross_profit"]) == (24.0, 36.0)
    assert one["order_value_tier"] == "Mid ($50-150)"
    two = got["2"]
    assert two["customer_state"] is None and two["gender"] is None
    assert (two["item_count"], two["unique_products"], two["total_cost"]) == (1, 0, 0.0)
    assert got["3"]["user_id"] is None and got["3"]["traffic_source"] is None
    four = got["4"]
    assert (four["item_count"], four["gross_revenue"], four["gross_profit"]) == (0, 0.0, 0.0)
    assert four["order_value_tier"] == "Low (<$50)"


def test_fused_totals_equal_the_two_rollups(spark, source):
    items = staging.stg_order_items(source("order_items", [
        {"id": str(i), "order_id": i % 4, "product_id": i % 5, "sale_price": float(i)}
        for i in range(40)
    ]))
    products = staging.stg_products(source("products", [
        {"id": 0, "cost": 1.0, "retail_price": 2.0},
        {"id": 1, "cost": 2.0, "retail_price": 2.0},
        {"id": 3, "cost": 2.5, "retail_price": 2.0},
        {"id": 2, "cost": None, "retail_price": 2.0},
    ]))
    fused = rows_by(intermediate.order_totals(items, products), "order_id")
    parts = rows_by(intermediate.item_rollup(items), "order_id")
    costs = rows_by(intermediate.cost_rollup(items, products), "order_id")
    for order, row in fused.items():
        assert row.pop("total_cost") == costs[order]["total_cost"]
        assert row == parts[order]


@pytest.mark.parametrize("gross, tier", [
    (49.99, "Low (<$50)"), (50.0, "Mid ($50-150)"), (149.99, "Mid ($50-150)"),
    (150.0, "High ($150-300)"), (299.99, "High ($150-300)"), (300.0, "Premium (>$300)"),
    (49.99999999999999, "Mid ($50-150)"), (0.0, "Low (<$50)"),
])
def test_tier_boundaries(spark, gross, tier):
    from pyspark.sql import functions as F

    row = spark.range(1).select(intermediate.order_value_tier(F.lit(gross)).alias("t")).first()
    assert row.t == tier


ORDER_FIELDS = (
    "order_id string, user_id string, order_status string, order_date date, order_month date, "
    "net_revenue double, is_returned boolean, age_group string, gender string, "
    "customer_state string, traffic_source string"
)


def orders_frame(spark, rows):
    """(order, user, status, date, net, returned)"""
    return spark.createDataFrame(
        [(o, u, s, d, d and d.replace(day=1), n, r, "25-34", "F", "Ohio", "Search")
         for o, u, s, d, n, r in rows],
        ORDER_FIELDS,
    )


def test_customer_measures(spark):
    day = date(2023, 3, 10)
    orders = orders_frame(spark, [
        ("1", "a", "Complete", day, 10.0, False),
        ("2", "a", "Complete", date(2023, 1, 1), 20.0, True),
        ("3", "a", "complete", date(2024, 1, 1), 99.0, False),  # other spelling: not counted
        ("4", "b", "Complete", date(2023, 3, 1), 5.0, False),
        ("5", "c", "Shipped", date(2024, 1, 1), 7.0, False),
        ("6", None, "Complete", date(2023, 3, 2), 1.0, False),
    ])
    got = rows_by(
        intermediate.with_recency(intermediate.customer_measures(orders)), "user_id"
    )
    assert set(got) == {"a", "b", None}
    a = got["a"]
    assert (a["frequency"], a["monetary"], a["avg_order_value"]) == (2, 30.0, 15.0)
    assert (a["first_order_date"], a["last_order_date"]) == (date(2023, 1, 1), day)
    # Counted from the latest completed order, not from today.
    assert (a["recency_days"], got["b"]["recency_days"]) == (0, 9)
    assert (a["returned_orders"], a["return_rate_pct"]) == (1, 50.0)
    assert (a["state"], a["traffic_source"]) == ("Ohio", "Search")


def test_scores_and_segments(spark):
    """Ten customers, all with one order: frequency ties fall to the user id."""
    orders = orders_frame(spark, [
        (str(i), f"u{i}", "Complete", date(2023, 1, 1 + i), 100.0 - i, False) for i in range(10)
    ])
    got = rows_by(intermediate.int_customer_stats(orders), "user_id")
    scores = [(got[f"u{i}"]["r_score"], got[f"u{i}"]["f_score"], got[f"u{i}"]["m_score"])
              for i in range(10)]
    assert scores == [(1 + i // 2, 1 + i // 2, 5 - i // 2) for i in range(10)]
    assert got["u9"]["rfm_segment"] == "Loyal Customers"
    assert got["u0"]["rfm_segment"] == "Hibernating"


def test_segment_rules_for_every_score(spark):
    """All 125 score triples against the rules read one by one."""
    from pyspark.sql import functions as F

    def expected(r, f, m):
        if r >= 4 and f >= 4 and m >= 4:
            return "Champions"
        if r >= 3 and f >= 3:
            return "Loyal Customers"
        if r >= 4 and f <= 2:
            return "New Customers"
        if r >= 3 and m >= 3:
            return "Potential Loyalists"
        if r <= 2 and f >= 3 and m >= 3:
            return "At Risk"
        if r <= 2 and f <= 2:
            return "Hibernating"
        return "Needs Attention"

    five = [spark.range(1, 6).withColumnRenamed("id", c) for c in "rfm"]
    triples = five[0].join(five[1]).join(five[2])
    rows = triples.withColumn(
        "segment", intermediate.rfm_segment(F.col("r"), F.col("f"), F.col("m"))
    ).collect()
    assert len(rows) == 125
    assert all(row.segment == expected(row.r, row.f, row.m) for row in rows)


def test_cohorts(spark):
    jan, feb, april = date(2023, 1, 31), date(2023, 2, 1), date(2023, 4, 5)
    orders = orders_frame(spark, [
        ("1", "a", "Complete", jan, 1.0, False),
        ("2", "a", "Complete", feb, 1.0, False),
        ("3", "a", "Complete", feb, 1.0, False),  # twice in a month counts once
        ("4", "b", "Complete", jan, 1.0, False),
        ("5", "b", "Complete", april, 1.0, False),
        ("6", "c", "Complete", feb, 1.0, False),
        ("7", "c", "Shipped", jan, 1.0, False),
        ("8", None, "Complete", jan, 1.0, False),
        ("9", "d", "Complete", None, 1.0, False),  # no month at all
        ("10", "b", "Complete", None, 1.0, False),
    ])
    got = {
        (r.cohort_month.month, r.activity_month and r.activity_month.month):
            (r.months_since_first, r.active_users, r.cohort_size, r.retention_pct)
        for r in marts.mart_cohort_retention(orders).collect()
    }
    assert got == {
        (1, 1): (0, 2, 2, 100.0), (1, 2): (1, 1, 2, 50.0), (1, 4): (3, 1, 2, 50.0),
        (1, None): (None, 1, 2, 50.0), (2, 2): (0, 1, 1, 100.0),
    }


def test_product_performance(spark, source):
    orders = orders_frame(spark, [
        *[(str(i), "a", "Complete", date(2023, 1, 1), 1.0, False) for i in range(5)],
        ("9", "a", "Shipped", date(2023, 1, 1), 1.0, False),
    ])
    items = staging.stg_order_items(source("order_items", [
        *[{"id": f"x{i}", "order_id": i, "product_id": 1, "sale_price": 40.0} for i in range(5)],
        {"id": "x5", "order_id": 0, "product_id": 1, "sale_price": 10.0, "status": "Returned"},
        {"id": "x6", "order_id": 9, "product_id": 1, "sale_price": 999.0},
        # four distinct orders in five rows: below the limit
        *[{"id": f"y{i}", "order_id": i % 4, "product_id": 2, "sale_price": 1.0} for i in range(5)],
        *[{"id": f"z{i}", "order_id": i, "product_id": 3, "sale_price": 1.0} for i in range(5)],
    ]))
    products = staging.stg_products(source("products", [
        {"id": 1, "name": "shirt", "cost": 20.0, "retail_price": 50.0},
        {"id": 2, "cost": 1.0, "retail_price": 1.0},
        {"id": 3, "cost": 1.0, "retail_price": 0.0},  # unpriced: gone
    ]))
    (row,) = marts.mart_product_performance(items, products, orders).collect()
    assert (row.product_id, row.product_name, row.margin_pct) == ("1", "shirt", 150.0)
    assert (row.total_orders, row.total_units_sold, row.total_revenue) == (5, 6, 210.0)
    assert (row.avg_sale_price, row.avg_discount_pct) == (35.0, 30.0)
    assert (row.returned_units, row.return_rate_pct) == (1, 16.67)


def test_funnel(spark, source):
    def event(session, kind, moment):
        return {"id": 1, "session_id": session, "event_type": kind, "created_at": moment}

    jan, feb = datetime(2023, 1, 31, 23, 59), datetime(2023, 2, 1)
    events = staging.stg_events(source("events", [
        event("crossing", "home", jan), event("crossing", "purchase", feb),
        event("cancelled", "cancel", jan),
        event("shopper", "brand", feb), event("shopper", "category", feb),
        event("shopper", "product", feb),
        event("noise", "error", jan),
    ]))
    sessions = rows_by(intermediate.session_rollup(events), "session_id")
    assert set(sessions) == {"crossing", "cancelled", "shopper"}
    assert sessions["crossing"]["event_month"] == date(2023, 1, 1)
    assert sessions["cancelled"]["total_events"] == 1
    months = rows_by(intermediate.int_funnel(events), "event_month")
    january, february = months[date(2023, 1, 1)], months[date(2023, 2, 1)]
    assert (january["total_sessions"], january["visited_home"], january["purchased"]) == (2, 1, 1)
    assert january["home_to_browse_pct"] == 0.0
    # Zero denominators give NULL.
    assert january["browse_to_product_pct"] is None and january["cart_to_purchase_pct"] is None
    assert january["overall_conversion_pct"] == 50.0
    # Browsing is counted once per session; the rate divides by all sessions.
    assert (february["browsed_category"], february["home_to_browse_pct"]) == (1, 100.0)
    assert february["product_to_cart_pct"] == 0.0

"""Physical plans: what reaches the scan, and how hot keys are handled."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from basketry.operators import intermediate, kpis, marts
from basketry.plans.scratch import materialize


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Joins as between big tables, and a skew limit small enough for test data.
BIG = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": 16,
}
ROWS = 40_000


@pytest.fixture(scope="module")
def hot(spark):
    """Items of which one product holds a third, orders of which one user holds a third."""
    n = F.col("id")
    items = spark.range(0, ROWS, 1, 8).select(
        n.cast("string").alias("order_item_id"),
        (n % 9000).cast("string").alias("order_id"),
        F.when(n % 3 == 0, "hot").otherwise((n % 997).cast("string")).alias("product_id"),
        (n % 100).cast("double").alias("sale_price"),
        (n % 7 == 0).alias("is_returned"),
    )
    products = spark.range(997).select(
        n.cast("string").alias("product_id"), F.lit(1.0).alias("cost"), F.lit(3.0).alias("retail_price")
    ).union(spark.sql("SELECT 'hot', 2.0D, 3.0D"))
    orders = spark.range(0, ROWS, 1, 8).select(
        n.cast("string").alias("order_id"),
        F.when(n % 3 == 0, F.lit(None)).otherwise((n % 997).cast("string")).alias("user_id"),
        F.lit("Complete").alias("order_status"),
        F.lit("x").alias("gender"),
        *[F.lit(None).cast("timestamp_ntz").alias(c)
          for c in ("created_at", "shipped_at", "delivered_at", "returned_at")],
        *[F.lit(None).cast("date").alias(c) for c in ("order_date", "order_month")],
        F.lit(1).cast("long").alias("fulfillment_days"),
        F.lit(False).alias("is_returned"),
    )
    users = spark.range(997).select(
        n.cast("string").alias("user_id"),
        *[F.lit("v").alias(c) for c in ("state", "city", "age_group", "gender", "traffic_source")],
    )
    return {k: materialize(v, f"hot-{k}") for k, v in
            {"items": items, "products": products, "orders": orders, "users": users}.items()}


def test_hot_product_is_split(spark, hot):
    with settings(spark, **BIG):
        totals = intermediate.order_totals(hot["items"], hot["products"])
        got = totals.agg(F.sum("item_count"), F.sum("total_cost")).collect()[0]
        totals.collect()
        assert "skew=true" in plan_of(totals)
    hot_items = hot["items"].where("product_id = 'hot'").count()
    assert tuple(got) == (ROWS, ROWS + hot_items)


def test_hot_missing_user_is_split(spark, hot):
    with settings(spark, **BIG):
        enriched = intermediate.int_orders_enriched(
            hot["orders"], hot["items"], hot["users"], hot["products"]
        )
        rows = enriched.collect()
        assert "skew=true" in plan_of(enriched)
    assert len(rows) == ROWS
    assert sum(r.user_id is None for r in rows) == len(range(0, ROWS, 3))


def test_best_seller_is_summed_before_the_join(spark, hot):
    """Items are aggregated before product attributes are joined on."""
    plan = plan_of(performance(hot, hot["items"]))
    join_to_products = plan.index("Inner")
    assert join_to_products < plan.index("HashAggregate(keys=[product_id")
    assert "LeftSemi" in plan


def performance(hot, items):
    products = hot["products"].select(
        "product_id",
        *[F.lit("v").alias(c) for c in ("product_name", "category", "brand", "department")],
        "retail_price", "cost", F.lit(1.0).alias("margin_pct"),
    )
    return marts.mart_product_performance(items, products, hot["orders"])


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_items_are_shuffled_once_for_product_performance(spark, hot):
    """The order filter shuffles the items; counting distinct orders adds nothing."""
    with settings(spark, **BIG):
        plan = final_plan(performance(hot, hot["items"]))
    assert "LeftSemi" in plan and "Exchange hashpartitioning(product_id#" in plan
    assert not any(
        "Exchange" in line and "product_id" in line and "order_id" in line
        for line in plan.splitlines()
    )


def test_hot_order_is_split(spark, hot):
    """An order with a third of all items; the product sums do not change."""
    third = F.col("order_item_id").cast("long") % 3 == 0
    items = materialize(
        hot["items"].withColumn("order_id", F.when(third, "7").otherwise(F.col("order_id"))),
        "hot-order",
    )
    with settings(spark, **BIG):
        mart = performance(hot, items)
        assert "skew=true" in final_plan(mart)
        units = mart.agg(F.sum("total_units_sold")).first()[0]
    kept = items.groupBy("product_id").agg(F.count_distinct("order_id").alias("o"), F.count("*").alias("n"))
    assert units == kept.where("o >= 5").agg(F.sum("n")).first()[0]


def test_scan_reads_only_what_a_table_needs(spark, hot):
    monthly = kpis.monthly_revenue(
        materialize(hot["orders"].withColumn("gross_revenue", F.lit(1.0)), "fct")
    )
    text = plan_of(monthly)
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "user_id" not in schema and "gross_revenue" in schema
    assert "PushedFilters: [IsNotNull(order_status), IsNotNull(order_month)]" in text


def test_unused_columns_of_the_rollup_are_not_computed(spark, hot):
    enriched = intermediate.int_orders_enriched(
        hot["orders"], hot["items"], hot["users"], hot["products"]
    )
    assert "returned_items" not in plan_of(enriched)


def test_cohort_window_sees_one_row_per_month(spark, hot):
    """The duplicates of a hot customer go before rows are keyed by customer alone."""
    text = plan_of(marts.cohort_activity(hot["orders"].withColumn("order_month", F.current_date())))
    window = text.index("Window [min(")
    assert window < text.index("HashAggregate(keys=[user_id", window)


def test_customers_and_sessions_are_summed_by_hash_before_their_shuffle(spark, hot):
    """No sort below the first exchange: text maxima come after the sums."""
    orders = hot["orders"].select("*", *[F.lit("v").alias(c) for c in ("age_group", "customer_state", "traffic_source")])
    orders = orders.withColumn("net_revenue", F.lit(1.0))
    events = spark.read.parquet(*hot["orders"].inputFiles()).select(
        F.col("order_id").alias("session_id"), F.lit("home").alias("event_type"), "user_id",
        F.current_timestamp().alias("event_at"), F.col("user_id").alias("traffic_source"), F.col("gender").alias("browser"),
    )
    for df, key in ((intermediate.customer_measures(orders), "user_id"), (intermediate.session_rollup(events), "session_id")):
        # From the result down to the scan: the last exchange is the first to run.
        below = plan_of(df).rsplit("Exchange", 1)[1]
        assert f"HashAggregate(keys=[{key}" in below and "Sort" not in below

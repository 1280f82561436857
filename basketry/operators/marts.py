"""Business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import count_true, month_boundaries, percent
from basketry.operators.intermediate import completed_orders

# Fixed values.
FCT_ORDERS_COLUMNS = (
    "order_id", "user_id", "customer_state", "customer_city", "age_group", "gender",
    "traffic_source", "order_status", "order_date", "order_month", "created_at", "shipped_at",
    "delivered_at", "fulfillment_days", "is_returned", "item_count", "gross_revenue",
    "returned_revenue", "net_revenue", "total_cost", "gross_profit", "unique_products",
    "order_value_tier",
)
DIM_CUSTOMERS_COLUMNS = (
    "user_id", "frequency", "monetary", "avg_order_value", "recency_days", "last_order_date",
    "first_order_date", "return_rate_pct", "returned_orders", "r_score", "f_score", "m_score",
    "rfm_segment", "age_group", "gender", "state", "traffic_source",
)
COHORT_RETENTION_COLUMNS = (
    "cohort_month", "activity_month", "months_since_first", "active_users", "cohort_size",
    "retention_pct",
)
MIN_ORDERS_PER_PRODUCT = 5


def fct_orders(orders_enriched: DataFrame) -> DataFrame:
    return orders_enriched.select(*FCT_ORDERS_COLUMNS)


def dim_customers(customer_stats: DataFrame) -> DataFrame:
    return customer_stats.select(*DIM_CUSTOMERS_COLUMNS)


def mart_product_performance(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales scorecard per product over completed orders.

    The orders only filter the items, hence a semi join. Items are summed per
    product before the product attributes are joined on: map-side aggregation
    absorbs a best-seller, and the join sees one row per product. Of an item's id
    only its presence is counted, so the join does not carry the text.
    """
    named = F.col("order_item_id").isNotNull().alias("is_named")
    sold = items.select("order_id", "product_id", named, "sale_price", "is_returned").join(
        completed_orders(orders).select("order_id"), "order_id", "left_semi"
    )
    units, back = count_true(F.col("is_named")), count_true(F.col("is_returned"))
    sales = (
        sold.groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            units.alias("total_units_sold"),
            F.sum("sale_price").alias("total_revenue"),
            F.avg("sale_price").alias("avg_sale_price"),
            back.alias("returned_units"),
            percent(back, units, 2).alias("return_rate_pct"),
        )
        .where(F.col("total_orders") >= MIN_ORDERS_PER_PRODUCT)
    )
    paid_share = F.col("avg_sale_price") / F.nullif("retail_price", F.lit(0.0))
    return products.join(sales, "product_id").select(
        "product_id",
        "product_name",
        "category",
        "brand",
        "department",
        "retail_price",
        "cost",
        "margin_pct",
        "total_orders",
        "total_units_sold",
        "total_revenue",
        "avg_sale_price",
        F.round((1 - paid_share) * 100, 2).alias("avg_discount_pct"),
        "returned_units",
        "return_rate_pct",
    )


def first_purchase_months(orders: DataFrame) -> DataFrame:
    """Cohort month per customer."""
    return (
        completed_orders(orders)
        .groupBy("user_id")
        .agg(F.min("order_month").alias("cohort_month"))
    )


def cohort_activity(orders: DataFrame) -> DataFrame:
    """Customers active per cohort and month.

    Orders shrink to one row per customer and month before anything is keyed by
    customer alone, so the window below sees at most one row per month, however
    many orders a customer has; and no self-join is needed.
    """
    active_months = (
        completed_orders(orders)
        .where(F.col("user_id").isNotNull())
        .select("user_id", F.col("order_month").alias("activity_month"))
        .distinct()
    )
    first_month = F.min("activity_month").over(Window.partitionBy("user_id"))
    return (
        active_months.withColumn("cohort_month", first_month)
        .groupBy("cohort_month", "activity_month")
        .agg(F.count("*").alias("active_users"))
        .withColumn(
            "months_since_first", month_boundaries(F.col("activity_month"), F.col("cohort_month"))
        )
    )


def mart_cohort_retention(orders: DataFrame) -> DataFrame:
    """Share of each cohort that is active again in each later month."""
    # A cohort holds one row per month: its size is the month-0 row.
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_users")))
    return (
        cohort_activity(orders)
        .where(F.col("cohort_month").isNotNull())
        .withColumn("cohort_size", size.over(Window.partitionBy("cohort_month")))
        .withColumn("retention_pct", percent(F.col("active_users"), F.col("cohort_size"), 2))
        .select(*COHORT_RETENTION_COLUMNS)
        .orderBy("cohort_month", "months_since_first")
    )


def mart_funnel(funnel: DataFrame) -> DataFrame:
    return funnel.select("*")

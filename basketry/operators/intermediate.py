"""Enriched orders, customer statistics with RFM scores, and the monthly funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import (
    FLOAT_NOISE,
    count_true,
    days_between,
    denoised,
    first_match,
    month_start,
    percent,
)
from basketry.operators.ranking import Score, global_ntile
from basketry.plans.scratch import Scratch, materialize

# Fixed values.
COMPLETE = "Complete"
TIER_CEILINGS = ((50, "Low (<$50)"), (150, "Mid ($50-150)"), (300, "High ($150-300)"))
TOP_TIER = "Premium (>$300)"
ENRICHED_COLUMNS = (
    "order_id", "user_id", "customer_state", "customer_city", "age_group", "gender",
    "traffic_source", "order_status", "order_date", "order_month", "created_at", "shipped_at",
    "delivered_at", "returned_at", "fulfillment_days", "is_returned", "item_count",
    "gross_revenue", "returned_revenue", "net_revenue", "total_cost", "gross_profit",
    "unique_products", "order_value_tier",
)
RFM_SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "New Customers",
    "Potential Loyalists",
    "At Risk",
    "Hibernating",
    "Needs Attention",
)


# ---------------------------------------------------------------- orders


def item_rollup(items: DataFrame) -> DataFrame:
    """Item totals per order."""
    return items.groupBy("order_id").agg(*_item_totals())


def _item_totals() -> list[Column]:
    back = F.col("is_returned")
    return [
        F.count("*").alias("item_count"),
        F.sum("sale_price").alias("gross_revenue"),
        F.sum(F.when(back, F.col("sale_price")).otherwise(0.0)).alias("returned_revenue"),
        F.count_distinct("product_id").alias("unique_products"),
        count_true(back).alias("returned_items"),
    ]


def cost_rollup(items: DataFrame, products: DataFrame) -> DataFrame:
    """Cost and list price per order, over the items whose product is known."""
    return (
        items.select("order_id", "product_id")
        .join(products.select("product_id", "cost", "retail_price"), "product_id")
        .groupBy("order_id")
        .agg(
            F.avg("cost").alias("avg_item_cost"),
            F.avg("retail_price").alias("avg_retail_price"),
            F.sum("cost").alias("total_cost"),
        )
    )


def order_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item totals plus total cost per order, reading the items once.

    The same numbers as ``item_rollup`` left-joined to ``cost_rollup``, given that
    ``product_id`` is unique among the products (one of the data checks). An item
    without a known product adds no cost. Both join inputs come straight from their
    shuffle: with an aggregation in between, Spark would not split a hot product.
    """
    return (
        items.join(products.select("product_id", "cost"), "product_id", "left")
        .groupBy("order_id")
        .agg(*_item_totals(), F.sum("cost").alias("total_cost"))
    )


def order_value_tier(gross: Column) -> Column:
    """Tier of an order; an amount short of a ceiling by float noise has reached it."""
    return first_match(
        [(gross < ceiling - FLOAT_NOISE, label) for ceiling, label in TIER_CEILINGS], TOP_TIER
    )


def int_orders_enriched(
    orders: DataFrame, items: DataFrame, users: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order with its customer's attributes, totals, profit and tier."""
    buyers = users.select(
        "user_id",
        F.col("state").alias("customer_state"),
        F.col("city").alias("customer_city"),
        "age_group",
        "gender",
        "traffic_source",
    )
    joined = (
        # The order's own gender gives way to the customer's.
        orders.drop("gender")
        .join(order_totals(items, products), "order_id", "left")
        .join(buyers, "user_id", "left")
    )
    gross, returned, cost = (
        F.coalesce(F.col(c), F.lit(0.0)) for c in ("gross_revenue", "returned_revenue", "total_cost")
    )
    amounts = {
        "item_count": F.coalesce("item_count", F.lit(0)),
        "gross_revenue": gross,
        "returned_revenue": returned,
        "net_revenue": gross - returned,
        "total_cost": cost,
        "gross_profit": gross - cost,
        "unique_products": F.coalesce("unique_products", F.lit(0)),
        "order_value_tier": order_value_tier(gross),
    }
    return joined.withColumns(amounts).select(*ENRICHED_COLUMNS)


# ------------------------------------------------------------- customers


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == COMPLETE)


def customer_measures(orders: DataFrame) -> DataFrame:
    """Purchase measures per customer over completed orders.

    ``order_id`` is unique among them (one of the data checks), so orders are counted. An order's customer
    attributes follow from the customer: grouping by them first sums orders by hash, on the map
    side, and leaves the text maxima a row or so per customer.
    """
    attributes = {
        "age_group": "age_group",
        "gender": "gender",
        "state": "customer_state",
        "traffic_source": "traffic_source",
    }
    alike = (
        completed_orders(orders)
        .groupBy("user_id", *attributes.values())
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("net_revenue").alias("revenue"),
            F.count("net_revenue").alias("priced"),
            F.max("order_date").alias("last"),
            F.min("order_date").alias("first"),
            count_true(F.col("is_returned")).alias("returned"),
        )
    )
    orders_, returned = F.sum("orders"), F.sum("returned")
    return alike.groupBy("user_id").agg(
        orders_.alias("frequency"),
        F.sum("revenue").alias("monetary"),
        F.max("last").alias("last_order_date"),
        F.min("first").alias("first_order_date"),
        (F.sum("revenue") / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_order_value"),
        *[F.max(source).alias(name) for name, source in attributes.items()],
        returned.alias("returned_orders"),
        percent(returned, orders_, 1).alias("return_rate_pct"),
    )


def with_recency(measures: DataFrame) -> DataFrame:
    """Days from each customer's last order to the latest completed order.

    The latest of the customers' last orders is the latest completed order, so the
    reference date needs no second look at the orders.
    """
    latest = measures.agg(F.max("last_order_date")).scalar()
    return measures.withColumn("recency_days", days_between(latest, F.col("last_order_date")))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    champions, loyal, new, potential, at_risk, hibernating, other = RFM_SEGMENTS
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), champions),
            ((r >= 3) & (f >= 3), loyal),
            ((r >= 4) & (f <= 2), new),
            ((r >= 3) & (m >= 3), potential),
            ((r <= 2) & (f >= 3) & (m >= 3), at_risk),
            ((r <= 2) & (f <= 2), hibernating),
        ],
        other,
    )


def rfm_scores(measures: DataFrame) -> DataFrame:
    """Quintile scores: 5 is the freshest, the most frequent, the highest spending."""
    return global_ntile(
        measures,
        [
            # Descending recency is ascending last order date: stalest first, and a
            # customer without any date comes last.
            Score("r_score", F.unix_date("last_order_date"), nulls_last=True),
            Score("f_score", F.col("frequency")),
            Score("m_score", denoised(F.col("monetary"))),
        ],
        tie="user_id",
        tiles=5,
    )


def int_customer_stats(orders: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """RFM measures, scores and segment per customer with a completed order.

    The measures are stored once, because scoring reads them several times; with ``scratch`` they
    last as long as that does.
    """
    measures = materialize(customer_measures(orders), "customer_measures", scratch)
    scored = rfm_scores(measures)
    return with_recency(scored).withColumn(
        "rfm_segment", rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


# ---------------------------------------------------------------- funnel

# Stage name and the event types that reach it.
FUNNEL_STAGES = {
    "visited_home": ("home",),
    "browsed_category": ("category", "brand"),
    "viewed_product": ("product",),
    "added_to_cart": ("cart",),
    "purchased": ("purchase",),
}
# Rate, numerator, denominator.
FUNNEL_RATES = (
    ("home_to_browse_pct", "browsed_category", "total_sessions"),
    ("browse_to_product_pct", "viewed_product", "browsed_category"),
    ("product_to_cart_pct", "added_to_cart", "viewed_product"),
    ("cart_to_purchase_pct", "purchased", "added_to_cart"),
    ("overall_conversion_pct", "purchased", "total_sessions"),
)


def _sessions(events: DataFrame, *also: str) -> DataFrame:
    """Per session, and per value of the columns ``also``: first event, stages reached, events."""
    reached = [
        F.max(F.col("event_type").isin(*types).cast("int")).alias(stage)
        for stage, types in FUNNEL_STAGES.items()
    ]
    return events.groupBy("session_id", *also).agg(
        F.min("event_at").alias("began"), *reached, F.count("*").alias("total_events")
    )


def session_rollup(events: DataFrame) -> DataFrame:
    """One row per session: month of its first event and the stages it reached.

    Grouping by the texts first counts events by hash, and leaves their maxima a row or so per session.
    """
    return (
        _sessions(events, "traffic_source", "browser")
        .groupBy("session_id")
        .agg(
            month_start(F.min("began")).alias("event_month"),
            *[F.max(stage).alias(stage) for stage in FUNNEL_STAGES],
            F.sum("total_events").alias("total_events"),
            F.max("traffic_source").alias("traffic_source"),
            F.max("browser").alias("browser"),
        )
    )


def int_funnel(events: DataFrame) -> DataFrame:
    """Sessions, stage counts and step rates per month."""
    monthly = (
        _sessions(events)
        .groupBy(month_start(F.col("began")).alias("event_month"))
        .agg(
            F.count("*").alias("total_sessions"),
            *[F.sum(stage).alias(stage) for stage in FUNNEL_STAGES],
        )
    )
    rates = [
        percent(F.col(part), F.col(whole), 2).alias(name) for name, part, whole in FUNNEL_RATES
    ]
    return monthly.select("*", *rates).orderBy("event_month")

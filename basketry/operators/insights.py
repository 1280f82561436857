"""Figures behind each written insight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import percent
from basketry.operators import kpis


def executive_metrics(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """(metric, value) for the sales figures and the number of customers."""
    customers = dim.agg(F.count("*")).scalar()
    row = kpis.sales_kpis(fct).withColumn("total_customers", customers)
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in row.columns
    ]
    return row.select(F.inline(F.array(*pairs)))


def recent_months(fct: DataFrame, n: int = 6) -> DataFrame:
    monthly = kpis.monthly_revenue(fct)
    return monthly.orderBy(F.desc("order_month")).limit(n).orderBy("order_month")


def segment_distribution(dim: DataFrame) -> DataFrame:
    return kpis.segment_counts(dim)


def top_states(fct: DataFrame, n: int = 5) -> DataFrame:
    return kpis.top_states_by_revenue(fct, n)


def revenue_anomalies(fct: DataFrame) -> DataFrame:
    """Month-over-month revenue change, flagged beyond mean + 2 standard deviations.

    The first month, and a month after one without revenue, has no change and is
    never flagged. The windows run over one row per month.
    """
    monthly = kpis.monthly_revenue(fct)
    previous = F.lag("revenue").over(Window.orderBy("order_month"))
    change = percent(F.col("revenue") - previous, previous)
    everything = Window.orderBy("order_month").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    mom = F.col("revenue_mom_pct")
    limit = F.avg(mom).over(everything) + 2 * F.stddev_samp(mom).over(everything)
    return (
        monthly.withColumn("revenue_mom_pct", change)
        .withColumn("is_anomaly", F.coalesce(F.abs(mom) > limit, F.lit(False)))
        .orderBy("order_month")
    )


def flagged_months(fct: DataFrame) -> DataFrame:
    return revenue_anomalies(fct).where("is_anomaly").drop("is_anomaly")


def segment_profile(dim: DataFrame) -> DataFrame:
    """Size and means per segment, best first; a NULL segment would be kept."""
    return (
        dim.groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.round(F.avg("monetary"), 2).alias("avg_revenue"),
            F.round(F.avg("recency_days"), 0).alias("avg_recency_days"),
            F.round(F.avg("frequency"), 2).alias("avg_orders"),
        )
        .orderBy(F.desc("avg_revenue"), "rfm_segment")
    )


def funnel_step_rates(funnel: DataFrame) -> DataFrame:
    """All-time stage counts, each as a share of the stage before."""
    seen, cart, bought = (F.col(c) for c in ("viewed_product", "added_to_cart", "purchased"))
    sessions = F.col("total_sessions")
    return kpis.all_time(funnel).select(
        "*",
        percent(seen, sessions).alias("viewed_pct"),
        percent(cart, seen).alias("cart_pct"),
        percent(bought, cart).alias("purchase_pct"),
        percent(bought, sessions).alias("overall_cvr_pct"),
    )

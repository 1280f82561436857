"""Dashboard tables, aggregated in Spark from the published marts.

Group keys that are NULL are left out throughout. "Completed" ignores case here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import percent, ratio
from basketry.operators.staging import AGE_GROUPS


def is_completed(status: str = "order_status") -> Column:
    return F.lower(status) == "complete"


def completed(fct: DataFrame) -> DataFrame:
    return fct.where(is_completed())


def _per_key(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def _top(df: DataFrame, measure: str, n: int) -> DataFrame:
    """The n largest rows; equal measures in key order."""
    return df.orderBy(F.desc(measure), df.columns[0]).limit(n)


def _counts(df: DataFrame, key: str, alias: str) -> DataFrame:
    counted = _per_key(df, key, F.count("*").alias("count")).withColumnRenamed(key, alias)
    return counted.orderBy(F.desc("count"), alias)


# ----------------------------------------------------------------- sales


def sales_kpis(fct: DataFrame) -> DataFrame:
    done = is_completed()
    revenue = F.when(done, F.col("gross_revenue"))
    return fct.agg(
        F.count("*").alias("total_orders"),
        F.count_if(done).alias("completed_orders"),
        F.coalesce(F.sum(revenue), F.lit(0.0)).alias("total_revenue"),
        F.avg(revenue).alias("avg_order_value"),
        (F.avg(F.col("is_returned").cast("double")) * 100).alias("return_rate_pct"),
    )


def monthly_revenue(fct: DataFrame) -> DataFrame:
    return _per_key(
        completed(fct),
        "order_month",
        F.sum("gross_revenue").alias("revenue"),
        F.count("order_id").alias("orders"),
    ).orderBy("order_month")


def order_status_counts(fct: DataFrame) -> DataFrame:
    return _counts(fct, "order_status", "status")


def _revenue_by(fct: DataFrame, key: str) -> DataFrame:
    return _per_key(completed(fct), key, F.sum("gross_revenue").alias("revenue"))


def top_states_by_revenue(fct: DataFrame, n: int = 15) -> DataFrame:
    by_state = _revenue_by(fct, "customer_state").withColumnRenamed("customer_state", "state")
    return _top(by_state, "revenue", n)


def revenue_by_traffic_source(fct: DataFrame) -> DataFrame:
    return _revenue_by(fct, "traffic_source").withColumnRenamed("traffic_source", "source")


def revenue_by_gender(fct: DataFrame) -> DataFrame:
    return _revenue_by(fct, "gender")


def revenue_by_age_group(fct: DataFrame) -> DataFrame:
    """In age order. Customers of unknown age come last, under a NULL group."""
    return _in_age_order(_revenue_by(fct, "age_group"))


def _in_age_order(groups: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(g) for g in AGE_GROUPS]), F.col("age_group"))
    return groups.orderBy(F.nullif(rank, F.lit(0)).asc_nulls_last()).select(
        F.when(rank > 0, F.col("age_group")).alias("age_group"), "revenue"
    )


# Panels of the sales page and the order column that each groups by.
SALES_PANELS = {
    "monthly_revenue": "order_month",
    "order_status_counts": "order_status",
    "top_states_by_revenue": "customer_state",
    "revenue_by_traffic_source": "traffic_source",
    "revenue_by_gender": "gender",
    "revenue_by_age_group": "age_group",
}


def sales_page(fct: DataFrame) -> DataFrame:
    """The figures of all seven sales tables, from one read of the orders: a row per panel and label.

    ``sales_kpis`` has one row without a label. Orders alike in all six columns are summed first, on
    the map side; grouping sets then see a row per combination and not each order seven times. NULL
    labels are left out, and but for the status panel so are labels without a completed order. Without any order there is no row.
    """
    keys = list(SALES_PANELS.values())
    alike = fct.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count("order_id").alias("ids"),
        F.sum("gross_revenue").alias("gross"),
        F.count("gross_revenue").alias("priced"),
        F.count("is_returned").alias("known"),
        F.count_if("is_returned").alias("returned"),
    )
    done = is_completed()
    sets = [[], *[[F.col(key)] for key in keys]]
    sums = alike.groupingSets(sets, *keys).agg(
        *[F.grouping(key).alias(f"without_{key}") for key in keys],
        F.sum("rows").alias("total_orders"),
        F.coalesce(F.sum(F.when(done, F.col("rows"))), F.lit(0)).alias("completed_orders"),
        F.sum(F.when(done, F.col("ids"))).alias("orders"),
        F.sum(F.when(done, F.col("gross"))).alias("revenue"),
        F.sum(F.when(done, F.col("priced"))).alias("priced"),
        F.sum("known").alias("known"),
        F.sum("returned").alias("returned"),
    )
    panel, label = F.lit("sales_kpis"), F.lit(None).cast("string")
    for name, key in SALES_PANELS.items():
        here = F.col(f"without_{key}") == 0
        panel = F.when(here, F.lit(name)).otherwise(panel)
        label = F.when(here, F.col(key).cast("string")).otherwise(label)
    rows = sums.select(
        panel.alias("panel"), label.alias("label"), "total_orders", "completed_orders", "orders", "revenue",
        ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
        percent(F.col("returned"), F.col("known")).alias("return_rate_pct"),
    )
    of_all, of_status = F.col("panel") == "sales_kpis", F.col("panel") == "order_status_counts"
    return rows.where(of_all | (F.col("label").isNotNull() & (of_status | (F.col("completed_orders") > 0))))


def sales_panels(page: DataFrame, states: int = 15) -> dict[str, DataFrame]:
    """The seven sales tables out of a page, a few hundred rows; store the page first and orders are read once."""

    def of(panel: str, *columns: Column | str) -> DataFrame:
        return page.where(F.col("panel") == panel).select(*columns)

    def by(panel: str, name: str) -> DataFrame:
        return of(panel, F.col("label").alias(name), "revenue")

    whole = of("sales_kpis", "*")
    kpis = whole.agg(
        F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.max("completed_orders"), F.lit(0)).alias("completed_orders"),
        F.coalesce(F.max("revenue"), F.lit(0.0)).alias("total_revenue"),
        F.max("avg_order_value").alias("avg_order_value"),
        F.max("return_rate_pct").alias("return_rate_pct"),
    )
    statuses = of("order_status_counts", F.col("label").alias("status"), F.col("total_orders").alias("count"))
    months = of("monthly_revenue", F.col("label").cast("date").alias("order_month"), "revenue", "orders")
    return {
        "sales_kpis": kpis,
        "monthly_revenue": months.orderBy("order_month"),
        "order_status_counts": statuses.orderBy(F.desc("count"), "status"),
        "top_states_by_revenue": _top(by("top_states_by_revenue", "state"), "revenue", states),
        "revenue_by_traffic_source": by("revenue_by_traffic_source", "source"),
        "revenue_by_gender": by("revenue_by_gender", "gender"),
        "revenue_by_age_group": _in_age_order(by("revenue_by_age_group", "age_group")),
    }


# ------------------------------------------------------------- customers


def customer_kpis(dim: DataFrame) -> DataFrame:
    segment = F.col("rfm_segment")
    return dim.agg(
        F.count("*").alias("total_customers"),
        F.count_if(segment == "Champions").alias("champions"),
        F.count_if(segment == "At Risk").alias("at_risk"),
        F.avg("avg_order_value").alias("avg_order_value"),
    )


def segment_counts(dim: DataFrame) -> DataFrame:
    return _counts(dim, "rfm_segment", "segment")


def segment_revenue(dim: DataFrame) -> DataFrame:
    summed = _per_key(dim, "rfm_segment", F.sum("monetary").alias("revenue"))
    return summed.withColumnRenamed("rfm_segment", "segment").orderBy("revenue", "segment")


def cohort_matrix(cohort: DataFrame, last_month: int = 12) -> DataFrame:
    """Retention per cohort (rows) and months since the first purchase (columns m0, m1, ...)."""
    offsets = list(range(last_month + 1))
    cells = (
        cohort.where(F.col("cohort_month").isNotNull())
        .groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"))
        .pivot("months_since_first", offsets)
        .agg(F.bround(F.avg("retention_pct"), 1))
    )
    return cells.select(
        "cohort_month", *[F.col(f"`{m}`").alias(f"m{m}") for m in offsets]
    ).orderBy("cohort_month")


def customers_by_source(dim: DataFrame) -> DataFrame:
    return _counts(dim, "traffic_source", "source")


def return_rate_by_segment(dim: DataFrame) -> DataFrame:
    return _per_key(
        dim, "rfm_segment", F.avg("return_rate_pct").alias("return_rate_pct")
    ).orderBy("return_rate_pct", "rfm_segment")


# -------------------------------------------------------------- products


def product_kpis(perf: DataFrame) -> DataFrame:
    """Product count, mean margin and return rate, and the best-selling category."""
    per_category = perf.groupBy("category").agg(
        F.count("*").alias("products"),
        *[f(c).alias(f"{c}_{name}") for c in ("margin_pct", "return_rate_pct")
          for name, f in (("sum", F.sum), ("n", F.count))],
        F.sum("total_revenue").alias("revenue"),
    )
    # Largest revenue wins; among equals the first in name order.
    standing = F.when(
        F.col("category").isNotNull(), F.struct(-F.col("revenue"), F.col("category"))
    )
    return per_category.agg(
        F.coalesce(F.sum("products"), F.lit(0)).alias("total_products"),
        ratio(F.sum("margin_pct_sum"), F.sum("margin_pct_n")).alias("avg_margin_pct"),
        ratio(F.sum("return_rate_pct_sum"), F.sum("return_rate_pct_n")).alias("avg_return_rate_pct"),
        F.min_by("category", standing).alias("top_category"),
    )


def _sales_by(perf: DataFrame, key: str) -> DataFrame:
    return _per_key(perf, key, F.sum("total_revenue").alias("total_revenue"))


def category_revenue(perf: DataFrame, n: int = 15) -> DataFrame:
    """The n best categories, smallest first."""
    best = _top(_sales_by(perf, "category"), "total_revenue", n)
    return best.orderBy("total_revenue", F.desc("category"))


def category_margin_vs_price(perf: DataFrame) -> DataFrame:
    return _per_key(
        perf,
        "category",
        F.avg("margin_pct").alias("avg_margin"),
        F.avg("avg_sale_price").alias("avg_price"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_units_sold").alias("total_units"),
    )


def category_margin_reference(perf: DataFrame) -> DataFrame:
    """Mean over categories of their mean margin."""
    margins = _per_key(perf, "category", F.avg("margin_pct").alias("avg_margin"))
    return margins.agg(F.avg("avg_margin").alias("avg_margin"))


# Fixed values.
TOP_PRODUCTS_COLUMNS = (
    "product_name", "category", "brand", "retail_price", "margin_pct", "total_units_sold",
    "total_revenue", "avg_discount_pct", "return_rate_pct",
)


def top_products(perf: DataFrame, n: int = 20) -> DataFrame:
    return (
        perf.orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
        .select(*TOP_PRODUCTS_COLUMNS)
    )


def top_brands(perf: DataFrame, n: int = 10) -> DataFrame:
    return _top(_sales_by(perf, "brand"), "total_revenue", n)


def department_revenue(perf: DataFrame) -> DataFrame:
    return _sales_by(perf, "department")


# ---------------------------------------------------------------- funnel

# The stage labels and the columns behind them.
STAGE_LABELS = (
    ("Sessions", "total_sessions"),
    ("Viewed Product", "viewed_product"),
    ("Added to Cart", "added_to_cart"),
    ("Purchased", "purchased"),
)
DROPOFF_LABELS = (
    ("Browse→Product", "browse_to_product_pct"),
    ("Product→Cart", "product_to_cart_pct"),
    ("Cart→Purchase", "cart_to_purchase_pct"),
)


def all_time(funnel: DataFrame) -> DataFrame:
    """The stage counts over all months, as one row."""
    return funnel.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for _, c in STAGE_LABELS]
    )


def _long(row: DataFrame, labels, key: str, value: str) -> DataFrame:
    """One labelled row per column of a one-row frame, in the given order."""
    pairs = [F.struct(F.lit(label).alias(key), F.col(c).alias(value)) for label, c in labels]
    return row.select(F.inline(F.array(*pairs)))


def funnel_totals(funnel: DataFrame) -> DataFrame:
    cvr = percent(F.col("purchased"), F.col("total_sessions"))
    return all_time(funnel).withColumn("overall_cvr_pct", cvr)


def funnel_stages(funnel: DataFrame) -> DataFrame:
    return _long(all_time(funnel), STAGE_LABELS, "stage", "count")


def funnel_rate_trend(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "event_month", "overall_conversion_pct", "cart_to_purchase_pct", "product_to_cart_pct"
    ).orderBy("event_month")


def sessions_vs_purchases(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "event_month",
        F.col("total_sessions").alias("sessions"),
        F.col("purchased").alias("purchases"),
    ).orderBy("event_month")


def funnel_dropoff(funnel: DataFrame, months: int = 3) -> DataFrame:
    """Mean drop-off of the latest months; a missing rate counts as zero."""
    latest = funnel.orderBy(F.desc("event_month")).limit(months)
    lost = latest.agg(
        *[(100 - F.coalesce(F.sum(c), F.lit(0.0)) / months).alias(c) for _, c in DROPOFF_LABELS]
    )
    return _long(lost, DROPOFF_LABELS, "stage", "dropoff_pct")

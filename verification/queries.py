"""Every operator as a runnable query over the sample tables.

Amounts are rounded on the way out (sums to cents, means and ratios to six places),
because the order in which floats are added differs between engines and runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from basketry.operators import checks, insights, intermediate, kpis, marts, profile
from basketry.operators.ranking import Score, global_ntile
from basketry.operators.staging import STAGING_MODELS
from basketry.plans.build import SOURCES, Build, run_pipeline
from basketry.plans.scratch import new_path
from basketry.schemas import SOURCE_SCHEMAS
from basketry.session import tune
from basketry.sources import readers
from basketry.sources.sample_tables import sample_source
from basketry.sources.warehouse import INTERMEDIATE, MARTS, STAGING

Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple[str, str], str] = {}
_builds: dict[tuple[str, str], Build] = {}


def stored_sources(spark: SparkSession, folder: str) -> str:
    """The sample tables as source tables, stored on first use in an application: a folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stored:
        path = new_path(spark, "sources")
        for name in SOURCE_SCHEMAS:
            sample_source(tune(spark), folder, name).write.parquet(f"{path}/{name}.parquet")
        _stored[key] = path
    return _stored[key]


def built(spark: SparkSession, folder: str) -> Build:
    """The published marts of a sample folder, built on first use in an application.

    As in production, dashboard queries read stored marts and do not rebuild them.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _builds:
        sources = stored_sources(spark, folder)
        # Namespaces of their own for each folder.
        tag = hashlib.sha256(sources.encode()).hexdigest()[:12]
        layers = {layer: f"{layer}_{tag}" for layer in (SOURCES, STAGING, INTERMEDIATE, MARTS)}
        _builds[key] = run_pipeline(spark, sources, new_path(spark, "marts"), check=False, layers=layers)
    return _builds[key]


def settled(df: DataFrame, fine: Iterable[str] = ()) -> DataFrame:
    """Round doubles: two places, or six for the columns named."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)}
    fine = set(fine)
    return df.select(
        *[
            F.round(c, 6 if c in fine else 2).alias(c) if c in doubles else F.col(c)
            for c in df.columns
        ]
    )


def _source(name: str) -> Query:
    return lambda spark, folder: settled(sample_source(tune(spark), folder, name))


def _staged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    model = STAGING_MODELS[name]
    return model(sample_source(tune(spark), folder, model.source))


def _over_staged(build: Callable[..., DataFrame], *names: str, fine: Iterable[str] = ()) -> Query:
    """A query over staging models, computed from the sample tables."""
    return lambda spark, folder: settled(
        build(*[_staged(spark, folder, name) for name in names]), fine
    )


def _over_marts(build: Callable[..., DataFrame], *names: str, fine: Iterable[str] = ()) -> Query:
    """A query over published marts."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        build_result = built(spark, folder)
        return settled(build(*[build_result.mart(name) for name in names]), fine)

    return run


def _table(build: Callable[[DataFrame], DataFrame], table: str, fine: Iterable[str] = ()) -> Query:
    """A query over one raw sample table."""
    return lambda spark, folder: settled(
        build(tune(spark).read.parquet(f"{folder}/{table}.parquet")), fine
    )


# ------------------------------------------------------ sources and sinks


def declared_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Declared-only tables, derived here from line items and suppliers."""
    stored = new_path(spark, "declared")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines.select("l_suppkey", "l_partkey").distinct().write.parquet(f"{stored}/inventory_items.parquet")
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    suppliers.write.parquet(f"{stored}/distribution_centers.parquet")
    names = readers.register_declared(spark, stored)
    counts = [
        spark.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in names
    ]
    return counts[0].unionByName(counts[1])


def _users_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Users written to CSV with missing ages spelled NA and addresses over two lines, then scanned back."""
    path = new_path(spark, "users-csv")
    address = F.concat(F.lit('c/o "'), "last_name", F.lit('",\n'), "city")
    users = sample_source(tune(spark), folder, "users").select(
        "id", "email", "age", "city", "latitude", (F.col("gender") == "M").alias("is_male"), address.alias("address")
    )
    users.write.options(header=True, nullValue="NA", escape='"').csv(path)
    return readers.read_csv(spark, path)


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    return settled(_users_csv(spark, folder))


def csv_column_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_kinds(_users_csv(spark, folder))


def published_view(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the staging view, as another session of the catalog reads it."""
    view = f"{built(spark, folder).warehouse.namespace(STAGING)}.stg_orders"
    return spark.newSession().sql(
        f"SELECT order_month, count(*) AS n_orders, count(returned_at) AS n_returned "
        f"FROM {view} GROUP BY order_month"
    )


def enriched_view(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched orders as a view over what is published."""
    return settled(built(spark, folder).views["int_orders_enriched"])


def published_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every published mart."""
    names = (
        "fct_orders", "dim_customers", "mart_product_performance", "mart_cohort_retention",
        "mart_funnel",
    )
    first, *rest = [
        built(spark, folder).mart(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"))
        for n in names
    ]
    for counts in rest:
        first = first.unionByName(counts)
    return first


def read_mart(spark: SparkSession, folder: str) -> DataFrame:
    return settled(built(spark, folder).mart("fct_orders"))


def marts_ready(spark: SparkSession, folder: str) -> DataFrame:
    return built(spark, folder).warehouse.marts_ready()


# ------------------------------------------------------------ the models


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    names = ("stg_orders", "stg_order_items", "stg_users", "stg_products")
    return intermediate.int_orders_enriched(*[_staged(spark, folder, n) for n in names])


def int_orders_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return settled(enriched(spark, folder))


def fct_orders(spark: SparkSession, folder: str) -> DataFrame:
    return settled(marts.fct_orders(enriched(spark, folder)))


def dim_customers(fct: DataFrame) -> DataFrame:
    return marts.dim_customers(intermediate.int_customer_stats(fct))


def customer_stats_by_counting(spark: SparkSession, folder: str) -> DataFrame:
    """Customer statistics from the sample tables, without any published mart."""
    return settled(intermediate.int_customer_stats(enriched(spark, folder)), fine=["avg_order_value"])


def mart_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return settled(
        marts.mart_product_performance(
            _staged(spark, folder, "stg_order_items"),
            _staged(spark, folder, "stg_products"),
            built(spark, folder).mart("fct_orders"),
        ),
        fine=["avg_sale_price"],
    )


def global_ntile_orders(orders: DataFrame) -> DataFrame:
    """Tiles over every order by counting: a spread-out key, a heavily tied key, a sparse key."""
    keyed = orders.select(
        "o_orderkey", "o_totalprice", F.col("o_orderkey").cast("string").alias("tie"),
        F.month("o_orderdate").alias("month"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("custkey_if_done"),
    )
    ranked = global_ntile(
        keyed,
        [
            Score("price_tile", F.col("o_totalprice")),
            Score("month_tile", -F.col("month")),
            Score("sparse_tile", F.col("custkey_if_done")),
            Score("sparse_last_tile", F.col("custkey_if_done"), nulls_last=True),
        ],
        tie="tie",
        tiles=7,
    )
    return ranked.select("o_orderkey", "price_tile", "month_tile", "sparse_tile", "sparse_last_tile")


# ---------------------------------------------------------------- checks


def run_checks(spark: SparkSession, folder: str) -> DataFrame:
    return built(spark, folder).run_checks()


def _checks_of(kind: str, group: tuple) -> Query:
    chosen = [c for c in group if c.kind == kind]
    return lambda spark, folder: checks.run_checks(built(spark, folder).checked_tables(), chosen)


# --------------------------------------------------------------- profile

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
POINT = ["order_id", "order_value_tier", "gross_revenue"]


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return sample_source(tune(spark), folder, "users")


def all_queries() -> dict[str, Query]:
    fct, dim, perf = "fct_orders", "dim_customers", "mart_product_performance"
    cohort, funnel = "mart_cohort_retention", "mart_funnel"
    return {
        # sources and sinks
        **{f"source_{name}": _source(name) for name in SOURCE_SCHEMAS},
        "declared_sources": declared_sources,
        "csv_scan": csv_scan,
        "published_view": published_view,
        "enriched_view": enriched_view,
        "published_tables": published_tables,
        "read_mart": read_mart,
        "marts_ready": marts_ready,
        # staging
        **{name: _over_staged(lambda df: df, name) for name in STAGING_MODELS},
        # intermediate
        "item_rollup": _over_staged(intermediate.item_rollup, "stg_order_items"),
        "cost_rollup": _over_staged(
            intermediate.cost_rollup, "stg_order_items", "stg_products",
            fine=["avg_item_cost", "avg_retail_price"],
        ),
        "order_totals": _over_staged(
            intermediate.order_totals, "stg_order_items", "stg_products"
        ),
        "int_orders_enriched": int_orders_enriched,
        "customer_measures": _over_marts(
            intermediate.customer_measures, fct, fine=["avg_order_value"]
        ),
        "int_customer_stats": _over_marts(
            intermediate.int_customer_stats, fct, fine=["avg_order_value"]
        ),
        "customer_stats_by_counting": customer_stats_by_counting,
        "global_ntile": _table(global_ntile_orders, "orders"),
        "session_rollup": _over_staged(intermediate.session_rollup, "stg_events"),
        "int_funnel": _over_staged(intermediate.int_funnel, "stg_events"),
        # marts
        "fct_orders": fct_orders,
        "dim_customers": _over_marts(dim_customers, fct, fine=["avg_order_value"]),
        "mart_product_performance": mart_product_performance,
        "first_purchase_months": _over_marts(marts.first_purchase_months, fct),
        "cohort_activity": _over_marts(marts.cohort_activity, fct),
        "mart_cohort_retention": _over_marts(marts.mart_cohort_retention, fct),
        "mart_funnel": _over_staged(
            lambda events: marts.mart_funnel(intermediate.int_funnel(events)), "stg_events"
        ),
        # dashboard: sales
        "sales_kpis": _over_marts(
            kpis.sales_kpis, fct, fine=["avg_order_value", "return_rate_pct"]
        ),
        "monthly_revenue": _over_marts(kpis.monthly_revenue, fct),
        "order_status_counts": _over_marts(kpis.order_status_counts, fct),
        "sales_page": _over_marts(kpis.sales_page, fct, fine=["avg_order_value", "return_rate_pct"]),
        "top_states_by_revenue": _over_marts(kpis.top_states_by_revenue, fct),
        "revenue_by_traffic_source": _over_marts(kpis.revenue_by_traffic_source, fct),
        "revenue_by_gender": _over_marts(kpis.revenue_by_gender, fct),
        "revenue_by_age_group": _over_marts(kpis.revenue_by_age_group, fct),
        # dashboard: customers
        "customer_kpis": _over_marts(kpis.customer_kpis, dim, fine=["avg_order_value"]),
        "segment_counts": _over_marts(kpis.segment_counts, dim),
        "segment_revenue": _over_marts(kpis.segment_revenue, dim),
        "cohort_matrix": _over_marts(kpis.cohort_matrix, cohort),
        "customers_by_source": _over_marts(kpis.customers_by_source, dim),
        "return_rate_by_segment": _over_marts(
            kpis.return_rate_by_segment, dim, fine=["return_rate_pct"]
        ),
        # dashboard: products
        "product_kpis": _over_marts(
            kpis.product_kpis, perf, fine=["avg_margin_pct", "avg_return_rate_pct"]
        ),
        "category_revenue": _over_marts(kpis.category_revenue, perf),
        "category_margin_vs_price": _over_marts(
            kpis.category_margin_vs_price, perf, fine=["avg_margin", "avg_price"]
        ),
        "category_margin_reference": _over_marts(
            kpis.category_margin_reference, perf, fine=["avg_margin"]
        ),
        "top_products": _over_marts(kpis.top_products, perf),
        "top_brands": _over_marts(kpis.top_brands, perf),
        "department_revenue": _over_marts(kpis.department_revenue, perf),
        # dashboard: funnel
        "funnel_totals": _over_marts(kpis.funnel_totals, funnel, fine=["overall_cvr_pct"]),
        "funnel_stages": _over_marts(kpis.funnel_stages, funnel),
        "funnel_rate_trend": _over_marts(kpis.funnel_rate_trend, funnel),
        "sessions_vs_purchases": _over_marts(kpis.sessions_vs_purchases, funnel),
        "funnel_dropoff": _over_marts(kpis.funnel_dropoff, funnel, fine=["dropoff_pct"]),
        # insights
        "executive_metrics": _over_marts(insights.executive_metrics, fct, dim),
        "recent_months": _over_marts(insights.recent_months, fct),
        "segment_distribution": _over_marts(insights.segment_distribution, dim),
        "top_states": _over_marts(insights.top_states, fct),
        "revenue_anomalies": _over_marts(
            insights.revenue_anomalies, fct, fine=["revenue_mom_pct"]
        ),
        "flagged_months": _over_marts(insights.flagged_months, fct, fine=["revenue_mom_pct"]),
        "segment_profile": _over_marts(insights.segment_profile, dim),
        "funnel_step_rates": _over_marts(
            insights.funnel_step_rates, funnel,
            fine=["viewed_pct", "cart_pct", "purchase_pct", "overall_cvr_pct"],
        ),
        # profile
        "preview": _over_marts(lambda df: profile.preview(df, 10, ["order_id"]), fct),
        "shape": lambda spark, folder: profile.shape(_users(spark, folder)),
        "missing_by_column": lambda spark, folder: profile.missing_by_column(
            sample_source(tune(spark), folder, "orders")
        ),
        "column_kinds": lambda spark, folder: profile.column_kinds(_users(spark, folder)),
        "csv_column_kinds": csv_column_kinds,
        "describe": _table(lambda df: profile.describe(df, LINE_NUMBERS), "lineitem"),
        "describe_text": lambda spark, folder: profile.describe_text(_users(spark, folder)),
        "describe_by_counting": _table(profile.describe, "lineitem"),
        "bar_series": _over_marts(
            lambda df: profile.bar_series(df, "order_value_tier", "gross_revenue"), fct
        ),
        "xy_series": lambda spark, folder: settled(
            profile.xy_series(
                sample_source(tune(spark), folder, "products"), "cost", "retail_price", line=True
            )
        ),
        "histogram": _table(
            lambda df: profile.histogram(df, "l_extendedprice", 20), "lineitem"
        ),
        "histogram_bins": _over_marts(lambda df: profile.histogram(df, "gross_revenue"), fct),
        "column_anomalies": _over_marts(
            lambda df: profile.column_anomalies(df.select(*POINT), "gross_revenue"), fct
        ),
        "anomaly_summary": _over_marts(
            lambda df: profile.anomaly_summary(df, "gross_revenue"), fct,
            fine=["mean", "std", "anomaly_pct"],
        ),
        "anomaly_sample": _over_marts(
            lambda df: profile.anomaly_sample(
                df.select(*POINT), "gross_revenue", 10, [F.desc("gross_revenue"), "order_id"]
            ),
            fct,
        ),
        # checks
        "check_not_null_sources": _checks_of(checks.NOT_NULL, checks.SOURCE_CHECKS),
        "check_not_null_models": _checks_of(checks.NOT_NULL, checks.MODEL_CHECKS),
        "check_unique": _checks_of(checks.UNIQUE, checks.MODEL_CHECKS),
        "check_accepted_values": _checks_of(checks.ACCEPTED, checks.MODEL_CHECKS),
        "run_checks": run_checks,
    }

"""Dashboard and insight tables on small frames, against pandas where it defines the result."""

from __future__ import annotations

from datetime import date

import pandas as pd
import pytest

from basketry.operators import insights, kpis
from tests.conftest import rows_by

FCT = (
    "order_id string, order_status string, order_month date, customer_state string, "
    "traffic_source string, gender string, age_group string, gross_revenue double, "
    "is_returned boolean"
)


@pytest.fixture(scope="module")
def fct(spark):
    jan, feb = date(2023, 1, 1), date(2023, 2, 1)
    return spark.createDataFrame([
        ("1", "Complete", jan, "Ohio", "Search", "F", "18-24", 10.0, False),
        ("2", "complete", jan, "Iowa", "Email", "M", "55+", 20.0, True),
        ("3", "COMPLETE", feb, None, None, None, None, 40.0, False),
        ("4", "Shipped", feb, "Ohio", "Search", "F", "18-24", 999.0, False),
        ("5", "Complete", None, "Ohio", "Search", "F", "Unknown", 5.0, True),
        ("6", None, feb, "Ohio", "Search", "F", "Under 18", 1.0, False),
    ], FCT)


def test_sales_kpis(fct):
    row = kpis.sales_kpis(fct).first()
    assert (row.total_orders, row.completed_orders, row.total_revenue) == (6, 4, 75.0)
    assert row.avg_order_value == 18.75
    assert row.return_rate_pct == pytest.approx(100 * 2 / 6)


@pytest.mark.parametrize("rows", ["true", "false", "order_status IS NULL", "order_id <> '2'"])
def test_the_sales_page_has_all_seven_tables(fct, rows):
    orders = fct.where(rows)
    panels = kpis.sales_panels(kpis.sales_page(orders))
    assert list(panels) == ["sales_kpis", *kpis.SALES_PANELS]
    for name, table in panels.items():
        alone = getattr(kpis, name)(orders)
        assert table.columns == alone.columns
        expected = alone.collect()
        if name not in ("revenue_by_traffic_source", "revenue_by_gender"):
            assert table.collect() == expected, name
        else:
            assert sorted(table.collect()) == sorted(expected), name


def test_the_sales_page_reads_the_orders_once(spark, fct, tmp_path):
    fct.write.parquet(f"{tmp_path}/fct")
    page = kpis.sales_page(spark.read.parquet(f"{tmp_path}/fct"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    # Orders are summed before the grouping sets multiply them.
    assert plan.index("Expand") < plan.index("HashAggregate(keys=[order_month", plan.index("Expand")) < plan.index("FileScan")


def test_kpis_of_nothing(fct):
    row = kpis.sales_kpis(fct.where("false")).first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value) == (0, 0.0, None)


def test_null_keys_are_left_out(fct):
    assert rows_by(kpis.monthly_revenue(fct), "order_month") == {
        date(2023, 1, 1): {"order_month": date(2023, 1, 1), "revenue": 30.0, "orders": 2},
        date(2023, 2, 1): {"order_month": date(2023, 2, 1), "revenue": 40.0, "orders": 1},
    }
    assert [tuple(r) for r in kpis.order_status_counts(fct).collect()] == [
        ("Complete", 2), ("COMPLETE", 1), ("Shipped", 1), ("complete", 1)
    ]
    assert [tuple(r) for r in kpis.top_states_by_revenue(fct).collect()] == [
        ("Iowa", 20.0), ("Ohio", 15.0)
    ]
    assert [tuple(r) for r in kpis.top_states_by_revenue(fct, 1).collect()] == [("Iowa", 20.0)]
    assert set(rows_by(kpis.revenue_by_traffic_source(fct), "source")) == {"Search", "Email"}
    assert set(rows_by(kpis.revenue_by_gender(fct), "gender")) == {"F", "M"}


def test_age_groups_in_order_with_unknown_last(fct):
    assert [tuple(r) for r in kpis.revenue_by_age_group(fct).collect()] == [
        ("18-24", 10.0), ("55+", 20.0), (None, 5.0)
    ]


def test_segments(spark):
    dim = spark.createDataFrame(
        [("a", "Champions", 30.0, 10.0, "Search", 0.0, 3, 2),
         ("b", "Champions", 10.0, 5.0, None, 50.0, 1, 4),
         ("c", "At Risk", 99.0, 3.0, "Email", 10.0, 5, 9),
         ("d", None, 1.0, 2.0, "Email", 20.0, 1, 1)],
        "user_id string, rfm_segment string, monetary double, avg_order_value double, "
        "traffic_source string, return_rate_pct double, frequency long, recency_days long",
    )
    assert tuple(kpis.customer_kpis(dim).first()) == (4, 2, 1, 5.0)
    assert [tuple(r) for r in kpis.segment_counts(dim).collect()] == [("Champions", 2), ("At Risk", 1)]
    assert [tuple(r) for r in kpis.segment_revenue(dim).collect()] == [
        ("Champions", 40.0), ("At Risk", 99.0)
    ]
    assert [tuple(r) for r in kpis.customers_by_source(dim).collect()] == [("Email", 2), ("Search", 1)]
    assert [tuple(r) for r in kpis.return_rate_by_segment(dim).collect()] == [
        ("At Risk", 10.0), ("Champions", 25.0)
    ]
    # Unlike the dashboard tables this one keeps the NULL segment.
    assert [tuple(r) for r in insights.segment_profile(dim).collect()] == [
        ("At Risk", 1, 99.0, 9.0, 5.0), ("Champions", 2, 20.0, 3.0, 2.0), (None, 1, 1.0, 1.0, 1.0)
    ]


def test_cohort_matrix_rounds_half_even(spark):
    jan = date(2023, 1, 1)
    cohort = spark.createDataFrame(
        [(jan, 0, 100.0), (jan, 1, 12.25), (jan, 2, 12.35), (jan, 13, 50.0), (jan, None, 1.0)],
        "cohort_month date, months_since_first long, retention_pct double",
    )
    (row,) = kpis.cohort_matrix(cohort).collect()
    assert (row.cohort_month, row.m0, row.m1, row.m2, row.m3) == ("2023-01", 100.0, 12.2, 12.4, None)
    assert "m12" in row and "m13" not in row
    frame = pd.DataFrame({"v": [100.0, 12.25, 12.35]}).round(1)
    assert frame.v.tolist() == [row.m0, row.m1, row.m2]


PERF = (
    "product_id string, product_name string, category string, brand string, department string, "
    "retail_price double, margin_pct double, total_units_sold long, total_revenue double, "
    "avg_sale_price double, avg_discount_pct double, return_rate_pct double"
)


def test_products(spark):
    perf = spark.createDataFrame([
        ("1", "hat", "Hats", "A", "Men", 10.0, 50.0, 5, 100.0, 8.0, 20.0, 0.0),
        ("2", "cap", "Hats", "B", "Men", 12.0, None, 1, 50.0, 6.0, 25.0, 10.0),
        ("3", "boot", "Boots", "A", "Women", 99.0, 80.0, 2, 150.0, 75.0, 24.0, 20.0),
        ("4", "sock", None, None, None, 1.0, 20.0, 9, 150.0, 1.0, 0.0, 30.0),
    ], PERF)
    row = kpis.product_kpis(perf).first()
    assert row.total_products == 4 and row.avg_margin_pct == 50.0 and row.avg_return_rate_pct == 15.0
    assert row.top_category == "Boots"  # equal revenue: first by name
    assert [tuple(r) for r in kpis.category_revenue(perf).collect()] == [
        ("Hats", 150.0), ("Boots", 150.0)
    ]
    margins = rows_by(kpis.category_margin_vs_price(perf), "category")
    assert margins["Hats"] == {
        "category": "Hats", "avg_margin": 50.0, "avg_price": 7.0, "total_revenue": 150.0,
        "total_units": 6,
    }
    assert kpis.category_margin_reference(perf).first().avg_margin == 65.0
    top = kpis.top_products(perf, 2)
    assert len(top.columns) == 9 and [r.product_name for r in top.collect()] == ["boot", "sock"]
    assert [tuple(r) for r in kpis.top_brands(perf, 1).collect()] == [("A", 250.0)]
    assert rows_by(kpis.department_revenue(perf), "department")["Men"]["total_revenue"] == 150.0


FUNNEL = (
    "event_month date, total_sessions long, viewed_product long, added_to_cart long, "
    "purchased long, browse_to_product_pct double, product_to_cart_pct double, "
    "cart_to_purchase_pct double, overall_conversion_pct double"
)


def test_funnel(spark):
    months = [
        (date(2023, m, 1), 10 * m, 5, 2, 1, 50.0, 40.0, None if m == 4 else 30.0, 1.0)
        for m in (1, 2, 3, 4)
    ]
    funnel = spark.createDataFrame(months, FUNNEL)
    assert tuple(kpis.funnel_totals(funnel).first()) == (100, 20, 8, 4, 4.0)
    assert [tuple(r) for r in kpis.funnel_stages(funnel).collect()] == [
        ("Sessions", 100), ("Viewed Product", 20), ("Added to Cart", 8), ("Purchased", 4)
    ]
    assert [r.event_month.month for r in kpis.funnel_rate_trend(funnel).collect()] == [1, 2, 3, 4]
    assert kpis.sessions_vs_purchases(funnel).columns == ["event_month", "sessions", "purchases"]
    # Latest three months; the missing rate counts as zero and the divisor stays three.
    assert [tuple(r) for r in kpis.funnel_dropoff(funnel).collect()] == [
        ("Browse→Product", 50.0), ("Product→Cart", 60.0), ("Cart→Purchase", 80.0)
    ]
    single = kpis.funnel_dropoff(funnel.limit(1)).first().dropoff_pct
    assert single == pytest.approx(100 - 50 / 3)
    steps = insights.funnel_step_rates(funnel).first()
    assert (steps.viewed_pct, steps.cart_pct, steps.purchase_pct) == (20.0, 40.0, 50.0)
    nothing = kpis.funnel_totals(funnel.where("false")).first()
    assert (nothing.total_sessions, nothing.overall_cvr_pct) == (0, None)


def revenue_frame(spark, revenues):
    return spark.createDataFrame(
        [(str(i), "Complete", date(2022 + i // 12, i % 12 + 1, 1), "Ohio", "S", "F", "55+", r, False)
         for i, r in enumerate(revenues)],
        FCT,
    )


@pytest.mark.parametrize("revenues", [
    [100.0, 110.0, 105.0, 500.0, 480.0, 490.0, 470.0, 465.0, 460.0, 455.0],
    [100.0],
    [100.0, 50.0],
    [float(100 + i % 5) for i in range(24)],
])
def test_revenue_anomalies_match_pandas(spark, revenues):
    got = insights.revenue_anomalies(revenue_frame(spark, revenues)).collect()
    expected = pd.Series(revenues).pct_change() * 100
    flags = expected.abs() > expected.mean() + 2 * expected.std()
    assert [r.is_anomaly for r in got] == flags.tolist()
    for row, change in zip(got, expected):
        assert row.revenue_mom_pct == (None if pd.isna(change) else pytest.approx(change))
    flagged = insights.flagged_months(revenue_frame(spark, revenues))
    assert flagged.count() == int(flags.sum()) and "is_anomaly" not in flagged.columns


def test_change_after_a_month_without_revenue_is_unknown(spark):
    got = insights.revenue_anomalies(revenue_frame(spark, [10.0, 0.0, 10.0])).collect()
    assert [r.revenue_mom_pct for r in got] == [None, -100.0, None]


def test_recent_months_and_executive_metrics(spark, fct):
    frame = revenue_frame(spark, [float(i) for i in range(1, 10)])
    assert [r.revenue for r in insights.recent_months(frame, 3).collect()] == [7.0, 8.0, 9.0]
    metrics = rows_by(insights.executive_metrics(fct, spark.range(3)), "metric")
    assert metrics["total_customers"]["value"] == 3.0
    assert metrics["total_revenue"]["value"] == 75.0 and len(metrics) == 6
    assert [r.state for r in insights.top_states(fct, 1).collect()] == ["Iowa"]

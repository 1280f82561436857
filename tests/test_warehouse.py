"""Versioned tables, persistent views, the layout of the orders mart, and builds that fail and resume."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from basketry.operators import checks, intermediate, marts
from basketry.plans import build as plan
from basketry.plans.build import FailedBuild, FailedChecks, Mart, run_pipeline
from basketry.plans.scratch import scratch_dir
from basketry.schemas import SOURCE_SCHEMAS
from basketry.sources import files
from basketry.sources.sample_tables import sample_source
from basketry.sources.warehouse import Layout, Warehouse
from tests.conftest import SMALL
from tests.test_build import named
from tests.test_plans import plan_of


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored-sources")
    for name in SOURCE_SCHEMAS:
        sample_source(spark, SMALL, name).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), named(f"w{time.time_ns()}"))


def numbers(spark, n: int):
    return spark.range(n).select(F.col("id").alias("n"), (F.col("id") % 3).alias("part"))


def versions(spark, warehouse, name: str) -> list[str]:
    return [n for n in files.names_in(spark, warehouse._folder("marts", name)) if n.startswith("v")]


# ------------------------------------------------------------ full refresh


def test_a_reader_keeps_its_version_during_a_rebuild(spark, warehouse):
    warehouse.publish_table(numbers(spark, 10), "marts", "t")
    reader = warehouse.read_table("marts", "t")
    begun, go = threading.Event(), threading.Event()
    listed = warehouse._commit

    def slow(*args):
        begun.set()
        go.wait(60)
        listed(*args)

    warehouse._commit = slow
    writer = threading.Thread(target=warehouse.publish_table, args=(numbers(spark, 20), "marts", "t"))
    writer.start()
    assert begun.wait(60)
    # All files of the new version are there; nobody sees them.
    assert len(versions(spark, warehouse, "t")) == 2
    assert warehouse.read_table("marts", "t").count() == reader.count() == 10
    go.set()
    writer.join()
    assert warehouse.read_table("marts", "t").count() == 20 and reader.count() == 10


def test_a_killed_write_changes_nothing(spark, warehouse):
    warehouse.publish_table(numbers(spark, 10), "marts", "t")
    broken = numbers(spark, 1000).withColumn("n", F.when(F.col("n") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        warehouse.publish_table(broken, "marts", "t")
    view = spark.table(warehouse.attach("marts", "t"))
    assert warehouse.read_table("marts", "t").count() == view.count() == 10
    left = warehouse.vacuum("marts", "t")
    assert len(left) <= 1 and len(versions(spark, warehouse, "t")) == 1
    assert warehouse.vacuum("marts", "t") == [] and warehouse.read_table("marts", "t").count() == 10


def test_the_version_before_stays_and_older_ones_go(spark, warehouse):
    for n in (1, 2, 3, 4):
        warehouse.publish_table(numbers(spark, n), "marts", "t")
    assert len(versions(spark, warehouse, "t")) == 2
    assert warehouse.read_table("marts", "t").count() == 4
    tables = [t.name for t in spark.catalog.listTables(warehouse.namespace("marts"))]
    assert len([t for t in tables if t.startswith("t__")]) == 2


def test_a_refresh_may_change_the_columns(spark, warehouse):
    warehouse.publish_table(numbers(spark, 3), "marts", "t")
    warehouse.publish_table(spark.createDataFrame([(1, "x")], "a int, `odd name` string"), "marts", "t")
    assert warehouse.read_table("marts", "t").columns == spark.table(warehouse.attach("marts", "t")).columns == ["a", "odd name"]


@pytest.mark.parametrize("layout", [Layout(), Layout("part"), Layout("part", "n", 3), Layout(None, "n", 3)])
def test_another_catalog_sees_the_same_table(spark, warehouse, layout):
    rows = numbers(spark, 300).withColumn("part", F.when(F.col("n") > 20, F.col("part")))
    warehouse.publish_table(rows, "marts", "t", layout)
    expected = sorted(map(tuple, rows.collect()), key=repr)
    # What this catalog knows goes; the folder stays.
    space = warehouse.namespace("marts")
    for table in spark.catalog.listTables(space):
        spark.sql(f"DROP {'VIEW' if table.tableType == 'VIEW' else 'TABLE'} `{space}`.`{table.name}`")
    other = Warehouse(spark.newSession(), warehouse.root, warehouse.layers)
    read = other.read_table("marts", "t")
    assert read.columns == ["n", "part"] and sorted(map(tuple, read.collect()), key=repr) == expected
    assert sorted(map(tuple, spark.table(other.attach("marts", "t")).collect()), key=repr) == expected


def test_readiness_is_counted_in_footers(spark, warehouse):
    assert warehouse.marts_ready().collect()[0].ready is False
    warehouse.publish_table(numbers(spark, 50), "marts", "fct_orders", Layout("part", "n", 2))
    ready = warehouse.marts_ready()
    assert ready.collect()[0].ready is True and ready.columns == ["ready"]
    assert "PushedAggregation: [COUNT(*)]" in plan_of(ready)
    assert warehouse.mart_rows("fct_orders").first().n_rows == 50
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_missing_tables_say_so(warehouse):
    with pytest.raises(LookupError, match="marts.nothing"):
        warehouse.read_table("marts", "nothing")
    assert warehouse.written_by("marts", "nothing") is None


# ------------------------------------------------------------ the build


def test_views_outlive_the_session(spark, sources, tmp_path):
    made = run_pipeline(spark, sources, str(tmp_path), layers={**named("views"), "staging": " views_clean "})
    other = spark.newSession()
    orders = other.table("views_clean.stg_orders")
    assert orders.schema == made.views["stg_orders"].schema
    for name, df in made.views.items():
        if name.startswith("stg_"):
            assert sorted(map(repr, other.table(f"views_clean.{name}").collect())) == sorted(map(repr, df.collect()))
    enriched = intermediate.int_orders_enriched(*[made.views[n] for n in ("stg_orders", "stg_order_items", "stg_users", "stg_products")])
    view = other.table("views_intermediate.int_orders_enriched")
    assert set(view.columns) == set(enriched.columns) and view.count() == enriched.count()
    assert view.where("returned_at IS NOT NULL").count() == enriched.where("returned_at IS NOT NULL").count() > 0
    assert other.table("views_intermediate.int_customer_stats").count() == made.mart("dim_customers").count()
    assert other.table("views_intermediate.int_funnel").count() == made.mart("mart_funnel").count()
    assert other.table("views_marts.fct_orders").columns == list(marts.FCT_ORDERS_COLUMNS)


def test_scratch_of_a_build_is_freed(spark, sources, tmp_path):
    folder = scratch_dir(spark)
    before = set(files.names_in(spark, folder))
    made = run_pipeline(spark, sources, str(tmp_path), layers=named("freed"))
    assert set(files.names_in(spark, folder)) == before
    assert made.views["int_customer_stats"].count() == made.mart("dim_customers").count()


def test_customers_need_no_shuffle_and_months_are_pruned(spark, sources, tmp_path):
    fct = run_pipeline(spark, sources, str(tmp_path), check=False, layers=named("layout")).mart("fct_orders")
    for df in (intermediate.customer_measures(fct), marts.first_purchase_months(fct)):
        assert "Exchange" not in plan_of(df) and "Bucketed: true" in plan_of(df)
    cohorts = plan_of(marts.cohort_activity(fct))
    assert "hashpartitioning(user_id" not in cohorts and "Bucketed: true" in cohorts
    month = fct.agg(F.max("order_month")).first()[0]
    one = fct.where(F.col("order_month") == month)
    pruned = plan_of(one)
    assert "PartitionFilters: [isnotnull(order_month" in pruned
    assert all(f"order_month={month}" in path for path in one.inputFiles()) and one.count() > 0


def test_a_hot_user_is_not_read_by_one_task(spark, warehouse):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.expr("add_months(DATE'2024-01-01', int(id % 4))").alias("order_month"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    warehouse.publish_table(rows, "marts", "hot", Layout("order_month", "user_id", 8))
    hot = warehouse.read_table("marts", "hot")
    assert "Bucketed: true" not in plan_of(hot.groupBy("user_id").count()) and hot.count() == 30_000
    even = rows.withColumn("user_id", F.col("filler"))
    warehouse.publish_table(even, "marts", "hot", Layout("order_month", "user_id", 8))
    assert "Bucketed: true" in plan_of(warehouse.read_table("marts", "hot").groupBy("user_id").count())


def test_row_checks_cost_no_scan(spark, sources, tmp_path, monkeypatch):
    scanned = []
    run_all = checks.run_checks
    monkeypatch.setattr(checks, "run_checks", lambda tables, chosen=checks.ALL_CHECKS: scanned.extend(chosen) or run_all(tables, chosen))
    made = run_pipeline(spark, sources, str(tmp_path), layers=named("observed"))
    assert {c.kind for c in scanned} == {checks.UNIQUE} and len(scanned) == 7
    assert made.observed["orders"]["rows"] == made.sources["orders"].count()
    assert made.observed["dim_customers"]["rows"] == made.mart("dim_customers").count()
    assert set(made.observed) == {c.table for c in checks.ALL_CHECKS}


def test_observed_failures_fail_the_build(spark, sources, tmp_path):
    frames = {n: spark.read.schema(s).parquet(f"{sources}/{n}.parquet") for n, s in SOURCE_SCHEMAS.items()}
    odd = F.when(F.col("order_id") % 100 == 0, F.lit("Lost")).otherwise(F.col("status"))
    frames["orders"] = frames["orders"].withColumn("status", odd)
    frames["events"] = frames["events"].withColumn("id", F.nullif("id", F.lit(1)))
    with pytest.raises(FailedChecks) as failed:
        run_pipeline(spark, frames, str(tmp_path), layers=named("odd"))
    lost = frames["orders"].where("order_id IS NOT NULL AND status = 'Lost'").count()
    assert f"('accepted_values', 'stg_orders', 'order_status', {lost})" in str(failed.value)
    assert ("('not_null', 'events', 'id', 1)" in str(failed.value)) == (frames["events"].where("id IS NULL").count() == 1)


def test_a_failing_mart_stops_its_siblings_and_the_rerun_resumes(spark, sources, tmp_path, monkeypatch):
    begun = threading.Event()

    def endless(given):
        begun.set()
        # Minutes of work, unless its job is cancelled.
        slow = F.pandas_udf(lambda x: time.sleep(200) or x, "long")
        return given.warehouse.read_mart("fct_orders").select(slow(F.lit(1).cast("long")).alias("n"))

    def broken(given):
        begun.wait(60)
        time.sleep(1)
        raise ValueError("no such table")

    whole = dict(plan.GRAPH)
    monkeypatch.setitem(plan.GRAPH, "mart_cohort_retention", Mart(endless, needs=("fct_orders",)))
    monkeypatch.setitem(plan.GRAPH, "mart_product_performance", Mart(broken, needs=("fct_orders", "mart_funnel")))
    monkeypatch.setitem(plan.GRAPH, "dim_customers", Mart(whole["dim_customers"].make, needs=("mart_product_performance",)))
    begin = time.perf_counter()
    with pytest.raises(FailedBuild) as failed:
        run_pipeline(spark, sources, str(tmp_path), layers=named("resumed"), run="nightly")
    assert time.perf_counter() - begin < 120
    assert failed.value.mart == "mart_product_performance" and isinstance(failed.value.__cause__, ValueError)
    assert failed.value.left == ["dim_customers", "mart_cohort_retention", "mart_product_performance"]
    monkeypatch.undo()
    first = Warehouse(spark, str(tmp_path), named("resumed"))
    kept = first._current("marts", "fct_orders").version
    made = run_pipeline(spark, sources, str(tmp_path), layers=named("resumed"), run=failed.value.run)
    assert sorted(made.built) == failed.value.left
    assert first._current("marts", "fct_orders").version == kept
    assert run_pipeline(spark, sources, str(tmp_path), layers=named("resumed"), run="nightly").built == ()
    assert len(run_pipeline(spark, sources, str(tmp_path), layers=named("resumed")).built) == 5

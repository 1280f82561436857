"""The batch build: staging views, mart tables in the order of what they need, then the checks."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from basketry.operators import checks, intermediate, marts
from basketry.operators.staging import STAGING_MODELS
from basketry.plans.scratch import Scratch
from basketry.schemas import SOURCE_SCHEMAS
from basketry.session import tune
from basketry.sources.readers import read_source
from basketry.sources.warehouse import INTERMEDIATE, MARTS, STAGING, Layout, Warehouse, publish_view

SOURCES = "sources"


class FailedChecks(Exception):
    """Data checks with failures, after a build."""


class FailedBuild(Exception):
    """A mart could not be built. The same ``run`` given to the next build resumes this one."""

    def __init__(self, mart: str, run: str, left: Iterable[str]):
        self.mart, self.run, self.left = mart, run, sorted(left)
        super().__init__(f"{mart} failed in run {run}; not built: {', '.join(self.left)}")


@dataclass
class Build:
    """Everything one run produced."""

    sources: dict[str, DataFrame]
    views: dict[str, DataFrame]
    warehouse: Warehouse
    run: str
    built: tuple[str, ...] = ()
    observed: dict[str, dict[str, int]] = field(default_factory=dict)

    def mart(self, name: str) -> DataFrame:
        return self.warehouse.read_mart(name)

    def checked_tables(self) -> dict[str, DataFrame]:
        names = {c.table for c in checks.ALL_CHECKS} - set(self.sources) - set(self.views)
        return {**self.sources, **self.views, **{n: self.mart(n) for n in names}}

    def run_checks(self) -> DataFrame:
        """Every check, by reading the tables again."""
        return checks.run_checks(self.checked_tables())

    def failures(self) -> list[tuple[str, str, str, int]]:
        """Checks with failures: row checks as counted while the marts were written, the others from the tables."""
        counted = [row for table, seen in self.observed.items() for row in checks.observed_failures(table, seen)]
        known = {row[:3] for row in counted}
        rest = [c for c in checks.ALL_CHECKS if (c.kind, c.table, c.column) not in known]
        # One row per check.
        scanned = checks.run_checks(self.checked_tables(), rest).where("failures > 0").collect()
        return [row for row in counted if row[3] > 0] + [tuple(row) for row in scanned]


@dataclass(frozen=True)
class _Inputs:
    """What the marts are made from; every source row passes the watch of the first mart that reads its table."""

    staged: Mapping[str, DataFrame]
    watched: Mapping[str, DataFrame]
    warehouse: Warehouse
    scratch: Scratch


@dataclass(frozen=True)
class Mart:
    """A mart: how it is made, and the marts it reads."""

    make: Callable[[_Inputs], DataFrame]
    needs: tuple[str, ...] = ()
    watches: tuple[str, ...] = ()


def _fct_orders(given: _Inputs) -> DataFrame:
    orders, items, users, products = (given.watched[n] for n in ("stg_orders", "stg_order_items", "stg_users", "stg_products"))
    return marts.fct_orders(intermediate.int_orders_enriched(orders, items, users, products))


def _dim_customers(given: _Inputs) -> DataFrame:
    return marts.dim_customers(intermediate.int_customer_stats(given.warehouse.read_mart("fct_orders"), given.scratch))


def _product_performance(given: _Inputs) -> DataFrame:
    items, products = given.staged["stg_order_items"], given.staged["stg_products"]
    return marts.mart_product_performance(items, products, given.warehouse.read_mart("fct_orders"))


GRAPH: dict[str, Mart] = {
    "fct_orders": Mart(
        _fct_orders, watches=("orders", "order_items", "users", "products", "stg_orders", "stg_order_items", "stg_users", "stg_products")
    ),
    "mart_funnel": Mart(lambda given: marts.mart_funnel(intermediate.int_funnel(given.watched["stg_events"])), watches=("events",)),
    "dim_customers": Mart(_dim_customers, needs=("fct_orders",)),
    "mart_cohort_retention": Mart(
        lambda given: marts.mart_cohort_retention(given.warehouse.read_mart("fct_orders")), needs=("fct_orders",)
    ),
    "mart_product_performance": Mart(_product_performance, needs=("fct_orders",)),
}

# Intermediate models as views over what is published.
INTERMEDIATE_VIEWS = {
    "int_orders_enriched": "SELECT f.*, s.returned_at FROM {fct_orders} f JOIN {stg_orders} s ON f.order_id = s.order_id",
    "int_customer_stats": "SELECT * FROM {dim_customers}",
    "int_funnel": "SELECT * FROM {mart_funnel}",
}


# One task reads a bucket.
ORDERS_PER_BUCKET = 1_000_000


def orders_layout(spark: SparkSession, orders: DataFrame) -> Layout:
    """Orders by month, and within a month in buckets of users.

    What is grouped by user then needs no shuffle, and a month's rows are read without the others. There are a quarter as
    many buckets as ``spark.sql.shuffle.partitions``, and more where they would hold over ``ORDERS_PER_BUCKET`` orders.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2, partitions // 4, -(-orders.count() // ORDERS_PER_BUCKET))
    return Layout(partition_by="order_month", bucket_by="user_id", buckets=buckets)


def stage(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five staging models; lazy."""
    return {name: model(sources[model.source]) for name, model in STAGING_MODELS.items()}


def run_pipeline(
    spark: SparkSession,
    source: str | Mapping[str, DataFrame],
    out: str | None = None,
    check: bool = True,
    layers: Mapping[str, str] | None = None,
    run: str | None = None,
) -> Build:
    """Build all models from a source folder (or ready frames) and publish them.

    Marts go to folders under ``out``, or to those of the catalog without it. A mart is built as soon as
    those it needs are published; marts that do not depend on each other are written side by side, which fills the tail
    of one job with tasks of the next. If one fails, the jobs of the others are cancelled and :class:`FailedBuild`
    names the run; given as ``run``, it makes the next build skip the marts that this one has published.

    Last come the data checks; if one has failures, :class:`FailedChecks` names it. The marts stay
    for inspection. Checks of single rows were counted while the rows were written. ``check=False`` leaves the checks to
    :meth:`Build.run_checks`.

    Sources in a folder become tables of the catalog, in layer ``sources``, and the staging and intermediate models
    views in theirs, which other sessions read too. Ready frames have no SQL text: their staging
    models are views of this session, named ``staging_<model>``. ``layers`` renames layers.
    """
    tune(spark)
    run = run or uuid.uuid4().hex
    warehouse = Warehouse(spark, out, layers)
    if isinstance(source, str):
        sources = {name: read_source(spark, source, name) for name in SOURCE_SCHEMAS}
    else:
        sources = dict(source)
    staged = stage(sources)
    views: dict[str, DataFrame] = dict(staged)

    todo = {name: mart for name, mart in GRAPH.items() if warehouse.written_by(MARTS, name) != run}
    seen = {table: Observation(f"{table}-{run}") for mart in todo for table in (*GRAPH[mart].watches, mart)}

    def watch(df: DataFrame, table: str) -> DataFrame:
        return checks.watched(df, table, seen[table]) if table in seen and checks.row_checks_of(table) else df

    watched = {
        name: watch(model(watch(sources[model.source], model.source)), name) for name, model in STAGING_MODELS.items()
    }
    with Scratch(spark, "build") as scratch, ThreadPoolExecutor(1) as beside:
        # Catalog entries only, while the first marts are written.
        staging = beside.submit(inheritable_thread_target(spark)(_publish_staging), warehouse, source, staged)
        given = _Inputs(staged, watched, warehouse, scratch)

        def publish(name: str) -> None:
            layout = orders_layout(spark, sources["orders"]) if name == "fct_orders" else Layout()
            warehouse.publish_table(watch(todo[name].make(given), name), MARTS, name, layout, run)

        _in_order(spark, todo, publish, run)
        names = staging.result()
    names |= {name: warehouse.attach(MARTS, name) for name in GRAPH}
    for name, text in INTERMEDIATE_VIEWS.items():
        if isinstance(source, str):
            warehouse.publish_view(INTERMEDIATE, name, text.format(**names))
        views[name] = spark.sql(text.format(**names))
        if not isinstance(source, str):
            publish_view(views[name], INTERMEDIATE, name)
    observed = {table: counts for table, o in seen.items() if checks.row_checks_of(table) and (counts := o.get).get("rows")}
    build = Build(sources, views, warehouse, run, tuple(todo), observed)
    if check:
        failed = build.failures()
        if failed:
            raise FailedChecks("; ".join(map(str, failed)))
    return build


def _publish_staging(warehouse: Warehouse, source: str | Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> dict[str, str]:
    """Staging views; their names in SQL."""
    if not isinstance(source, str):
        return {name: publish_view(df, STAGING, name) for name, df in staged.items()}
    names = {}
    for name, model in STAGING_MODELS.items():
        path = f"{source.rstrip('/')}/{model.source}.parquet"
        table = warehouse.register_source(SOURCES, model.source, SOURCE_SCHEMAS[model.source], path)
        names[name] = warehouse.publish_view(STAGING, name, model.text(table))
    return names


def _in_order(spark: SparkSession, todo: Mapping[str, Mart], publish: Callable[[str], None], run: str) -> None:
    """Publish each mart once those it needs are there, from driver threads; the first failure stops all."""
    context, tag, stopped = spark.sparkContext, f"build-{run}", threading.Event()

    def work(name: str) -> None:
        context.addJobTag(tag)
        try:
            if not stopped.is_set():
                publish(name)
        finally:
            context.removeJobTag(tag)

    waiting, done = dict(todo), set(GRAPH) - set(todo)
    running: dict[Future, str] = {}
    failed: tuple[str, BaseException] | None = None
    with ThreadPoolExecutor(max(len(todo), 1)) as pool:
        while running or (waiting and failed is None):
            if failed is None:
                for name in [n for n, mart in waiting.items() if done.issuperset(mart.needs)]:
                    waiting.pop(name)
                    running[pool.submit(inheritable_thread_target(spark)(work), name)] = name
            else:
                # Also what a sibling starts between two of its jobs.
                context.cancelJobsWithTag(tag)
            finished, _ = wait(running, timeout=None if failed is None else 0.2, return_when=FIRST_COMPLETED)
            for future in finished:
                name, error = running.pop(future), future.exception()
                if error is None:
                    done.add(name)
                elif failed is None:
                    failed = (name, error)
                    stopped.set()
    if failed is not None:
        raise FailedBuild(failed[0], run, set(todo) - done) from failed[1]

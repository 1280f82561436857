"""Tasks that stay small while tables grow, also in a session with few shuffle partitions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from basketry.operators import intermediate, marts
from basketry.plans.build import ORDERS_PER_BUCKET, orders_layout
from basketry.session import INITIAL_PARTITIONS, TASK_SIZES, tune
from tests.test_plans import plan_of, settings


def _items(spark):
    n = F.col("id")
    return spark.range(60).select(
        (n % 20).cast("string").alias("order_id"),
        (n % 2).cast("string").alias("product_id"),
        F.when(n % 10 != 0, n.cast("string")).alias("order_item_id"),
        F.lit(2.0).alias("sale_price"),
        (n % 3 == 0).alias("is_returned"),
    )


def test_shuffles_begin_with_many_partitions(spark):
    with settings(spark, spark__sql__shuffle__partitions=4):
        plan = plan_of(intermediate.item_rollup(_items(tune(spark))))
    assert {int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan)} == {INITIAL_PARTITIONS}


def test_more_partitions_of_the_session_stay(spark):
    with settings(spark, **{"spark__sql__adaptive__coalescePartitions__initialPartitionNum": 512, "spark__sql__shuffle__partitions": 3000}):
        assert tune(spark).conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "3000"


def test_sizes_named_by_the_session_stay(spark):
    with settings(spark, spark__sql__files__maxPartitionBytes="7MB"):
        assert tune(spark).conf.get("spark.sql.files.maxPartitionBytes") == "7MB"
    for name, size in TASK_SIZES.items():
        assert tune(spark).conf.get(name) == size


def test_buckets_follow_the_orders(spark):
    with settings(spark, spark__sql__shuffle__partitions=4):
        assert orders_layout(spark, spark.range(10)).buckets == 2
        assert orders_layout(spark, spark.range(5 * ORDERS_PER_BUCKET + 1)).buckets == 6


def test_product_performance_shuffles_no_item_ids(spark):
    products = spark.sql(
        "SELECT string(id) product_id, 'n' product_name, 'c' category, 'b' brand, 'd' department, 4.0D retail_price, "
        "1.0D cost, 300.0D margin_pct FROM range(2)"
    )
    orders = spark.range(20).select(F.col("id").cast("string").alias("order_id"), F.lit("Complete").alias("order_status"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        found = marts.mart_product_performance(_items(spark), products, orders)
        join = plan_of(found).split("LeftSemi")[1]
        assert "order_item_id#" not in "".join(re.findall(r"Exchange.*", join))
        assert not re.search(r"Project \[[^\]]*AS order_item_id", join)
        rows = {r.product_id: r for r in found.collect()}
    # An item without an id is no unit sold; its price counts.
    assert [(rows[p].total_units_sold, rows[p].total_revenue, rows[p].returned_units) for p in "01"] == [(24, 60.0, 10), (30, 60.0, 10)]

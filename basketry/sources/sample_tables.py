"""The five source tables, derived from TPC-H-like sample tables.

The sample folder holds ``orders``, ``lineitem``, ``customer``, ``nation``, ``part``
and ``events`` as Parquet. Everything here is lazy; columns nobody asks for are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.schemas import SOURCE_SCHEMAS


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def _shape(df: DataFrame, source: str, columns: dict[str, str]) -> DataFrame:
    """Project SQL expressions onto the declared column types."""
    schema = SOURCE_SCHEMAS[source]
    return df.selectExpr(
        *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        "CASE WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'P' THEN 'Processing' "
        "WHEN o_orderpriority = '1-URGENT' THEN 'Returned' "
        "WHEN o_orderpriority = '5-LOW' THEN 'Cancelled' ELSE 'Shipped' END"
    )
    delivered = "o_orderdate + (o_orderkey % 5 + o_custkey % 7 + 2) * INTERVAL '1' DAY"
    return _shape(
        _read(spark, folder, "orders").selectExpr("*", f"{status} AS status"),
        "orders",
        {
            "order_id": "o_orderkey",
            "user_id": "o_custkey",
            "status": "status",
            "gender": "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
            "num_of_item": "o_orderkey % 4 + 1",
            "created_at": "o_orderdate",
            "returned_at": (
                "CASE WHEN status = 'Returned' OR (status = 'Complete' AND o_orderkey % 13 = 0) "
                f"THEN {delivered} + 3 * INTERVAL '1' DAY END"
            ),
            "shipped_at": (
                "CASE WHEN status IN ('Shipped', 'Complete', 'Returned') "
                "THEN o_orderdate + (o_orderkey % 5 + 1) * INTERVAL '1' DAY END"
            ),
            "delivered_at": f"CASE WHEN status IN ('Complete', 'Returned') THEN {delivered} END",
        },
    )


def _order_items(spark: SparkSession, folder: str) -> DataFrame:
    lines = _read(spark, folder, "lineitem")
    owners = _read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return _shape(
        lines.join(owners, lines.l_orderkey == owners.o_orderkey),
        "order_items",
        {
            "id": (
                "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
                "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), "
                "CAST(CAST(l_shipdate AS DATE) AS STRING))"
            ),
            "order_id": "l_orderkey",
            "user_id": "o_custkey",
            "product_id": "l_partkey",
            "inventory_item_id": "l_suppkey",
            "status": (
                "CASE WHEN l_returnflag = 'R' THEN 'Returned' "
                "WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Shipped' END"
            ),
            "created_at": "l_shipdate",
            "shipped_at": "l_shipdate",
            "delivered_at": "CASE WHEN l_linestatus = 'F' THEN l_shipdate + 3 * INTERVAL '1' DAY END",
            "returned_at": (
                "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' "
                "THEN l_shipdate + 9 * INTERVAL '1' DAY END"
            ),
            "sale_price": "floor(l_extendedprice / 10) / 100",
        },
    )


def _users(spark: SparkSession, folder: str) -> DataFrame:
    customers = _read(spark, folder, "customer")
    nations = _read(spark, folder, "nation")
    return _shape(
        customers.join(nations, customers.c_nationkey == nations.n_nationkey),
        "users",
        {
            "id": "c_custkey",
            "first_name": "c_name",
            "last_name": "c_custkey",
            "email": "c_name || '@example.com'",
            "age": "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 10 + c_custkey % 80 END",
            "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
            "state": "n_name",
            "city": "'CITY_' || CAST(c_custkey % 50 AS STRING)",
            "postal_code": "10000 + c_custkey % 900",
            "country": "CASE WHEN n_regionkey = 4 THEN 'Canada' ELSE 'United States' END",
            "latitude": "c_acctbal",
            "longitude": "c_acctbal",
            "traffic_source": (
                "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Search' WHEN 'MACHINERY' THEN 'Organic' "
                "WHEN 'FURNITURE' THEN 'Facebook' WHEN 'BUILDING' THEN 'Email' ELSE 'Display' END"
            ),
            "created_at": "TIMESTAMP_NTZ '1994-01-01 00:00:00'",
        },
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _shape(
        _read(spark, folder, "part"),
        "products",
        {
            "id": "p_partkey",
            "name": "p_name",
            "category": "p_type",
            "brand": "p_brand",
            "department": "CASE WHEN p_partkey % 2 = 0 THEN 'Women' ELSE 'Men' END",
            "sku": "'SKU' || CAST(p_partkey AS STRING)",
            "cost": (
                "CASE WHEN p_partkey % 211 = 0 THEN 0.0D "
                "ELSE floor(p_retailprice * (40 + p_size % 20) / 10) / 100 END"
            ),
            "retail_price": "CASE WHEN p_partkey % 199 = 0 THEN 0.0D ELSE p_retailprice / 10 END",
            "distribution_center_id": "p_partkey % 10",
        },
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return _shape(
        _read(spark, folder, "events"),
        "events",
        {
            "id": "event_id",
            "user_id": "user_id",
            "sequence_number": "event_id",
            "session_id": "CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING)",
            "created_at": "ts + (user_id % 6) * 31 * INTERVAL '1' DAY",
            "ip_address": "'10.0.0.' || CAST(user_id % 250 AS STRING)",
            "city": "'CITY_' || CAST(user_id % 50 AS STRING)",
            "state": "'NATION_' || CAST(user_id % 25 AS STRING)",
            "postal_code": "10000 + user_id",
            "browser": (
                "CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' "
                "WHEN 2 THEN 'Firefox' ELSE 'IE' END"
            ),
            "traffic_source": (
                "CASE event_id % 5 WHEN 0 THEN 'Email' WHEN 1 THEN 'Adwords' "
                "WHEN 2 THEN 'Facebook' WHEN 3 THEN 'YouTube' ELSE 'Organic' END"
            ),
            "uri": "'/' || event_type",
            "event_type": (
                "CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' "
                "WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN "
                "CASE event_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'category' ELSE 'brand' END "
                "ELSE event_type END"
            ),
        },
    )


_BUILDERS = {
    "orders": _orders,
    "order_items": _order_items,
    "users": _users,
    "products": _products,
    "events": _events,
}


def sample_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the five sources, with its declared types."""
    return _BUILDERS[name](spark, folder)

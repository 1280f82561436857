"""Column types of the five source tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    """A schema from ``name type, ...``; works before any session exists."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCE_SCHEMAS: dict[str, StructType] = {
    "orders": _schema(
        "order_id bigint, user_id bigint, status string, gender string, num_of_item bigint, "
        "created_at timestamp_ntz, returned_at timestamp_ntz, shipped_at timestamp_ntz, "
        "delivered_at timestamp_ntz"
    ),
    "order_items": _schema(
        "id string, order_id bigint, user_id bigint, product_id bigint, inventory_item_id bigint, "
        "status string, created_at timestamp_ntz, shipped_at timestamp_ntz, "
        "delivered_at timestamp_ntz, returned_at timestamp_ntz, sale_price double"
    ),
    "users": _schema(
        "id bigint, first_name string, last_name string, email string, age bigint, gender string, "
        "state string, city string, postal_code string, country string, latitude double, "
        "longitude double, traffic_source string, created_at timestamp_ntz"
    ),
    "products": _schema(
        "id bigint, name string, category string, brand string, department string, sku string, "
        "cost double, retail_price double, distribution_center_id bigint"
    ),
    "events": _schema(
        "id bigint, user_id bigint, sequence_number bigint, session_id string, "
        "created_at timestamp_ntz, ip_address string, city string, state string, "
        "postal_code string, browser string, traffic_source string, uri string, event_type string"
    ),
}

# Known by name only: registered when present, read by no model.
DECLARED_ONLY = ("inventory_items", "distribution_centers")

"""Staging: one projection, cast and filter per source table.

A model is written once, as Spark SQL expressions by column. Over a DataFrame it is a narrow select over the
scan, so filters and the column list reach the Parquet reader; over the name of a table it is the
text of a view.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
ACCEPTED_EVENT_TYPES = ("home", "category", "brand", "product", "cart", "purchase", "cancel")
HOME_COUNTRY = "United States"
RETURNED_ITEM_STATUS = "Returned"
AGE_GROUP_CEILINGS = ((18, "Under 18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_GROUP = "55+"
AGE_GROUPS = (*[label for _, label in AGE_GROUP_CEILINGS], OLDEST_GROUP)
AGE_UNKNOWN = "Unknown"


@dataclass(frozen=True)
class StagingModel:
    """A staging table: its source, an expression per column, and the rows that stay."""

    source: str
    columns: Mapping[str, str]
    keep: str

    def __call__(self, source: DataFrame) -> DataFrame:
        kept = source.where(self.keep)
        return kept.select(*[F.expr(expression).alias(name) for name, expression in self.columns.items()])

    def text(self, table: str) -> str:
        """The model as a query over a catalog table."""
        columns = ", ".join(f"{expression} AS `{name}`" for name, expression in self.columns.items())
        return f"SELECT {columns} FROM {table} WHERE {self.keep}"


def _age_group(age: str) -> str:
    """Bucket label of an age; a missing age is unknown."""
    bounded = " ".join(f"WHEN {age} < {ceiling} THEN '{label}'" for ceiling, label in AGE_GROUP_CEILINGS)
    return f"CASE {bounded} WHEN {age} IS NOT NULL THEN '{OLDEST_GROUP}' ELSE '{AGE_UNKNOWN}' END"


stg_orders = StagingModel(
    source="orders",
    columns={
        "order_id": "string(order_id)",
        "user_id": "string(user_id)",
        "order_status": "status",
        "gender": "gender",
        "num_items": "bigint(num_of_item)",
        "created_at": "created_at::timestamp_ntz",
        "returned_at": "returned_at::timestamp_ntz",
        "shipped_at": "shipped_at::timestamp_ntz",
        "delivered_at": "delivered_at::timestamp_ntz",
        "order_date": "to_date(created_at)",
        "order_month": "trunc(to_date(created_at), 'MM')",
        # Calendar days; NULL when either moment is missing.
        "days_to_deliver": "bigint(datediff(to_date(delivered_at), to_date(shipped_at)))",
        "fulfillment_days": "bigint(datediff(to_date(delivered_at), to_date(created_at)))",
        "is_returned": "returned_at IS NOT NULL",
    },
    keep="order_id IS NOT NULL",
)

stg_order_items = StagingModel(
    source="order_items",
    columns={
        "order_item_id": "string(id)",
        "order_id": "string(order_id)",
        "user_id": "string(user_id)",
        "product_id": "string(product_id)",
        "inventory_item_id": "string(inventory_item_id)",
        "item_status": "status",
        "created_at": "created_at::timestamp_ntz",
        "shipped_at": "shipped_at::timestamp_ntz",
        "delivered_at": "delivered_at::timestamp_ntz",
        "returned_at": "returned_at::timestamp_ntz",
        "sale_price": "double(sale_price)",
        # Never NULL: neither comparison is.
        "is_returned": f"status <=> '{RETURNED_ITEM_STATUS}' OR returned_at IS NOT NULL",
    },
    keep="order_id IS NOT NULL",
)

stg_users = StagingModel(
    source="users",
    columns={
        "user_id": "string(id)",
        "first_name": "first_name",
        "last_name": "last_name",
        "email": "email",
        "age": "age",
        "gender": "gender",
        "state": "state",
        "city": "city",
        "zip": "postal_code",
        "country": "country",
        "latitude": "latitude",
        "longitude": "longitude",
        "traffic_source": "traffic_source",
        "created_at": "created_at::timestamp_ntz",
        "age_group": _age_group("age"),
    },
    keep=f"id IS NOT NULL AND country = '{HOME_COUNTRY}'",
)

stg_products = StagingModel(
    source="products",
    columns={
        "product_id": "string(id)",
        "product_name": "name",
        "category": "category",
        "brand": "brand",
        "department": "department",
        "sku": "sku",
        "cost": "double(cost)",
        "retail_price": "double(retail_price)",
        "gross_margin": "double(retail_price) - double(cost)",
        "margin_pct": "if(double(cost) > 0, round((double(retail_price) - double(cost)) / double(cost) * 100D, 2), NULL)",
        "distribution_center_id": "string(distribution_center_id)",
    },
    keep="id IS NOT NULL AND retail_price > 0",
)

stg_events = StagingModel(
    source="events",
    columns={
        "event_id": "string(id)",
        "user_id": "string(user_id)",
        "sequence_number": "sequence_number",
        "session_id": "session_id",
        "event_at": "created_at::timestamp_ntz",
        "event_date": "to_date(created_at)",
        "ip_address": "ip_address",
        "city": "city",
        "state": "state",
        "zip": "postal_code",
        "browser": "browser",
        "traffic_source": "traffic_source",
        "uri": "uri",
        "event_type": "event_type",
    },
    keep=f"id IS NOT NULL AND event_type IN {ACCEPTED_EVENT_TYPES}",
)

STAGING_MODELS: dict[str, StagingModel] = {
    "stg_orders": stg_orders,
    "stg_order_items": stg_order_items,
    "stg_users": stg_users,
    "stg_products": stg_products,
    "stg_events": stg_events,
}

from __future__ import annotations

from datetime import date, datetime

from basketry.operators import staging
from tests.conftest import rows_by


def test_orders(spark, source):
    moment = datetime(2023, 1, 31, 23, 30)
    orders = source("orders", [
        {"order_id": 1, "user_id": 7, "status": "Complete", "gender": "F", "num_of_item": 2,
         "created_at": moment, "shipped_at": datetime(2023, 2, 1, 0, 30),
         "delivered_at": datetime(2023, 2, 4, 1), "returned_at": datetime(2023, 2, 9)},
        {"order_id": 2, "created_at": moment, "delivered_at": datetime(2023, 2, 1)},
        {"order_id": 3},
        {"order_id": None, "status": "Complete"},
    ])
    got = rows_by(staging.stg_orders(orders), "order_id")
    assert set(got) == {"1", "2", "3"}
    first = got["1"]
    assert (first["user_id"], first["order_status"], first["num_items"]) == ("7", "Complete", 2)
    assert first["order_date"] == date(2023, 1, 31)
    assert first["order_month"] == date(2023, 1, 1)
    # Calendar days, not elapsed hours.
    assert (first["days_to_deliver"], first["fulfillment_days"]) == (3, 4)
    assert first["is_returned"] is True
    assert (got["2"]["days_to_deliver"], got["2"]["fulfillment_days"]) == (None, 1)
    assert got["3"]["order_date"] is None and got["3"]["is_returned"] is False


def test_item_is_returned_by_status_or_moment(spark, source):
    items = source("order_items", [
        {"id": "a", "order_id": 1, "status": "Returned"},
        {"id": "b", "order_id": 1, "status": "Complete", "returned_at": datetime(2023, 1, 1)},
        {"id": "c", "order_id": 1, "returned_at": datetime(2023, 1, 1)},
        {"id": "d", "order_id": 1},
        {"id": "e", "order_id": 1, "status": "returned"},
        {"id": "f", "order_id": None, "status": "Returned"},
    ])
    got = rows_by(staging.stg_order_items(items), "order_item_id")
    assert {k: v["is_returned"] for k, v in got.items()} == {
        "a": True, "b": True, "c": True, "d": False, "e": False
    }
    assert got["a"]["order_id"] == "1"


def test_users_keep_home_country_and_bucket_ages(spark, source):
    ages = [None, 0, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 90]
    users = source("users", [
        *[{"id": i, "age": age, "country": "United States", "postal_code": "1"}
          for i, age in enumerate(ages)],
        {"id": 100, "age": 30, "country": "Canada"},
        {"id": 101, "age": 30, "country": None},
        {"id": None, "age": 30, "country": "United States"},
    ])
    got = rows_by(staging.stg_users(users), "user_id")
    assert [got[str(i)]["age_group"] for i in range(len(ages))] == [
        "Unknown", "Under 18", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44",
        "45-54", "45-54", "55+", "55+",
    ]
    assert len(got) == len(ages) and got["0"]["zip"] == "1"


def test_products_drop_unpriced_and_guard_markup(spark, source):
    products = source("products", [
        {"id": 1, "cost": 40.0, "retail_price": 50.0, "distribution_center_id": 3},
        {"id": 2, "cost": 0.0, "retail_price": 50.0},
        {"id": 3, "cost": None, "retail_price": 50.0},
        {"id": 4, "cost": 1.0, "retail_price": 0.0},
        {"id": 5, "cost": 1.0, "retail_price": None},
        {"id": None, "cost": 1.0, "retail_price": 2.0},
    ])
    got = rows_by(staging.stg_products(products), "product_id")
    assert set(got) == {"1", "2", "3"}
    assert (got["1"]["gross_margin"], got["1"]["margin_pct"]) == (10.0, 25.0)
    assert got["1"]["distribution_center_id"] == "3"
    assert (got["2"]["gross_margin"], got["2"]["margin_pct"]) == (50.0, None)
    assert (got["3"]["gross_margin"], got["3"]["margin_pct"]) == (None, None)


def test_events_keep_accepted_types(spark, source):
    kinds = ["home", "category", "brand", "product", "cart", "purchase", "cancel", "error", None]
    events = source("events", [
        *[{"id": i, "event_type": kind, "created_at": datetime(2023, 5, 6, 7)}
          for i, kind in enumerate(kinds)],
        {"id": None, "event_type": "home"},
    ])
    got = rows_by(staging.stg_events(events), "event_id")
    assert sorted(got) == [str(i) for i in range(7)]
    assert got["0"]["event_date"] == date(2023, 5, 6)

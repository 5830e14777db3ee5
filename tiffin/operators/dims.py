"""The five maintained dimensions, as settings of the generic operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tiffin.operators.scd import scd1_upsert, scd2_apply, scd3_apply


def next_customers(dim: DataFrame, src: DataFrame, now: datetime) -> DataFrame:
    return scd2_apply(
        dim,
        src,
        key="customer_id",
        sk="customer_sk",
        tracked={
            "customer_name": "",
            "email": "",
            "primary_phone": "",
            "city": "",
            "area": "",
            "segment": "",
            "is_prime_member": False,
            "status": "",
        },
        now=now,
        source="stg_customer",
    )


def next_restaurants(dim: DataFrame, src: DataFrame, now: datetime) -> DataFrame:
    return scd2_apply(
        dim,
        src,
        key="restaurant_id",
        sk="restaurant_sk",
        tracked={
            "restaurant_name": "",
            "cuisine_primary": "",
            "cuisine_secondary": "",
            "city": "",
            "area": "",
            "avg_rating": 0.0,
            "commission_rate": 0.0,
            "is_active": False,
        },
        carried=["onboarded_at"],
        now=now,
        source="stg_restaurant",
    )


def next_restaurant_cuisines(dim: DataFrame, src: DataFrame, now: datetime) -> DataFrame:
    """City and area follow only when the cuisine changes; the name never does."""
    return scd3_apply(
        dim,
        src,
        key="restaurant_id",
        source_col="cuisine_primary",
        current_col="current_cuisine",
        previous_col="previous_cuisine",
        stamp_col="last_change_date",
        refresh=["city", "area"],
        insert=["restaurant_name"],
        now=now,
    )


def next_agents(dim: DataFrame, src: DataFrame) -> DataFrame:
    return scd1_upsert(dim, src, "agent_id", ["agent_name", "phone", "hire_date", "city", "vehicle_type", "status"])


def next_promotions(dim: DataFrame, src: DataFrame) -> DataFrame:
    return scd1_upsert(
        dim,
        src,
        "promo_id",
        ["promo_code", "discount_percent", "start_date", "end_date", "max_discount_amt", "target_segment", "target_city"],
    )

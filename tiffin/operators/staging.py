"""Raw text tables to typed staging tables: one projection each, nothing stored.

``carry`` names further raw columns that come along as they are, such as the ingest time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.clean import digits, to_double, to_flag, to_int, to_money, to_text, to_ts

MONEY_SCALE = 2


def stg_customer(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("customer_id"),
        to_text("customer_name"),
        to_text("email", case="lower"),
        digits("primary_phone"),
        to_ts("registered_at"),
        to_text("city", blank_null=True),
        to_text("area", blank_null=True),
        to_double("lat"),
        to_double("lng"),
        to_text("segment", default="New"),
        to_flag("is_prime_member"),
        to_text("status", default="ACTIVE"),
        *carry,
    )


def stg_restaurant(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("restaurant_id"),
        to_text("restaurant_name"),
        to_text("cuisine_primary"),
        to_text("cuisine_secondary"),
        to_text("city", blank_null=True),
        to_text("area", blank_null=True),
        to_double("lat"),
        to_double("lng"),
        to_double("avg_rating", default=0.0),
        to_double("commission_rate", default=0.20),
        to_flag("is_active"),
        to_ts("onboarded_at"),
        *carry,
    )


def stg_delivery_agent(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("agent_id"),
        to_text("agent_name"),
        digits("phone"),
        to_ts("hire_date"),
        to_text("city", blank_null=True),
        to_text("vehicle_type"),
        to_text("status", default="ACTIVE"),
        *carry,
    )


def stg_menu_item(raw: DataFrame, money_scale: int = MONEY_SCALE, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("menu_item_id"),
        to_int("restaurant_id"),
        to_text("item_name"),
        to_text("category"),
        to_money("price", money_scale),
        to_flag("is_veg"),
        to_flag("is_active"),
        *carry,
    )


def stg_promotion(raw: DataFrame, money_scale: int = MONEY_SCALE, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("promo_id"),
        to_text("promo_code"),
        to_money("discount_percent", money_scale),
        to_ts("start_date"),
        to_ts("end_date"),
        to_money("max_discount_amt", money_scale),
        to_text("target_segment"),
        to_text("target_city"),
        *carry,
    )


def stg_order_header(raw: DataFrame, money_scale: int = MONEY_SCALE, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("order_id"),
        to_int("customer_id"),
        to_int("restaurant_id"),
        to_ts("order_created_at"),
        to_text("order_status", case="upper"),
        to_text("payment_method", case="upper"),
        to_int("promo_id"),
        to_money("order_subtotal", money_scale),
        to_money("order_discount", money_scale),
        to_money("delivery_fee", money_scale),
        to_money("total_amount", money_scale),
        to_ts("expected_delivery_at"),
        to_ts("actual_delivery_at"),
        to_text("cancellation_reason", blank_null=True),
        *carry,
    )


def stg_order_item(raw: DataFrame, money_scale: int = MONEY_SCALE, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("order_id"),
        to_int("order_item_id"),
        to_int("menu_item_id"),
        to_int("qty", default=0),
        to_money("item_price", money_scale),
        to_money("item_discount", money_scale),
        to_money("total_item_amount", money_scale),
        *carry,
    )


def stg_delivery_trip(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("trip_id"),
        to_int("order_id"),
        to_int("agent_id"),
        to_ts("pickup_time"),
        to_ts("drop_time"),
        to_double("distance_km", default=0.0),
        to_int("estimated_time_min", default=0),
        to_int("actual_time_min", default=0),
        to_int("sla_breach_flag", default=0),
        *carry,
    )


def stg_payment(raw: DataFrame, money_scale: int = MONEY_SCALE, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        to_int("payment_id"),
        to_int("order_id"),
        to_text("payment_status", case="upper"),
        to_ts("payment_at"),
        to_money("payment_amount", money_scale),
        *carry,
    )


def stg_feedback(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """A blank or bad rating becomes 0, which later counts as a low rating."""
    return raw.select(
        to_int("feedback_id"),
        to_int("order_id"),
        to_int("customer_id"),
        to_int("rating", default=0),
        F.col("comment"),
        to_double("sentiment_score"),
        to_ts("created_at"),
        *carry,
    )


def stg_customer_events(raw: DataFrame, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """One VARIANT column to seven typed ones. ``strict`` raises on an id that is no number; otherwise it becomes NULL."""
    get = F.variant_get if strict else F.try_variant_get

    def text(path: str) -> Column:
        return F.try_variant_get("event_raw", path, "string")

    return raw.select(
        get("event_raw", "$.event_id", "bigint").alias("event_id"),
        get("event_raw", "$.customer_id", "bigint").alias("customer_id"),
        text("$.event_type").alias("event_type"),
        text("$.event_ts").try_cast("timestamp_ntz").alias("event_ts"),
        text("$.metadata.search_query").alias("search_query"),
        text("$.metadata.device_os").alias("device_os"),
        text("$.metadata.app_version").alias("app_version"),
        *carry,
    )

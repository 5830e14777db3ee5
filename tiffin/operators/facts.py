"""Fact tables built from staging. ``carry`` names columns that come along for the layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.calc import divide, minute_boundaries
from tiffin.schemas import ENRICHED_COLUMNS

AMOUNT = "decimal(12,2)"
FEE = "decimal(10,2)"
RATE = "decimal(25,18)"


def fct_order_enhanced(orders: DataFrame, dates: DataFrame, trips: DataFrame, restaurants: DataFrame) -> DataFrame:
    """One row per order (per trip, should an order have several), with eight derived columns.

    The trip join comes first: it is the one fact-sized join; orders without an id match no trip and bypass it. Calendar and
    restaurants are broadcast if their size allows it, otherwise adaptive execution splits a hot restaurant across tasks.
    """
    day = dates.select(F.col("full_date").alias("order_day"), F.col("date_key").alias("order_date_key"))
    trip = trips.select("order_id", "sla_breach_flag")
    rate = restaurants.select("restaurant_id", F.col("commission_rate").try_cast(RATE).alias("rate"))

    dated = orders.withColumn("order_day", F.to_date("order_created_at"))
    identified = dated.filter("order_id is not null").join(trip, "order_id", "left")
    joined = (
        identified.unionByName(dated.filter("order_id is null"), allowMissingColumns=True)
        .join(day, "order_day", "left")
        .join(rate, "restaurant_id", "left")
    )
    subtotal, discount, total = F.col("order_subtotal"), F.col("order_discount"), F.col("total_amount")
    # Decimal product: a binary one would round half-cent ties either way. These types multiply without loss.
    commission = total.cast(AMOUNT) * F.col("rate")
    return joined.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        "order_date_key",
        "order_status",
        "payment_method",
        "promo_id",
        subtotal.cast(AMOUNT).alias("order_subtotal"),
        discount.cast(AMOUNT).alias("order_discount"),
        F.col("delivery_fee").cast(FEE).alias("delivery_fee"),
        total.cast(AMOUNT).alias("total_amount"),
        (subtotal - discount).cast(AMOUNT).alias("net_food_amount"),
        F.when(subtotal > 0, divide(discount, subtotal)).otherwise(0.0).alias("discount_pct"),
        F.when(F.col("sla_breach_flag") == 1, 1).otherwise(0).cast("bigint").alias("sla_breached"),
        commission.cast(AMOUNT).alias("platform_commission"),
        (total - commission).cast(AMOUNT).alias("restaurant_payout"),
        minute_boundaries("order_created_at", "actual_delivery_at").alias("end_to_end_min"),
        F.when(F.col("order_status") == "DELIVERED", 1).otherwise(0).cast("bigint").alias("is_delivered"),
        F.when(F.col("order_status") == "CANCELLED", 1).otherwise(0).cast("bigint").alias("is_cancelled"),
    )


def fct_delivery(trips: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return trips.select(
        "trip_id",
        "order_id",
        "agent_id",
        "pickup_time",
        "drop_time",
        F.col("distance_km").cast(FEE).alias("distance_km"),
        "estimated_time_min",
        "actual_time_min",
        "sla_breach_flag",
        *carry,
    )


def fct_feedback(feedback: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return feedback.select("feedback_id", "order_id", "customer_id", "rating", "comment", "sentiment_score", "created_at", *carry)


def fct_customer_event(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return events.select("event_id", "customer_id", "event_type", "event_ts", "search_query", "device_os", "app_version", *carry)


def fct_order_secure(enriched: DataFrame) -> DataFrame:
    """The stored copy of the enriched order row: the table that row rules and the dashboard work on."""
    return enriched.select(*ENRICHED_COLUMNS)

"""The enriched order row: order fact with calendar, current customer, current restaurant, trip and feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators.scd import scd2_current
from tiffin.schemas import ENRICHED_COLUMNS


def order_enriched(
    orders: DataFrame, dates: DataFrame, customers: DataFrame, restaurants: DataFrame, trips: DataFrame, feedback: DataFrame
) -> DataFrame:
    """Five left joins, so every order stays. Customer and restaurant ids come from the dimensions: NULL when unmatched.

    Trips and feedback are order-sized and joined first, back to back, on one partitioning by order. Adaptive execution
    need not split a join that feeds another on the same key, so orders without an id, which match nothing, bypass both;
    where a file has none, its statistics keep it from being read for them. Calendar, customers and
    restaurants are broadcast while small, otherwise shuffled, where adaptive execution splits a hot key.
    """
    trip = trips.select("order_id", "distance_km", "sla_breach_flag")
    rating = feedback.select("order_id", "rating", "sentiment_score")
    day = dates.select(F.col("date_key").alias("order_date_key"), "full_date")
    customer = scd2_current(customers).select(
        F.col("customer_id").alias("c_id"),
        "customer_name",
        F.col("city").alias("customer_city"),
        F.col("area").alias("customer_area"),
        F.col("segment").alias("customer_segment"),
    )
    restaurant = scd2_current(restaurants).select(
        F.col("restaurant_id").alias("r_id"),
        "restaurant_name",
        F.col("city").alias("restaurant_city"),
        F.col("area").alias("restaurant_area"),
        "cuisine_primary",
        "commission_rate",
    )
    renamed = orders.withColumnsRenamed({"customer_id": "o_customer", "restaurant_id": "o_restaurant"})
    identified = renamed.filter("order_id is not null").join(trip, "order_id", "left").join(rating, "order_id", "left")
    joined = (
        identified.unionByName(renamed.filter("order_id is null"), allowMissingColumns=True)
        .join(day, "order_date_key", "left")
        .join(customer, F.col("o_customer") == F.col("c_id"), "left")
        .join(restaurant, F.col("o_restaurant") == F.col("r_id"), "left")
    )
    return joined.withColumnsRenamed({"c_id": "customer_id", "r_id": "restaurant_id"}).select(*ENRICHED_COLUMNS)

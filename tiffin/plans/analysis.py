"""Analysis queries over the enriched order row. Every one is a partial aggregate followed by a small sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.calc import divide, double_mean, double_parts, mean, mean_of_doubles, merged_parts, rounded
from tiffin.operators.access import apply_row_access
from tiffin.operators.scd import scd2_current
from tiffin.plans.marts import RESTAURANT, trips_per_agent


def _gmv() -> Column:
    return F.sum("total_amount").alias("gmv")


def _orders() -> Column:
    return F.count("*").alias("total_orders")


def _rating() -> Column:
    return rounded(mean("rating"), 2).alias("avg_rating")


def _sentiment() -> Column:
    return rounded(mean_of_doubles("sentiment_score"), 2).alias("avg_sentiment_score")


def _cancel_rate() -> Column:
    """Cancelled share of all orders."""
    return rounded(divide(F.sum("is_cancelled"), F.count("*")), 4).alias("cancel_rate")


def _by_gmv(*ties: str) -> list[Column]:
    return [F.col("gmv").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in ties]]


def city_kpi(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy(F.col("restaurant_city").alias("city"))
        .agg(
            _orders(),
            _gmv(),
            F.sum("is_delivered").alias("delivered_orders"),
            F.sum("is_cancelled").alias("cancelled_orders"),
            _rating(),
            _sentiment(),
            rounded(mean("sla_breach_flag"), 4).alias("avg_sla_breach_rate"),
        )
        .orderBy(*_by_gmv("city"))
    )


def top_restaurants(enriched: DataFrame, n: int = 15) -> DataFrame:
    return (
        enriched.groupBy(*RESTAURANT)
        .agg(
            _orders(),
            _gmv(),
            rounded(mean("end_to_end_min"), 2).alias("avg_end_to_end_min"),
            rounded(mean("sla_breach_flag"), 4).alias("sla_breach_rate"),
            _rating(),
        )
        .orderBy(*_by_gmv(*RESTAURANT))
        .limit(n)
    )


def problem_restaurants(enriched: DataFrame, min_orders: int = 5, n: int = 20) -> DataFrame:
    """Worst rating first, then highest cancellation, then SLA breach, all compared as rounded."""
    return (
        enriched.groupBy(*RESTAURANT)
        .agg(_orders(), _rating(), _sentiment(), _cancel_rate(), rounded(mean("sla_breach_flag"), 4).alias("sla_breach_rate"))
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(
            F.col("avg_rating").asc_nulls_last(),
            F.col("cancel_rate").desc_nulls_first(),
            F.col("sla_breach_rate").desc_nulls_first(),
            *[F.col(c).asc_nulls_last() for c in RESTAURANT],
        )
        .limit(n)
    )


def cuisine_by_city(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("restaurant_city", "cuisine_primary")
        .agg(_orders(), _gmv(), _rating(), _sentiment())
        .orderBy(F.col("restaurant_city").asc_nulls_last(), *_by_gmv("cuisine_primary"))
    )


def segment_kpi(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("customer_segment")
        .agg(
            _orders(),
            F.count_distinct("customer_id").alias("unique_customers"),
            _gmv(),
            rounded(mean("total_amount"), 2).alias("avg_order_value"),
            _rating(),
            _sentiment(),
            _cancel_rate(),
        )
        .orderBy(*_by_gmv("customer_segment"))
    )


def prime_kpi(enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """Prime members against all others; orders without a known customer count as non-prime.

    Orders shrink to one row per customer before the membership lookup, which also turns the distinct count into a count.
    """
    per_customer = enriched.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amount_n"),
        F.sum("rating").alias("rating"),
        F.count("rating").alias("rating_n"),
        *[c.alias(n) for n, c in double_parts("sentiment_score").items()],
    )
    member = scd2_current(customers).select("customer_id", F.col("is_prime_member").alias("member"))

    def average(total: str) -> Column:
        return rounded(divide(F.sum(total), F.sum(f"{total}_n")), 2)

    return (
        per_customer.join(member, "customer_id", "left")
        .groupBy(F.coalesce("member", F.lit(False)).alias("is_prime_member"))
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("amount").alias("gmv"),
            average("amount").alias("avg_order_value"),
            average("rating").alias("avg_rating"),
            rounded(double_mean(merged_parts("sentiment_score")), 2).alias("avg_sentiment_score"),
        )
        .orderBy(*_by_gmv("is_prime_member"))
    )


def agent_perf(trips: DataFrame, agents: DataFrame) -> DataFrame:
    per_agent = trips_per_agent(trips).select(
        "agent_id",
        "orders_delivered",
        rounded(F.col("avg_distance_km"), 2).alias("avg_distance_km"),
        rounded(F.col("avg_delivery_time_min"), 2).alias("avg_delivery_time_min"),
        rounded(F.col("sla_breach_rate"), 4).alias("sla_breach_rate"),
    )
    agent = agents.select("agent_id", "agent_name", F.col("city").alias("agent_city"), "vehicle_type", F.col("status").alias("agent_status"))
    return (
        per_agent.join(agent, "agent_id")
        .select(*agent.columns, *per_agent.columns[1:])
        .orderBy(F.col("orders_delivered").desc(), F.col("agent_id").asc_nulls_last())
    )


def feedback_dist(feedback: DataFrame, enriched: DataFrame) -> DataFrame:
    given = feedback.select("order_id", "rating", "sentiment_score")
    place = enriched.filter("order_id is not null").select("order_id", "restaurant_city")
    placed = given.filter("order_id is not null").join(place, "order_id", "left")
    return (
        placed.unionByName(given.filter("order_id is null"), allowMissingColumns=True)
        .groupBy("restaurant_city", "rating")
        .agg(F.count("*").alias("feedback_count"), _sentiment())
        .orderBy(F.col("restaurant_city").asc_nulls_last(), F.col("rating").asc_nulls_last())
    )


def commission_by_city(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy(F.col("restaurant_city").alias("city"))
        .agg(
            _gmv(),
            F.sum("platform_commission").alias("total_platform_commission"),
            F.sum("restaurant_payout").alias("total_restaurant_payout"),
            rounded(divide(F.sum("platform_commission"), F.sum("total_amount")), 4).alias("effective_commission_pct"),
        )
        .orderBy(*_by_gmv("city"))
    )


def secure_restaurants(secure: DataFrame, access: DataFrame, role: str) -> DataFrame:
    return (
        apply_row_access(secure, access, role)
        .groupBy("restaurant_city", "restaurant_id", "restaurant_name")
        .agg(_orders(), _gmv(), _rating(), _sentiment())
        .orderBy(F.col("restaurant_city").asc_nulls_last(), *_by_gmv("restaurant_id"))
    )


def secure_order_counts(secure: DataFrame) -> DataFrame:
    return (
        secure.groupBy("restaurant_city", "restaurant_id")
        .agg(F.count("*").alias("order_cnt"))
        .orderBy(F.col("restaurant_city").asc_nulls_last(), F.col("restaurant_id").asc_nulls_last())
    )

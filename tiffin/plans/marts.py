"""KPI marts over the enriched order row and the delivery, event and agent tables.

Averages are an exact sum over a count, so they do not depend on partitioning. Two similar columns are kept apart:
``sla_breached`` is 0 for an order without a trip, ``sla_breach_flag`` is NULL for it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiffin.functions.calc import count_if, divide, double_mean, double_parts, mean, mean_of_doubles, rounded
from tiffin.operators.scd import scd2_current

RESTAURANT = ["restaurant_id", "restaurant_name", "restaurant_city", "cuisine_primary"]
CUSTOMER = ["customer_id", "customer_name", "customer_city", "customer_area", "customer_segment"]
CITY_DAY = ["full_date", "customer_city", "restaurant_city"]

LOW_RATING = 3


def is_low_rating() -> Column:
    return F.col("rating") <= LOW_RATING


def restaurant_advanced_kpi(enriched: DataFrame) -> DataFrame:
    """Daily restaurant figures with revenue over the last 7 and 30 days that had orders, and week-on-week growth.

    The windows run over daily rows, at most one per restaurant and calendar day, so a hot restaurant is reduced
    before it meets them. The growth compares with the 7-row revenue seven rows earlier: a second window stage.
    """
    daily = enriched.groupBy(*RESTAURANT, "full_date").agg(
        F.sum("total_amount").alias("gmv"),
        F.sum("is_delivered").alias("delivered_orders"),
        F.sum("is_cancelled").alias("cancelled_orders"),
        F.sum("restaurant_payout").alias("restaurant_payout"),
        F.sum("platform_commission").alias("platform_commission"),
        mean("sla_breached").alias("sla_breach_rate"),
        mean("rating").alias("avg_rating"),
        mean("end_to_end_min").alias("avg_delivery_time_min"),
    )
    by_day = Window.partitionBy("restaurant_id").orderBy(F.col("full_date").asc_nulls_last())
    rolling = daily.withColumns(
        {
            "gmv_7d": F.sum("gmv").over(by_day.rowsBetween(-6, 0)),
            "gmv_30d": F.sum("gmv").over(by_day.rowsBetween(-29, 0)),
        }
    )
    return rolling.withColumn("gmv_7d_prev", F.lag("gmv_7d", 7).over(by_day)).withColumn(
        "gmv_7d_wow_growth", divide(F.col("gmv_7d") - F.col("gmv_7d_prev"), F.col("gmv_7d_prev"))
    )


def _per_agent(trips: DataFrame, sums: dict[str, Column], derive: dict[str, Column]) -> DataFrame:
    """Orders, days and sums per agent. Aggregated before the agent join, so a hot agent never travels as single trips.

    Days come from one aggregate by agent and day, which carries the sums; orders from one by agent and order. Both shrink to one
    row per agent and meet there. ``sums`` are added up by day and then by agent; ``derive`` builds columns of the totals.
    """
    known = trips.filter("agent_id is not null")
    by_day = known.groupBy("agent_id", F.to_date("pickup_time").alias("day")).agg(*[c.alias(n) for n, c in sums.items()])
    totals = by_day.groupBy("agent_id").agg(*[F.sum(n).alias(n) for n in sums], F.count("day").alias("days_worked"))
    orders = known.select("agent_id", "order_id").distinct().groupBy("agent_id").agg(F.count("order_id").alias("orders_delivered"))
    return orders.join(totals, "agent_id").select("agent_id", "orders_delivered", *[c.alias(n) for n, c in derive.items()], "days_worked")


def _averages(*names: str) -> dict[str, Column]:
    return {k: c for n in names for k, c in ((n, F.sum(n)), (f"{n}_n", F.count(n)))}


def _average(name: str) -> Column:
    return divide(F.col(name), F.col(f"{name}_n"))


def _trip_sums() -> dict[str, Column]:
    return _averages("distance_km", "actual_time_min", "sla_breach_flag")


def _trip_means() -> dict[str, Column]:
    return {
        "avg_distance_km": _average("distance_km"),
        "avg_delivery_time_min": _average("actual_time_min"),
        "sla_breach_rate": _average("sla_breach_flag"),
    }


def trips_per_agent(trips: DataFrame) -> DataFrame:
    return _per_agent(trips, _trip_sums(), _trip_means())


def agent_efficiency_kpi(trips: DataFrame, agents: DataFrame) -> DataFrame:
    return (
        trips_per_agent(trips)
        .join(agents, "agent_id")
        .select(
            "agent_id",
            "agent_name",
            F.col("city").alias("agent_city"),
            "orders_delivered",
            F.col("avg_distance_km").alias("avg_distance_per_order"),
            "avg_delivery_time_min",
            "sla_breach_rate",
            "days_worked",
            divide(F.col("orders_delivered"), F.col("days_worked")).alias("avg_orders_per_day"),
        )
    )


def city_search_to_order(events: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Searches and delivered orders per customer city and day, for customers who did both on that day.

    Both sides shrink to one row per customer and day before they are joined.
    """
    searches = (
        events.filter("event_type = 'SEARCH'")
        .groupBy("customer_id", F.to_date("event_ts").alias("dt"))
        .agg(F.count("*").alias("searches"))
    )
    delivered = (
        orders.filter("is_delivered = 1")
        .groupBy("customer_id", F.col("full_date").alias("dt"))
        .agg(F.count("*").alias("orders"))
    )
    city = scd2_current(customers).select("customer_id", F.col("city").alias("customer_city"))
    return (
        searches.join(delivered, ["customer_id", "dt"])
        .join(city, "customer_id")
        .groupBy("customer_city", "dt")
        .agg(F.sum("searches").alias("total_searches"), F.sum("orders").alias("total_orders"))
        .withColumn("search_to_order_ratio", divide(F.col("total_orders"), F.col("total_searches")))
    )


def restaurant_feedback_kpi(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy(*RESTAURANT)
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("is_delivered").alias("delivered_orders"),
            F.sum("is_cancelled").alias("cancelled_orders"),
            mean("rating").alias("avg_customer_rating"),
            mean_of_doubles("sentiment_score").alias("avg_sentiment_score"),
            count_if(is_low_rating()).alias("low_rating_orders"),
            count_if(is_low_rating() & (F.col("is_delivered") == 1)).alias("_low_delivered"),
            mean("end_to_end_min").alias("avg_end_to_end_min"),
            mean("distance_km").alias("avg_distance_km"),
            mean("sla_breach_flag").alias("sla_breach_rate"),
        )
        .select(
            *RESTAURANT,
            "total_orders",
            "delivered_orders",
            "cancelled_orders",
            F.coalesce(divide(F.col("cancelled_orders"), F.col("total_orders")), F.lit(0.0)).alias("cancel_rate"),
            "avg_customer_rating",
            "avg_sentiment_score",
            "low_rating_orders",
            F.when(F.col("delivered_orders") > 0, divide(F.col("_low_delivered"), F.col("delivered_orders"))).alias(
                "low_rating_delivered_pct"
            ),
            "avg_end_to_end_min",
            "avg_distance_km",
            "sla_breach_rate",
        )
    )


def customer_experience_kpi(enriched: DataFrame, as_of: date) -> DataFrame:
    return (
        enriched.groupBy(*CUSTOMER)
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("is_delivered").alias("delivered_orders"),
            F.sum("is_cancelled").alias("cancelled_orders"),
            mean("total_amount").alias("avg_order_value"),
            mean("rating").alias("avg_rating"),
            mean_of_doubles("sentiment_score").alias("avg_sentiment_score"),
            count_if(is_low_rating()).alias("low_rating_orders"),
            F.min("full_date").alias("first_order_date"),
            F.max("full_date").alias("last_order_date"),
        )
        .withColumn("days_since_last_order", F.datediff(F.lit(as_of), F.col("last_order_date")))
    )


def agent_feedback_kpi(trips: DataFrame, agents: DataFrame, enriched: DataFrame) -> DataFrame:
    """Agent figures with the ratings of the orders they delivered.

    Trips meet orders on the order id, then shrink to one row per agent before the agent join.
    """
    order = enriched.filter("order_id is not null").select("order_id", "rating", "sentiment_score")
    rated = (
        trips.filter("order_id is not null").join(order, "order_id", "left").unionByName(trips.filter("order_id is null"), allowMissingColumns=True)
    )
    parts = double_parts("sentiment_score")
    per_agent = _per_agent(
        rated,
        {**_trip_sums(), **_averages("rating"), **parts, "low_rating_orders": count_if(is_low_rating())},
        {
            **_trip_means(),
            "avg_customer_rating": _average("rating"),
            "avg_sentiment_score": double_mean({p: F.col(p) for p in parts}),
            "low_rating_orders": F.col("low_rating_orders"),
        },
    )
    agent = agents.select("agent_id", "agent_name", F.col("city").alias("agent_city"), "vehicle_type", F.col("status").alias("agent_status"))
    return (
        per_agent.join(agent, "agent_id")
        .withColumn("avg_orders_per_day", divide(F.col("orders_delivered"), F.col("days_worked")))
        .select(*agent.columns, *per_agent.columns[1:], "avg_orders_per_day")
    )


def city_day_sums(rows: DataFrame) -> DataFrame:
    """Figures per day and pair of cities, from which every output column follows."""
    return rows.groupBy(*CITY_DAY).agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").cast("decimal(38,2)").alias("gmv"),
        F.sum("is_delivered").alias("delivered_orders"),
        F.sum("is_cancelled").alias("cancelled_orders"),
        F.coalesce(F.sum("rating"), F.lit(0)).alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        mean_of_doubles("sentiment_score").alias("sentiment"),
        F.coalesce(F.sum("sla_breach_flag"), F.lit(0)).alias("sla_sum"),
        F.count("sla_breach_flag").alias("sla_n"),
    )


def city_day_view(sums: DataFrame) -> DataFrame:
    return sums.select(
        *CITY_DAY,
        "total_orders",
        "gmv",
        "delivered_orders",
        "cancelled_orders",
        rounded(divide(F.col("rating_sum"), F.col("rating_n")), 2).alias("avg_rating"),
        rounded(F.col("sentiment"), 2).alias("avg_sentiment_score"),
        rounded(divide(F.col("sla_sum"), F.col("sla_n")), 4).alias("avg_sla_breach_rate"),
    )


def daily_city_kpi(enriched: DataFrame) -> DataFrame:
    return city_day_view(city_day_sums(enriched))

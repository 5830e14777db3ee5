"""Parameterised dashboard queries. Callers pass the secure order table after ``apply_row_access``."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.calc import divide, mean
from tiffin.plans.marts import RESTAURANT

MONTH = "order_month"  # partition column of the stored secure table


@dataclass(frozen=True)
class Filter:
    """Date range, and the chosen cities and cuisines. None stands for no choice, or for all options chosen."""

    start: date
    end: date
    cities: Collection[str] | None = None
    cuisines: Collection[str] | None = None

    @classmethod
    def chosen(
        cls,
        start: date,
        end: date,
        cities: Collection[str],
        all_cities: Collection[str],
        cuisines: Collection[str],
        all_cuisines: Collection[str],
    ) -> Filter:
        """Choosing nothing or everything puts no predicate on the column, so rows without a value stay."""

        def narrowed(some: Collection[str], every: Collection[str]) -> Collection[str] | None:
            return some if some and len(some) != len(every) else None

        return cls(start, end, narrowed(cities, all_cities), narrowed(cuisines, all_cuisines))


def filters(df: DataFrame, flt: Filter) -> DataFrame:
    """Keep the rows that pass each predicate whose column the table has. The month predicate prunes partitions."""
    if "full_date" in df.columns:
        df = df.filter(F.col("full_date").between(F.lit(flt.start), F.lit(flt.end)))
        if MONTH in df.columns:
            df = df.filter(F.col(MONTH).between(flt.start.year * 100 + flt.start.month, flt.end.year * 100 + flt.end.month))
    for name, some in (("restaurant_city", flt.cities), ("cuisine_primary", flt.cuisines)):
        if some and name in df.columns:
            df = df.filter(F.col(name).isin(list(some)))
    return df


def date_bounds(secure: DataFrame) -> DataFrame:
    return secure.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def _options(secure: DataFrame, name: str) -> DataFrame:
    return secure.filter(F.col(name).isNotNull()).select(name).distinct().orderBy(name)


def cities(secure: DataFrame) -> DataFrame:
    return _options(secure, "restaurant_city")


def cuisines(secure: DataFrame) -> DataFrame:
    return _options(secure, "cuisine_primary")


def _gmv() -> Column:
    return F.sum("total_amount").alias("gmv")


def _delivered() -> Column:
    return F.sum("is_delivered").alias("delivered_orders")


def overview(secure: DataFrame, flt: Filter) -> DataFrame:
    """One row of headline figures, zeros when nothing passes. Cancellation is a percentage of closed orders."""
    totals = filters(secure, flt).agg(
        _gmv(),
        _delivered(),
        F.sum("is_cancelled").alias("cancelled_orders"),
        mean("rating").alias("avg_rating"),
        mean("end_to_end_min").alias("avg_delivery_time_min"),
        mean("sla_breached").alias("sla_breach_rate"),
    )
    zeroed = totals.select(*[F.coalesce(c, F.lit(0).cast(totals.schema[c].dataType)).alias(c) for c in totals.columns])
    closed = F.col("delivered_orders") + F.col("cancelled_orders")
    share = F.coalesce(divide(F.col("cancelled_orders"), closed) * 100, F.lit(0.0))
    return zeroed.withColumn("cancellation_pct", share)


def daily(secure: DataFrame, flt: Filter) -> DataFrame:
    return filters(secure, flt).groupBy("full_date").agg(_gmv(), _delivered()).orderBy("full_date")


def restaurants(secure: DataFrame, flt: Filter, n: int | None = None) -> DataFrame:
    table = (
        filters(secure, flt)
        .groupBy(*RESTAURANT)
        .agg(
            _gmv(),
            _delivered(),
            F.sum("is_cancelled").alias("cancelled_orders"),
            mean("rating").alias("avg_rating"),
            mean("end_to_end_min").alias("avg_delivery_time_min"),
        )
        .orderBy(F.col("gmv").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in RESTAURANT])
    )
    return table if n is None else table.limit(n)


def cuisine_kpi(secure: DataFrame, flt: Filter) -> DataFrame:
    return (
        filters(secure, flt)
        .groupBy("cuisine_primary")
        .agg(_gmv(), _delivered(), mean("rating").alias("avg_rating"))
        .orderBy(F.col("gmv").desc_nulls_first(), F.col("cuisine_primary").asc_nulls_last())
    )


def city_funnel(funnel: DataFrame, start: date, end: date) -> DataFrame:
    return (
        funnel.filter(F.col("dt").between(F.lit(start), F.lit(end)))
        .select("customer_city", "dt", "total_searches", "total_orders", "search_to_order_ratio")
        .orderBy(F.col("dt").asc_nulls_last(), F.col("customer_city").asc_nulls_last())
    )


def agents(agent_kpi: DataFrame, n: int | None = None) -> DataFrame:
    table = agent_kpi.select(
        "agent_id",
        "agent_name",
        "agent_city",
        "orders_delivered",
        "avg_distance_per_order",
        "avg_delivery_time_min",
        "sla_breach_rate",
        "avg_orders_per_day",
    )
    if n is None:
        return table
    return table.orderBy(F.col("orders_delivered").desc(), F.col("agent_id").asc_nulls_last()).limit(n)


def order_detail(secure: DataFrame, flt: Filter) -> DataFrame:
    return (
        filters(secure, flt)
        .select(
            "full_date",
            "order_id",
            "restaurant_name",
            "restaurant_city",
            "cuisine_primary",
            "customer_name",
            "customer_city",
            "total_amount",
            "order_status",
            "payment_method",
            "rating",
            "sentiment_score",
            "end_to_end_min",
        )
        .orderBy(F.col("full_date").asc_nulls_last(), F.col("order_id").asc_nulls_last())
    )


def mart_names(marts: Mapping[str, Callable[[], DataFrame]]) -> list[str]:
    return sorted(marts)


def explore(marts: Mapping[str, Callable[[], DataFrame]], name: str, flt: Filter) -> DataFrame:
    """All rows and columns of one mart, under those of the filters its columns allow."""
    return filters(marts[name](), flt)

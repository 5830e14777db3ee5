"""The daily city table, kept up to date as orders, trips and feedback arrive.

Every micro-batch is taken into a store by place (``sources.placed``), the place of an order being its period. The store's locator tells
which periods the batch touches: those of its own orders, of the orders that its trips and feedback belong to, and those that an order
has left. Only the folders of these periods are read; their figures are computed anew and replace the periods' folders whole. So a
change of status, a late trip or rating, a repeated delivery and a replayed batch all end in the figures that the batch mart would
show, and a batch costs the same whatever the length of the history.

    <out>/period=<first day>/    figures of one period; one that lost its last order holds a row without orders
    <state>/                     the store; by default beside the figures

Periods are days, or months, quarters or years where shorter ones would be many and small (``grain``).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tiffin.operators.facts import fct_delivery, fct_feedback, fct_order_enhanced
from tiffin.operators.scd import scd2_current
from tiffin.plans.enriched import order_enriched
from tiffin.plans.marts import CITY_DAY, city_day_sums, city_day_view
from tiffin.sources.placed import NOWHERE, PLACE, SOURCE, WAITING, Store, followers, leaders, take_in
from tiffin.sources.tables import append_table, empty, exists

PERIOD = "period"
KEYS = {"orders": "order_id", "trips": "trip_id", "feedback": "feedback_id"}
KPI_SCHEMA = (
    "full_date date, customer_city string, restaurant_city string, total_orders bigint, gmv decimal(38,2), delivered_orders bigint,"
    " cancelled_orders bigint, avg_rating double, avg_sentiment_score double, avg_sla_breach_rate double"
)


def _period(time: str, grain: str) -> Column:
    return F.to_date(time) if grain == "day" else F.trunc(F.to_date(time), grain)


def land_orders(staged: DataFrame, path: str, grain: str = "day") -> None:
    """Append staged orders in folders by period. Orders without a creation time share the folder of no period."""
    placed = staged.withColumn(PERIOD, _period("order_created_at", grain))
    placed.hint("rebalance", PERIOD).write.mode("append").partitionBy(PERIOD).parquet(path)


def land(staged: DataFrame, path: str) -> None:
    append_table(staged, path)


def city_store(
    root: str,
    schemas: Mapping[str, StructType],
    latest_by: Sequence[str],
    grain: str = "day",
    calendar: tuple[date, date] | None = None,
    buckets: int = 64,
) -> Store:
    """Orders by period, trips and feedback beside them. Orders outside the calendar have no date, so they share the place of no period."""

    def place() -> Column:
        period = _period("order_created_at", grain)
        return period if calendar is None else F.when(F.to_date("order_created_at").between(*map(F.lit, calendar)), period)

    return Store(root, "orders", place, schemas, KEYS, tuple(latest_by), followers=("trips", "feedback"), buckets=buckets)


def period_figures(
    store: Store,
    spark: SparkSession,
    places: Collection[str],
    dates: DataFrame,
    customers: DataFrame,
    restaurants: DataFrame,
    grain: str = "day",
) -> DataFrame:
    """The figures of some periods from the last version of every row, and a row without orders for each period.

    The latter makes every period's folder be written, also that of a period which lost its last order.
    """
    periods = [p for p in places if not p.startswith(WAITING)]
    orders = leaders(store, spark, periods).drop(PLACE)
    trips, feedback = (followers(store, spark, name, periods).drop(PLACE) for name in ("trips", "feedback"))
    fact = fct_order_enhanced(orders, dates, trips, scd2_current(restaurants).select("restaurant_id", "commission_rate"))
    rows = order_enriched(fact, dates, customers, restaurants, fct_delivery(trips), fct_feedback(feedback))
    figures = city_day_view(city_day_sums(rows)).withColumn(PERIOD, _period("full_date", grain))
    days = F.array(*[F.lit(None if p == NOWHERE else p).cast("date") for p in periods])
    none = spark.range(1).select(F.explode(days).alias(PERIOD), F.lit(0).cast("bigint").alias("total_orders"))
    return figures.unionByName(none, allowMissingColumns=True)


def daily_city_kpi_stream(
    spark: SparkSession,
    landing: Mapping[str, str],
    out: str,
    checkpoint: str,
    *,
    schemas: Mapping[str, StructType],
    dimensions: Callable[[], tuple[DataFrame, DataFrame, DataFrame]],
    latest_by: Sequence[str],
    grain: str = "day",
    interval: str | None = None,
    max_files: int | None = None,
    state: str | None = None,
    calendar: tuple[date, date] | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """Follow the folders of staged orders, trips and feedback. Without an interval it takes in what is there and stops.

    ``dimensions`` gives calendar, customers and restaurants as they are when a batch runs. ``latest_by`` names the columns that order
    the deliveries of a row. ``calendar`` gives the first and last day of the calendar, where orders may lie outside it. ``buckets`` is the
    number of folders of the locator; it and the grain stay as they are once the stream has run. A batch's own files are read once per use; the
    batch is not kept.
    """
    store = city_store(state or f"{out.rstrip('/')}_state", schemas, latest_by, grain, calendar, buckets)

    def changes(name: str) -> DataFrame:
        reader = spark.readStream.schema(schemas[name])
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.parquet(landing[name])
        return rows.select(F.struct(*schemas[name].names, F.col("_metadata.file_path").alias(SOURCE)).alias(name))

    def replace_periods(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        arrived = {n: batch.filter(F.col(n).isNotNull()).select(f"{n}.*") for n in KEYS}
        places = take_in(store, arrived)
        if any(not p.startswith(WAITING) for p in places):
            figures = period_figures(store, session, places, *dimensions(), grain).hint("rebalance", PERIOD)
            figures.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(out)

    every = changes("orders").unionByName(changes("trips"), allowMissingColumns=True).unionByName(changes("feedback"), allowMissingColumns=True)
    writer = every.writeStream.foreachBatch(replace_periods).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_daily_city_kpi(spark: SparkSession, out: str) -> DataFrame:
    """The table as it stands. Filters on period prune folders."""
    if not exists(spark, out):
        return empty(spark, KPI_SCHEMA)
    stored = spark.read.schema(f"{KPI_SCHEMA}, {PERIOD} date").parquet(out)
    return stored.filter("total_orders > 0").select(*CITY_DAY, *[c.split()[0] for c in KPI_SCHEMA.split(", ")][len(CITY_DAY) :])

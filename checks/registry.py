"""One registered query per operator: each reads the test tables, or the warehouse Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import (
    AS_OF,
    CALENDAR,
    FIRST_RUN,
    SECOND_RUN,
    changed_warehouse,
    deliveries,
    raw,
    raw_sql,
    raw_text,
    role_access,
    run_folder,
    stored,
    warehouse,
)
from checks.raw_inputs import RAW_SQL
from tiffin import schemas
from tiffin.functions.calc import mean_of_doubles
from tiffin.functions.clean import to_flag, to_int, to_money
from tiffin.functions.policy import mask_email, mask_phone, sla_bucket
from tiffin.operators import dims, facts, staging
from tiffin.operators.access import apply_masks, apply_row_access
from tiffin.operators.calendar import dim_date
from tiffin.operators.edit import update_where
from tiffin.operators.scd import scd2_current, scd2_history
from tiffin.plans import analysis, dashboard, marts, refresh
from tiffin.plans.dashboard import Filter
from tiffin.plans.refresh import enriched_orders
from tiffin.sources.raw import null_tokens, read_raw_csv, read_raw_events
from tiffin.sources.tables import append_table, overwrite_table, read_table
from tiffin.streaming.daily_city import PERIOD, daily_city_kpi_stream, land, land_orders, read_daily_city_kpi
from tiffin.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

RANGE = (date(1996, 1, 1), date(1999, 6, 30))
ALL_PLACES = Filter(*RANGE)
SOME_PLACES = Filter(*RANGE, ("NATION_1", "NATION_2", "NATION_7"), ("Chinese", "Italian", "Bakery"))

_TEXT = {"date", "timestamp", "timestamp_ntz"}
_INTS = {"byte", "short", "integer"}


def comparable(df: DataFrame) -> DataFrame:
    """Types that read the same from both engines: money as double, times as text, whole numbers as bigint."""

    def cast(f):
        kind = f.dataType.typeName()
        c = F.col(f.name)
        if kind == "decimal":
            return c.cast("double").alias(f.name)
        if kind in _TEXT:
            return c.cast("string").alias(f.name)
        return c.cast("bigint").alias(f.name) if kind in _INTS else c

    return df.select(*[cast(f) for f in df.schema.fields])


def secure(s: SparkSession, d: str) -> DataFrame:
    return stored(s, d, "fct_order_secure")


def order_rows(s: SparkSession, d: str) -> DataFrame:
    """The enriched order row as last stored. Marts read it instead of repeating its five joins."""
    return secure(s, d).select(*schemas.ENRICHED_COLUMNS)


def customers(s: SparkSession, d: str) -> DataFrame:
    return stored(s, d, "dim_customer")


def agents(s: SparkSession, d: str) -> DataFrame:
    return stored(s, d, "dim_delivery_agent")


def trips(s: SparkSession, d: str) -> DataFrame:
    return stored(s, d, "fct_delivery")


def funnel(s: SparkSession, d: str) -> DataFrame:
    purchases = raw_sql(s, d, RAW_SQL["purchase"])
    return marts.city_search_to_order(stored(s, d, "fct_customer_event"), purchases, customers(s, d))


def order_calendar(s: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    bounds = s.read.parquet(f"{d}/orders.parquet").agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return dim_date(s, bounds.first, bounds.last)


def ingested_events(s: SparkSession, d: str) -> DataFrame:
    """Events as JSON files, ingested as a stream, then staged."""
    work = run_folder(s, "ingest")
    raw_text(s, d, schemas.EVENTS).write.text(f"{work}/landing")
    ingest_stream(s, f"{work}/landing", schemas.EVENTS, f"{work}/raw", f"{work}/checkpoint").awaitTermination()
    return staging.stg_customer_events(s.read.schema("event_raw variant").parquet(f"{work}/raw"))


STREAMED = {"orders": "order_header", "trips": "delivery_trip", "feedback": "customer_feedback"}


def _stream(s: SparkSession, d: str, waves: list[dict[str, DataFrame]]) -> DataFrame:
    """The daily city table after several landings, each taken in by its own run of the stream."""
    work = run_folder(s, "stream")
    landing = {n: f"{work}/landing/{n}" for n in STREAMED}
    day_schema = {n: df.schema for n, df in waves[0].items()}
    day_schema["orders"] = day_schema["orders"].add(PERIOD, "date")
    for wave in waves:
        for name, rows in wave.items():
            land_orders(rows, landing[name], "year") if name == "orders" else land(rows, landing[name])
        daily_city_kpi_stream(
            s,
            landing,
            f"{work}/out",
            f"{work}/checkpoint",
            schemas=day_schema,
            dimensions=lambda: (stored(s, d, "dim_date"), customers(s, d), stored(s, d, "dim_restaurant")),
            latest_by=["delivery"],
            grain="year",
            calendar=CALENDAR,
            buckets=8,
        ).awaitTermination()
    return read_daily_city_kpi(s, f"{work}/out")


def _staged_for_stream(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """Staged orders, some with a negative id and some without any, which then have no trip and no feedback."""
    k = F.col("order_id")
    odd = F.when(F.pmod(k, F.lit(50)) == 7, -k).when(F.pmod(k, F.lit(50)) != 9, k)
    return {n: stored(s, d, f"staging/{r}").withColumn("order_id", odd).filter("order_id is not null" if n != "orders" else "true") for n, r in STREAMED.items()}


def _delivered(df: DataFrame, number: int) -> DataFrame:
    return df.withColumn("delivery", F.lit(number).cast("bigint"))


def streamed_city_days(s: SparkSession, d: str) -> DataFrame:
    """Three landings: half of the orders, an eighth of them still open; then the other half, the open ones again as they ended, and all
    trips with half of the feedback; at last the rest of the feedback, and a quarter of the orders once more."""
    rows = _staged_for_stream(s, d)
    part = F.pmod(F.xxhash64(F.coalesce("order_id", F.lit(0)), "order_created_at"), F.lit(8))
    orders, open_ = rows["orders"], part == 0
    early = orders.filter(part < 4)
    undone = early.withColumns(
        {"order_status": F.when(open_ & F.col("order_id").isNotNull(), "PLACED").otherwise(F.col("order_status"))}
    )
    late = orders.filter(part >= 4).unionByName(early.filter(open_ & F.col("order_id").isNotNull()))
    again = orders.filter(part.isin(1, 2) & F.col("order_id").isNotNull())
    half = F.pmod("feedback_id", F.lit(2)) == 0
    waves = [
        {"orders": undone, "trips": rows["trips"].limit(0), "feedback": rows["feedback"].limit(0)},
        {"orders": late, "trips": rows["trips"], "feedback": rows["feedback"].filter(half)},
        {"orders": again, "trips": rows["trips"].limit(0), "feedback": rows["feedback"].filter(~half)},
    ]
    return _stream(s, d, [{n: _delivered(df, i) for n, df in wave.items()} for i, wave in enumerate(waves)])


def late_feedback_days(s: SparkSession, d: str) -> DataFrame:
    """All orders and trips first; then feedback alone, of which every tenth comes a second time with the lowest rating."""
    rows = _staged_for_stream(s, d)
    lower = rows["feedback"].filter(F.pmod("feedback_id", F.lit(10)) == 3).withColumn("rating", F.lit(1).cast("bigint"))
    waves = [
        {"orders": rows["orders"], "trips": rows["trips"], "feedback": rows["feedback"].limit(0)},
        {"feedback": rows["feedback"]},
        {"feedback": lower},
    ]
    return _stream(s, d, [{n: _delivered(df, i) for n, df in wave.items()} for i, wave in enumerate(waves)])


def _two_runs(name: str, source: str, stage, advance, *, clocked: bool) -> Query:
    """A dimension after two deliveries, stored after each as a refresh does."""

    def query(s: SparkSession, d: str) -> DataFrame:
        root = run_folder(s, name)
        for delivery, clock in zip(deliveries(s, d, source), (FIRST_RUN, SECOND_RUN), strict=True):
            src = stage(delivery)
            refresh.store_dimension(s, root, name, lambda dim: advance(dim, src, *([clock] if clocked else [])), delivered=src, buckets=8)  # noqa: B023
        return refresh.table(s, root, name)

    return query


def _judged_keys(query: Query, sk: str) -> Query:
    """Surrogate keys are not compared by value: they must be unique, and those of the second run above all of the first."""

    def judged(s: SparkSession, d: str) -> DataFrame:
        dim = query(s, d)  # stored, so the reads below don't build it again
        top = dim.filter(F.col("effective_from") < F.lit(SECOND_RUN)).agg(F.max(sk)).scalar()
        copies = dim.groupBy(sk).agg(F.count("*").alias("_copies"))
        grown = (F.col("effective_from") < F.lit(SECOND_RUN)) | (F.col(sk) > top)
        judged_ = dim.join(copies, sk).withColumns({"key_is_unique": F.col("_copies") == 1, "key_has_grown": grown})
        return judged_.drop(sk, "_copies")

    return judged


scd2_customers = _two_runs("dim_customer", "customer", staging.stg_customer, dims.next_customers, clocked=True)
scd2_restaurants = _two_runs("dim_restaurant", "restaurant", staging.stg_restaurant, dims.next_restaurants, clocked=True)
scd3_cuisines = _two_runs(
    "dim_restaurant_scd3", "restaurant", staging.stg_restaurant, dims.next_restaurant_cuisines, clocked=True
)
scd1_agents = _two_runs(
    "dim_delivery_agent", "delivery_agent", staging.stg_delivery_agent, dims.next_agents, clocked=False
)
scd1_promotions = _two_runs("dim_promotion", "promotion", staging.stg_promotion, dims.next_promotions, clocked=False)


def order_fact(s: SparkSession, d: str) -> DataFrame:
    return facts.fct_order_enhanced(
        staging.stg_order_header(raw(s, d, "order_header")),
        stored(s, d, "dim_date"),
        staging.stg_delivery_trip(raw(s, d, "delivery_trip")),
        staging.stg_restaurant(raw(s, d, "restaurant")),
    )


def trip_buckets(s: SparkSession, d: str) -> DataFrame:
    orders = staging.stg_order_header(raw(s, d, "order_header")).select("order_id")
    trip = trips(s, d).select("order_id", "estimated_time_min", "actual_time_min")
    bucket = sla_bucket(F.col("estimated_time_min"), F.col("actual_time_min")).alias("bucket")
    return orders.join(trip, "order_id", "left").select("*", bucket)


def masked(s: SparkSession, d: str, column: str, mask) -> DataFrame:
    return scd2_current(customers(s, d)).select(
        "customer_id", mask(F.col(column), "ANALYST").alias(column), mask(F.col(column), "PII_ADMIN").alias(f"{column}_clear")
    )


def masked_customers(s: SparkSession, d: str) -> DataFrame:
    table = apply_masks(scd2_current(customers(s, d)), {"email": mask_email, "primary_phone": mask_phone}, "ANALYST")
    return table.select(
        "customer_id", "customer_name", "email", "primary_phone", "city", "area", "segment", "is_prime_member", "status"
    )


def wide_money(s: SparkSession, d: str) -> DataFrame:
    """Amounts of thirty digits, some of them no number; as text, since a double could not show them."""
    text = F.when(F.col("order_id").endswith("3"), "n/a").otherwise(
        F.concat(F.lit("98765432109876543210"), F.lpad("order_id", 10, "0"), F.lit(".129"))
    )
    amounts = raw(s, d, "order_header").select("order_id", text.alias("amount"))
    return amounts.select(to_int("order_id"), to_money("amount").cast("string").alias("amount"))


def dirty_sentiments(s: SparkSession, d: str) -> DataFrame:
    """Scores that ingest accepts: not finite, very large, with nine decimals."""
    k = F.pmod(F.col("feedback_id").cast("bigint"), F.lit(7))
    score = F.when(k == 0, "NaN").when(k == 1, "Infinity").when(k == 2, "1e13").when(k == 3, "0.123456789")
    staged = staging.stg_feedback(raw(s, d, "customer_feedback").withColumn("sentiment_score", score.otherwise(F.col("sentiment_score"))))
    return staged.groupBy("rating", k.alias("kind")).agg(mean_of_doubles("sentiment_score").alias("avg_sentiment"), F.count("*").alias("n"))


def long_rates(s: SparkSession, d: str) -> DataFrame:
    """Commission rates of twelve decimals, and above a thousand."""
    k = F.pmod(F.col("restaurant_id").cast("bigint"), F.lit(3))
    rate = F.when(k == 0, "0.123456789123").when(k == 1, "1234.5").otherwise(F.col("commission_rate"))
    return facts.fct_order_enhanced(
        staging.stg_order_header(raw(s, d, "order_header")),
        stored(s, d, "dim_date"),
        staging.stg_delivery_trip(raw(s, d, "delivery_trip")),
        staging.stg_restaurant(raw(s, d, "restaurant").withColumn("commission_rate", rate)),
    ).select("order_id", "platform_commission", "restaurant_payout")


def batch_events(s: SparkSession, d: str) -> DataFrame:
    path = run_folder(s, "events")
    raw_text(s, d, schemas.EVENTS).write.text(path)
    return staging.stg_customer_events(read_raw_events(s, path))


def csv_feedback(s: SparkSession, d: str) -> DataFrame:
    """Feedback as CSV files whose comments hold line breaks, quotes and commas."""
    path = run_folder(s, "feedback")
    comment = F.concat(F.lit('said "'), F.col("comment"), F.lit('",\nthen left'))
    raw_text(s, d, "customer_feedback").withColumn("comment", comment).write.options(header=True, quote='"', escape='"').csv(path)
    return staging.stg_feedback(read_raw_csv(s, path, "customer_feedback", rejects="bad"))


def latest_events(s: SparkSession, d: str) -> DataFrame:
    """All events delivered once with an old device name, those with an even id again as they are."""
    text = raw_text(s, d, schemas.EVENTS).withColumnRenamed("event_raw", "value")
    old = text.withColumn("value", F.replace("value", F.lit("iOS"), F.lit("Old")))
    even = F.pmod(F.get_json_object("value", "$.event_id").cast("bigint"), F.lit(2)) == 0
    both = old.withColumn("delivery", F.lit(1)).unionByName(text.filter(even).withColumn("delivery", F.lit(2)))
    events = both.select(F.try_parse_json("value").alias("event_raw"), "delivery")
    return refresh.staged(refresh.Config("", {schemas.EVENTS: events}, latest_by={schemas.EVENTS: ["delivery"]}), schemas.EVENTS)


def overwritten(s: SparkSession, d: str) -> DataFrame:
    """A table written twice, the second time from itself; only the last version stays."""
    path = run_folder(s, "table")
    agents_ = staging.stg_delivery_agent(raw(s, d, "delivery_agent"))
    overwrite_table(agents_.select("agent_id", "city"), path)
    again = read_table(s, path)
    overwrite_table(again.withColumn("city", F.upper("city")), path, keep=1)
    return read_table(s, path)


def appended(s: SparkSession, d: str) -> DataFrame:
    path = run_folder(s, "table")
    trips_ = staging.stg_delivery_trip(raw(s, d, "delivery_trip")).select("trip_id", "order_id")
    late = F.pmod("trip_id", F.lit(2)) == 1
    append_table(trips_.filter(~late), path)
    append_table(trips_.filter(late), path)
    return s.read.parquet(path)


def run_log(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{warehouse(s, d)}/run_log").select("proc_name", "run_ts", "status")


def late_funnel(s: SparkSession, d: str) -> DataFrame:
    """The funnel fed from the enriched order row, with the events moved to the day of the customer's first order."""
    rows = order_rows(s, d)
    first = rows.filter("is_delivered = 1").groupBy("customer_id").agg(F.min("full_date").alias("day"))
    moved = (
        stored(s, d, "fct_customer_event").join(first, "customer_id").withColumn("event_ts", F.col("day").cast("timestamp_ntz")).drop("day")
    )
    return marts.city_search_to_order(moved, rows, customers(s, d))


def _staged(name: str, stage) -> Query:
    return lambda s, d: stage(raw(s, d, name))


def _seen_by(role: str) -> Query:
    return lambda s, d: apply_row_access(order_rows(s, d), role_access(s), role)


def mart_registry(s: SparkSession, d: str) -> dict[str, Callable[[], DataFrame]]:
    """The marts the explorer offers."""
    rows = lambda: order_rows(s, d)
    return {
        "order_enriched": rows,
        "restaurant_advanced_kpi": lambda: marts.restaurant_advanced_kpi(rows()),
        "agent_efficiency_kpi": lambda: marts.agent_efficiency_kpi(trips(s, d), agents(s, d)),
        "city_search_to_order": lambda: funnel(s, d),
        "restaurant_feedback_kpi": lambda: marts.restaurant_feedback_kpi(rows()),
        "customer_experience_kpi": lambda: marts.customer_experience_kpi(rows(), AS_OF),
        "agent_feedback_kpi": lambda: marts.agent_feedback_kpi(trips(s, d), agents(s, d), rows()),
        "daily_city_kpi": lambda: marts.daily_city_kpi(rows()),
    }


def _mart(name: str) -> Query:
    return lambda s, d: mart_registry(s, d)[name]()


QUERIES: dict[str, Query] = {
    # ingest and edit
    "ingest_null_tokens": lambda s, d: null_tokens(raw_text(s, d, "order_header")),
    "ingest_stream_events": ingested_events,
    "update_where": lambda s, d: update_where(
        raw_text(s, d, "delivery_agent"),
        F.col("agent_id").endswith("1"),
        {"city": F.lit("Moved"), "status": F.lit("INACTIVE")},
    ),
    "ingest_events_batch": batch_events,
    "ingest_csv_feedback": csv_feedback,
    "events_latest": latest_events,
    "table_overwrite": overwritten,
    "table_append": appended,
    "run_log": run_log,
    "refresh_incremental": lambda s, d: refresh.table(s, changed_warehouse(s, d), "fct_order_secure").select(*schemas.ENRICHED_COLUMNS),
    "refresh_incremental_trips": lambda s, d: refresh.table(s, changed_warehouse(s, d), "fct_delivery"),
    "refresh_incremental_feedback": lambda s, d: refresh.table(s, changed_warehouse(s, d), "fct_feedback"),
    "refresh_incremental_events": lambda s, d: refresh.table(s, changed_warehouse(s, d), "fct_customer_event"),
    "refresh_incremental_promotions": lambda s, d: refresh.table(s, changed_warehouse(s, d), "dim_promotion"),
    # staging
    "stg_money_wide": wide_money,
    "dirty_sentiment_kpi": dirty_sentiments,
    "commission_long_rate": long_rates,
    "flag_normalise": lambda s, d: raw_text(s, d, "customer").select(
        to_int("customer_id"), F.col("is_prime_member").alias("raw_flag"), to_flag("is_prime_member")
    ),
    "stg_customer": _staged("customer", staging.stg_customer),
    "stg_restaurant": _staged("restaurant", staging.stg_restaurant),
    "stg_delivery_agent": _staged("delivery_agent", staging.stg_delivery_agent),
    "stg_menu_item": _staged("menu_item", staging.stg_menu_item),
    "stg_promotion": _staged("promotion", staging.stg_promotion),
    "stg_order_header": _staged("order_header", staging.stg_order_header),
    "stg_order_item": _staged("order_item", staging.stg_order_item),
    "stg_delivery_trip": _staged("delivery_trip", staging.stg_delivery_trip),
    "stg_payment": _staged("payment", staging.stg_payment),
    "stg_feedback": _staged("customer_feedback", staging.stg_feedback),
    "stg_customer_events": _staged(schemas.EVENTS, staging.stg_customer_events),
    # dimensions and facts
    "dim_date": order_calendar,
    "scd2_customer": _judged_keys(scd2_customers, "customer_sk"),
    "scd2_restaurant": _judged_keys(scd2_restaurants, "restaurant_sk"),
    "scd2_history": lambda s, d: scd2_history(scd2_customers(s, d), "customer_id").select(
        "customer_id", "customer_name", "city", "segment", "effective_from", "effective_to", "is_current"
    ),
    "scd3_restaurant_cuisine": scd3_cuisines,
    "scd1_delivery_agent": scd1_agents,
    "scd1_promotion": scd1_promotions,
    "fct_order_enhanced": order_fact,
    "fct_delivery": lambda s, d: facts.fct_delivery(staging.stg_delivery_trip(raw(s, d, "delivery_trip"))),
    "fct_feedback": lambda s, d: facts.fct_feedback(staging.stg_feedback(raw(s, d, "customer_feedback"))),
    "fct_customer_event": lambda s, d: facts.fct_customer_event(staging.stg_customer_events(raw(s, d, schemas.EVENTS))),
    # policies
    "mask_email": lambda s, d: masked(s, d, "email", mask_email),
    "mask_phone": lambda s, d: masked(s, d, "primary_phone", mask_phone),
    "masked_customers": masked_customers,
    "rls_city": _seen_by("CITY_A"),
    "rls_restaurant": _seen_by("REST_3"),
    "rls_unmapped": _seen_by("NOBODY"),
    "rls_admin": _seen_by("ADMIN"),
    "fct_order_secure": lambda s, d: facts.fct_order_secure(secure(s, d)),
    "sla_bucket": trip_buckets,
    # marts
    "order_enriched": lambda s, d: enriched_orders(s, warehouse(s, d)),
    **{name: _mart(name) for name in (
        "restaurant_advanced_kpi",
        "agent_efficiency_kpi",
        "city_search_to_order",
        "restaurant_feedback_kpi",
        "customer_experience_kpi",
        "agent_feedback_kpi",
        "daily_city_kpi",
    )},
    "city_search_to_order_enriched": late_funnel,
    "daily_city_kpi_stream": streamed_city_days,
    "daily_city_late_feedback": late_feedback_days,
    # analysis
    "q1_city_kpi": lambda s, d: analysis.city_kpi(order_rows(s, d)),
    "q2_top_restaurants": lambda s, d: analysis.top_restaurants(order_rows(s, d)),
    "q3_problem_restaurants": lambda s, d: analysis.problem_restaurants(order_rows(s, d)),
    "q4_cuisine_city": lambda s, d: analysis.cuisine_by_city(order_rows(s, d)),
    "q5_segment_kpi": lambda s, d: analysis.segment_kpi(order_rows(s, d)),
    "q6_prime_kpi": lambda s, d: analysis.prime_kpi(order_rows(s, d), customers(s, d)),
    "q7_agent_perf": lambda s, d: analysis.agent_perf(trips(s, d), agents(s, d)),
    "q8_feedback_dist": lambda s, d: analysis.feedback_dist(stored(s, d, "fct_feedback"), order_rows(s, d)),
    "q9_commission_city": lambda s, d: analysis.commission_by_city(order_rows(s, d)),
    "q10_secure_restaurants": lambda s, d: analysis.secure_restaurants(secure(s, d), role_access(s), "CITY_A"),
    "secure_order_counts": lambda s, d: analysis.secure_order_counts(secure(s, d)),
    # dashboard
    "dash_date_bounds": lambda s, d: dashboard.date_bounds(secure(s, d)),
    "dash_cities": lambda s, d: dashboard.cities(secure(s, d)),
    "dash_cuisines": lambda s, d: dashboard.cuisines(secure(s, d)),
    "dash_filtered": lambda s, d: dashboard.filters(secure(s, d), SOME_PLACES).select(*schemas.ENRICHED_COLUMNS),
    "dash_overview": lambda s, d: dashboard.overview(secure(s, d), SOME_PLACES),
    "dash_daily": lambda s, d: dashboard.daily(secure(s, d), SOME_PLACES),
    "dash_restaurants": lambda s, d: dashboard.restaurants(secure(s, d), ALL_PLACES),
    "dash_top15_restaurants": lambda s, d: dashboard.restaurants(secure(s, d), ALL_PLACES, 15),
    "dash_cuisine_kpi": lambda s, d: dashboard.cuisine_kpi(secure(s, d), ALL_PLACES),
    "dash_city_funnel": lambda s, d: dashboard.city_funnel(funnel(s, d), date(2024, 1, 5), date(2024, 1, 20)),
    "dash_agents": lambda s, d: dashboard.agents(_mart("agent_efficiency_kpi")(s, d)),
    "dash_top10_agents": lambda s, d: dashboard.agents(_mart("agent_efficiency_kpi")(s, d), 10),
    "dash_order_detail": lambda s, d: dashboard.order_detail(secure(s, d), SOME_PLACES),
    "dash_explore": lambda s, d: dashboard.explore(mart_registry(s, d), "restaurant_feedback_kpi", SOME_PLACES),
}


def queries() -> dict[str, Query]:
    return {name: (lambda s, d, q=q: comparable(q(s, d))) for name, q in QUERIES.items()}

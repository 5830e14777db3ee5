"""Ordered refresh of a warehouse folder: calendar, dimensions, facts, secure order table, each step logged."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin import schemas
from tiffin.functions.clean import to_int
from tiffin.operators import dims, facts, staging
from tiffin.operators.calendar import dim_date
from tiffin.operators.scd import latest_per_key
from tiffin.plans.dashboard import MONTH
from tiffin.plans.enriched import order_enriched
from tiffin.schemas import RUN_LOG
from tiffin.sources.tables import advance_history, append_table, from_rows, overwrite_table, read_table, upkeep_by_bucket


@dataclass(frozen=True)
class Config:
    """Where the warehouse lives, and the raw tables by name (all-text; events as one VARIANT column).

    Raw tables only grow, so a key may have been delivered again. ``latest_by`` names, per raw table, the columns that
    order its deliveries, such as the ingest time; the last one is kept. Without it, a repeated key fails a dimension.

    A second trip or feedback of an order would multiply it in the facts; ``one_per_order`` makes the step fail instead.
    ``keep`` is the number of versions of each table that stay on disk; by default all do.
    """

    root: str
    raw: Mapping[str, DataFrame]
    calendar_start: date = date(2019, 1, 1)
    calendar_end: date = date(2028, 12, 31)
    money_scale: int = 2
    latest_by: Mapping[str, Sequence[str]] = field(default_factory=dict)
    one_per_order: bool = True
    keep: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def log_path(self) -> str:
        return self.path("run_log")


DIM_SCHEMAS = {
    "dim_customer": schemas.DIM_CUSTOMER,
    "dim_restaurant": schemas.DIM_RESTAURANT,
    "dim_restaurant_scd3": schemas.DIM_RESTAURANT_SCD3,
    "dim_delivery_agent": schemas.DIM_DELIVERY_AGENT,
    "dim_promotion": schemas.DIM_PROMOTION,
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table as last published; a dimension not loaded yet is empty."""
    return read_table(spark, f"{root}/{name}", schema=DIM_SCHEMAS.get(name))


#: Keys of the dimensions without version history.
DIM_KEYS = {"dim_restaurant_scd3": "restaurant_id", "dim_delivery_agent": "agent_id", "dim_promotion": "promo_id"}


def store_dimension(
    spark: SparkSession,
    root: str,
    name: str,
    advance: Callable[[DataFrame], DataFrame],
    keep: int | None = None,
    delivered: DataFrame | None = None,
    buckets: int = 64,
) -> None:
    """Store the next state of a dimension. Of one with version history, closed versions stay where they are. With ``delivered``, the source
    rows of this run, other dimensions are kept in folders by key, of which only those that the delivered keys fall in are written."""
    path = f"{root}/{name}"
    if "is_current" in DIM_SCHEMAS[name]:
        advance_history(spark, path, DIM_SCHEMAS[name], advance, keep=keep)
    elif delivered is not None:
        upkeep_by_bucket(spark, path, DIM_SCHEMAS[name], DIM_KEYS[name], delivered, advance, buckets=buckets, keep=keep)
    else:
        overwrite_table(advance(table(spark, root, name)), path, keep=keep)


def enriched_orders(spark: SparkSession, root: str) -> DataFrame:
    """The enriched order row, joined on read from the stored tables."""
    names = ["fct_order_enhanced", "dim_date", "dim_customer", "dim_restaurant", "fct_delivery", "fct_feedback"]
    return order_enriched(*[table(spark, root, n) for n in names])


def by_month(secure: DataFrame) -> DataFrame:
    """Lay the secure table out by month for date filters. The rebalance splits a heavy month and merges light ones."""
    month = (F.year("full_date") * 100 + F.month("full_date")).alias(MONTH)
    return secure.select("*", month).hint("rebalance", MONTH)


# What a step reads: it is skipped if one of these has failed.
NEEDS = {
    "fct_order_enhanced": ("dim_date", "dim_restaurant"),
    "fct_order_secure": ("dim_date", "dim_customer", "dim_restaurant", "fct_order_enhanced", "fct_delivery", "fct_feedback"),
}

LogRow = tuple[str, datetime, str, str]


def attempt(name: str, step: Callable[[], object], run_ts: datetime) -> LogRow:
    """Run a step. An error is reported, not raised; the step has then published nothing."""
    try:
        note = step()
        return name, run_ts, "SUCCESS", f"{name} loaded" + (f", {note}" if isinstance(note, str) else "")
    except Exception as err:  # the log is the place to look for it
        return name, run_ts, "ERROR", str(err)


def log_runs(spark: SparkSession, rows: Sequence[LogRow], log_path: str) -> None:
    append_table(from_rows(spark, rows, RUN_LOG).coalesce(1), log_path)


def run_step(spark: SparkSession, name: str, step: Callable[[], object], log_path: str, run_ts: datetime) -> str:
    """Run one step, log one row and return the status."""
    row = attempt(name, step, run_ts)
    log_runs(spark, [row], log_path)
    return row[2]


def check_keys(src: DataFrame, key: str) -> str:
    """Refuse a dimension source with repeated keys, whose next version would be undefined, and report NULL keys."""
    no_key = F.col(key).isNull()
    found = (
        src.groupBy(key)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.max(F.when(~no_key, F.col("copies"))).alias("most_copies"),
            F.coalesce(F.sum(F.when(no_key, F.col("copies"))), F.lit(0)).alias("without_key"),
        )
        .first()
    )
    if (found.most_copies or 0) > 1:
        raise ValueError(f"{key} occurs up to {found.most_copies} times in the source")
    return f"{found.without_key} source rows without {key} left out"


# Raw tables behind the refresh: staging step and key.
SOURCES: dict[str, tuple[Callable[..., DataFrame], str]] = {
    "customer": (staging.stg_customer, "customer_id"),
    "restaurant": (staging.stg_restaurant, "restaurant_id"),
    "delivery_agent": (staging.stg_delivery_agent, "agent_id"),
    "promotion": (staging.stg_promotion, "promo_id"),
    "order_header": (staging.stg_order_header, "order_id"),
    "delivery_trip": (staging.stg_delivery_trip, "trip_id"),
    "customer_feedback": (staging.stg_feedback, "feedback_id"),
    schemas.EVENTS: (staging.stg_customer_events, "event_id"),
}
WITH_MONEY = {"promotion", "order_header"}
FACT_SOURCES = ("order_header", "delivery_trip", "customer_feedback", schemas.EVENTS)


def staged(cfg: Config, name: str) -> DataFrame:
    (stage, key), raw, order_by = SOURCES[name], cfg.raw[name], cfg.latest_by.get(name)

    def typed(rows: DataFrame) -> DataFrame:
        return stage(rows, cfg.money_scale) if name in WITH_MONEY else stage(rows)

    if not order_by:
        return typed(raw)
    if set(order_by) <= set(typed(raw).columns):
        return latest_per_key(typed(raw), key, order_by)
    # Ordered by columns that staging drops, such as the ingest time: the key is taken from the raw row.
    raw_key = F.try_variant_get("event_raw", "$.event_id", "bigint") if name == schemas.EVENTS else to_int(key)
    return typed(latest_per_key(raw, raw_key, order_by))


def refresh_all(spark: SparkSession, cfg: Config, as_of: datetime) -> dict[str, str]:
    """Refresh every table once: dimensions, then facts, then the secure order table. Returns the status of each step.

    Steps of one stage do not depend on each other and are submitted together, so that the tail of one does not leave
    the cluster idle. A raw table is typed and stored once, those of the facts while the dimensions load; checks and the other steps read
    what is stored, a check no more than its column. A table that could not be typed is tried again by the step that needs it, which reports it. A step whose inputs failed is logged as SKIPPED. Each stage is logged as it ends. The
    clock is an argument: both halves of a version change carry the same time.
    """
    locks = {name: Lock() for name in SOURCES}
    ready: dict[str, DataFrame] = {}

    def source_rows(name: str) -> DataFrame:
        with locks[name]:
            if name not in ready:
                overwrite_table(staged(cfg, name), cfg.path(f"staging/{name}"), keep=1)
                ready[name] = table(spark, cfg.root, f"staging/{name}")
        return ready[name]

    def only_one(name: str) -> DataFrame:
        rows = source_rows(name)
        if cfg.one_per_order:
            check_keys(rows.select("order_id"), "order_id")
        return rows

    def stored(name: str) -> DataFrame:
        return table(spark, cfg.root, name)

    def save(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        overwrite_table(df, cfg.path(name), partition_by=partition_by, keep=cfg.keep)

    def dimension(name: str, source: str, advance: Callable[..., DataFrame], *args: object) -> Callable[[], str]:
        def step() -> str:
            src = source_rows(source)
            note = check_keys(src, SOURCES[source][1])
            store_dimension(spark, cfg.root, name, lambda dim: advance(dim, src, *args), cfg.keep)
            return note

        return step

    def order_fact() -> DataFrame:
        orders, trips, restaurants = source_rows("order_header"), only_one("delivery_trip"), source_rows("restaurant")
        return facts.fct_order_enhanced(orders, stored("dim_date"), trips, restaurants)

    stages: list[dict[str, Callable[[], object]]] = [
        {
            "dim_date": lambda: save("dim_date", dim_date(spark, cfg.calendar_start, cfg.calendar_end)),
            "dim_customer": dimension("dim_customer", "customer", dims.next_customers, as_of),
            "dim_restaurant": dimension("dim_restaurant", "restaurant", dims.next_restaurants, as_of),
            "dim_restaurant_scd3": dimension("dim_restaurant_scd3", "restaurant", dims.next_restaurant_cuisines, as_of),
            "dim_delivery_agent": dimension("dim_delivery_agent", "delivery_agent", dims.next_agents),
            "dim_promotion": dimension("dim_promotion", "promotion", dims.next_promotions),
        },
        {
            "fct_order_enhanced": lambda: save("fct_order_enhanced", order_fact()),
            "fct_delivery": lambda: save("fct_delivery", facts.fct_delivery(source_rows("delivery_trip"))),
            "fct_feedback": lambda: save("fct_feedback", facts.fct_feedback(only_one("customer_feedback"))),
            "fct_customer_event": lambda: save("fct_customer_event", facts.fct_customer_event(source_rows(schemas.EVENTS))),
        },
        {
            "fct_order_secure": lambda: save(
                "fct_order_secure", by_month(facts.fct_order_secure(enriched_orders(spark, cfg.root))), (MONTH,)
            ),
        },
    ]
    with ThreadPoolExecutor(max_workers=len(FACT_SOURCES)) as early:
        for name in FACT_SOURCES:
            early.submit(inheritable_thread_target(spark)(source_rows), name)
        return run_stages(spark, stages, as_of, cfg.log_path)


def run_stages(spark: SparkSession, stages: Sequence[Mapping[str, Callable[[], object]]], as_of: datetime, log_path: str) -> dict[str, str]:
    """Run stages one after the other, the steps of each together, and log each stage as it ends. Returns the status of each step."""
    status: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=max(len(s) for s in stages)) as pool:
        for steps in stages:
            log, runs = [], []
            for name, step in steps.items():
                failed = [n for n in NEEDS.get(name, ()) if status.get(n, "SUCCESS") != "SUCCESS"]
                if failed:
                    log.append((name, as_of, "SKIPPED", f"{name} waits for {', '.join(failed)}"))
                else:
                    runs.append(pool.submit(inheritable_thread_target(spark)(attempt), name, step, as_of))
            log += [run.result() for run in runs]
            log_runs(spark, log, log_path)
            status |= {name: state for name, _, state, _ in log}
    return status

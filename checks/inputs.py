"""Raw inputs as Spark DataFrames, and a warehouse refreshed from them once per application and input folder."""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from checks.raw_inputs import MOVED, ORDER_BASE, RAW_SQL, rename_tables
from tiffin import schemas
from tiffin.operators.edit import update_where
from tiffin.plans.incremental import refresh_changed
from tiffin.plans.refresh import Config, refresh_all, table
from tiffin.session import freed_shuffles, shared_folder
from tiffin.sources.raw import null_tokens, parse_events
from tiffin.sources.tables import CODEC, append_table, from_rows

FIRST_RUN = datetime(2024, 6, 1)
SECOND_RUN = datetime(2024, 6, 2)
AS_OF = date(2024, 6, 1)
CALENDAR = (date(1995, 1, 1), date(2028, 12, 31))

# The role table of the test scenario.
ROLES = [("CITY_A", "CITY", "NATION_0", None), ("CITY_B", "CITY", "NATION_1", None)] + [
    ("REST_3", "RESTAURANT", None, 3),
    ("REST_7", "RESTAURANT", None, 7),
]

_warehouses: dict[tuple, str] = {}


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the shared folder."""
    return f"{shared_folder(spark)}/tiffin-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def raw_sql(spark: SparkSession, sf_dir: str, sql: str, order_base: str | None = None) -> DataFrame:
    """The text over temporary views of the test tables, named after the folder they come from."""

    def view_of(name: str) -> str:
        path = order_base if name == "order_base" else f"{sf_dir}/{name}.parquet"
        view = "input_" + re.sub(r"\W", "_", path)
        if not spark.catalog.tableExists(view):
            spark.read.parquet(path).createOrReplaceTempView(view)
        return view

    return spark.sql(rename_tables(sql, view_of))


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the input files: a changed input gets a new warehouse."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def order_base(spark: SparkSession, sf_dir: str) -> str:
    """Orders with their suppliers, stored: four raw inputs derive from it, which would each read all line items."""
    key = ("order_base", spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _warehouses:
        path = run_folder(spark, "order_base")
        with freed_shuffles(spark):
            raw_sql(spark, sf_dir, ORDER_BASE).write.parquet(path, compression=CODEC)
        _warehouses[key] = path
    return _warehouses[key]


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw input as ingest leaves it: NULL tokens applied, events parsed."""
    text = raw_text(spark, sf_dir, name)
    return parse_events(text.withColumnRenamed("event_raw", "value")) if name == schemas.EVENTS else null_tokens(text)


def raw_text(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw input as it stands in the landing file."""
    sql = RAW_SQL[name]
    return raw_sql(spark, sf_dir, sql, order_base(spark, sf_dir) if "$order_base" in sql else None)


def deliveries(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of a dimension input: new keys and changed rows come with the second."""
    key, changes = MOVED[name]
    everything = raw(spark, sf_dir, name)
    first = everything.filter(~F.col(key).endswith("9"))
    second = update_where(everything, F.col(key).endswith("5"), {c: F.expr(v) for c, v in changes.items()})
    return first, second


def role_access(spark: SparkSession) -> DataFrame:
    return from_rows(spark, ROLES, schemas.ROLE_ACCESS)


def warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Root of the refreshed warehouse for an input folder."""
    key = ("warehouse", spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _warehouses:
        names = [*schemas.RAW_COLUMNS, schemas.EVENTS]
        cfg = Config(
            root=run_folder(spark, "warehouse"),
            raw={n: raw(spark, sf_dir, n) for n in names},
            calendar_start=CALENDAR[0],
            calendar_end=CALENDAR[1],
        )
        status = refresh_all(spark, cfg, FIRST_RUN)
        if set(status.values()) != {"SUCCESS"}:
            log = spark.read.parquet(cfg.log_path).filter("status = 'ERROR'").collect()
            raise RuntimeError(f"refresh failed: {[(r.proc_name, r.message[:500]) for r in log]}")
        _warehouses[key] = cfg.root
    return _warehouses[key]


STAMP = "delivered"


def _first_and_second(name: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of a raw table that end in its rows: a part of them first, some in an older state, then the rest and the changed ones."""
    key = rows.columns[0]
    part = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns[:2]]), F.lit(8)) if name != schemas.EVENTS else F.pmod(
        F.xxhash64(F.to_json("event_raw")), F.lit(8)
    )
    old, late = part == 0, part >= (3 if name == "delivery_trip" else 6)
    # What the first delivery had wrong. An order that was filed under another month moves when it is corrected.
    wrong = {
        "customer": {"city": F.lit("Elsewhere"), "segment": F.lit("Gone")},
        "restaurant": {"commission_rate": F.lit("0.5"), "cuisine_primary": F.lit("Old")},
        "delivery_agent": {"city": F.lit("Elsewhere")},
        "promotion": {"target_city": F.lit("Elsewhere")},
        "order_header": {
            "order_status": F.lit("placed"),
            "order_created_at": F.when(F.crc32(F.col(key).cast("binary")) % 3 == 0, F.expr("string(cast(order_created_at as timestamp_ntz) - interval 50 days)")).otherwise(
                F.col("order_created_at")
            ),
        },
        "delivery_trip": {"sla_breach_flag": F.lit("1"), "distance_km": F.lit("9")},
        "customer_feedback": {"rating": F.lit("1")},
    }.get(name, {})
    marked = rows.withColumns({"_old": old, "_late": late})
    first = marked.filter("not _late")
    first = first.withColumns({c: F.when(F.col("_old"), v).otherwise(F.col(c)) for c, v in wrong.items()})
    return first.drop("_old", "_late"), marked.filter("_late or _old").drop("_old", "_late")


def changed_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Root of a warehouse that was refreshed by change, after a first and after a second delivery."""
    key = ("changed", spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _warehouses:
        folder = run_folder(spark, "changed")
        names = [*schemas.RAW_COLUMNS, schemas.EVENTS]
        waves = {n: _first_and_second(n, raw(spark, sf_dir, n)) for n in names}
        columns = {n: StructType([*waves[n][0].schema.fields, StructField(STAMP, IntegerType())]) for n in names}
        for number, when in enumerate((FIRST_RUN, SECOND_RUN)):
            for n in names:
                append_table(waves[n][number].withColumn(STAMP, F.lit(number)), f"{folder}/raw/{n}")
            cfg = Config(
                root=f"{folder}/warehouse",
                raw={n: spark.read.schema(columns[n]).parquet(f"{folder}/raw/{n}") for n in names},
                calendar_start=CALENDAR[0],
                calendar_end=CALENDAR[1],
            )
            status = refresh_changed(spark, cfg, when, STAMP, buckets=4)
            if set(status.values()) != {"SUCCESS"}:
                log = spark.read.parquet(cfg.log_path).filter("status = 'ERROR'").collect()
                raise RuntimeError(f"refresh failed: {[(r.proc_name, r.message[:500]) for r in log]}")
        _warehouses[key] = cfg.root
    return _warehouses[key]


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, warehouse(spark, sf_dir), name)

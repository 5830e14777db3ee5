"""What the physical plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.inputs import role_access, stored
from checks.registry import QUERIES, SOME_PLACES, order_rows, secure
from tiffin.operators.access import apply_row_access
from tiffin.operators.facts import fct_order_enhanced
from tiffin.plans import analysis, dashboard, marts
from tiffin.plans.enriched import order_enriched
from tiffin.plans.refresh import by_month
from tiffin.sources.tables import overwrite_table, read_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    before = {}

    def put(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_dashboard_filter_prunes_months_rows_and_columns(spark):
    text = plan(dashboard.daily(secure(spark, SF_DIR), SOME_PLACES))
    assert re.search(r"PartitionFilters: \[.*order_month.* >= 199601.*order_month.* <= 199906", text)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(full_date,1996-01-01\).*In\(restaurant_city", text)
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",") if ":" in c} == {
        "full_date", "total_amount", "is_delivered", "restaurant_city", "cuisine_primary",
    }


def test_row_rules_use_equi_joins(spark):
    text = plan(apply_row_access(order_rows(spark, SF_DIR), role_access(spark), "REST_3"))
    assert "HashJoin" in text or "SortMergeJoin" in text
    assert "NestedLoop" not in text


@pytest.mark.parametrize("kpi", ["agent_efficiency_kpi", "agent_feedback_kpi", "dash_top10_agents", "q7_agent_perf"])
def test_agent_figures_do_not_multiply_trips(spark, kpi):
    assert "Expand" not in plan(QUERIES[kpi](spark, SF_DIR))


def test_calendar_is_broadcast_by_its_size(spark, conf):
    orders, dates, trips, places = (stored(spark, SF_DIR, n) for n in ("fct_order_enhanced", "dim_date", "fct_delivery", "dim_restaurant"))
    dated = orders.drop("order_date_key").withColumns({c: F.current_timestamp().cast("timestamp_ntz") for c in ("order_created_at", "actual_delivery_at")})
    fact = fct_order_enhanced(dated, dates, trips, places)
    assert "BroadcastHashJoin" in plan(fact)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" not in plan(fct_order_enhanced(dated, dates, trips, places))


def test_top_n_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(analysis.top_restaurants(order_rows(spark, SF_DIR)))


def test_rolling_windows_share_one_shuffle_of_daily_rows(spark):
    text = plan(marts.restaurant_advanced_kpi(order_rows(spark, SF_DIR)))
    # one for the daily aggregate, one for both window stages
    assert len(set(re.findall(r"\((\d+)\) Exchange", text))) == 2


def test_agent_join_comes_after_aggregation(spark):
    text = plan(marts.agent_efficiency_kpi(stored(spark, SF_DIR, "fct_delivery"), stored(spark, SF_DIR, "dim_delivery_agent")))
    tree = text[: text.index("(1)")] if "(1) " in text else text
    join = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    aggregate = next(i for i, line in enumerate(text.splitlines()) if "HashAggregate" in line)
    assert join < aggregate, tree  # the tree is printed from the result down


def test_orders_without_an_id_bypass_the_joins_on_it(spark, conf):
    """A third of the orders has no id. All are kept, and none of them is shuffled by the id they lack."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders = stored(spark, SF_DIR, "fct_order_enhanced")
    nameless = orders.withColumn("order_id", F.when(F.col("order_id") % 3 > 0, F.col("order_id")))
    others = [stored(spark, SF_DIR, n) for n in ("dim_date", "dim_customer", "dim_restaurant", "fct_delivery", "fct_feedback")]
    got = order_enriched(nameless, *others)
    assert got.count() == orders.count()
    want = order_rows(spark, SF_DIR).filter("order_id % 3 > 0")
    assert sorted(map(tuple, got.filter("order_id is not null").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    lost = got.filter("order_id is null")
    assert lost.filter("rating is not null or sla_breach_flag is not null").count() == 0
    assert lost.filter("restaurant_city is not null").count() > 0
    simple = got._jdf.queryExecution().executedPlan().toString().splitlines()
    left = next(i for i, line in enumerate(simple) if "hashpartitioning(order_id" in line)
    assert any("isnotnull(CASE" in line or "isnotnull(order_id" in line for line in simple[left : left + 4])


def test_a_heavy_month_is_written_by_many_tasks(spark, conf, work):
    """The month layout neither funnels a month through one task nor scatters each month over all tasks."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.shuffle.partitions", "200")
    ids = spark.range(0, 60_000, 1, 16)
    heavy = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 30)
    df = ids.select(
        "id", F.add_months(F.lit("2024-01-15").cast("date"), heavy.cast("int")).alias("full_date"), F.sha2(F.col("id").cast("string"), 256).alias("t")
    )
    overwrite_table(by_month(df), f"{work}/t", partition_by=(dashboard.MONTH,))
    files = [f.parent.name for f in Path(work).rglob("*.parquet")]
    per_month = {m: files.count(m) for m in files}
    heavy_files = per_month.pop(f"{dashboard.MONTH}=202401")
    assert heavy_files > 4, per_month
    assert len(per_month) == 20 and max(per_month.values()) < heavy_files
    back = read_table(spark, f"{work}/t")
    assert (back.count(), back.select("id").distinct().count()) == (60_000, 60_000)


def test_a_hot_restaurant_is_split(spark, rows, conf):
    """A third of all orders at one restaurant, and a restaurant table too big to broadcast: the join splits the hot key."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }.items():
        conf(key, value)
    n = 60_000
    ids = spark.range(0, n, 1, 16)
    orders = ids.select(
        F.col("id").alias("order_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997).cast("bigint").alias("restaurant_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 80000)").alias("order_created_at"),
        F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(0, 0, 0, id % 80000)").alias("actual_delivery_at"),
        F.lit("DELIVERED").alias("order_status"),
        F.sha2(F.col("id").cast("string"), 256).alias("payment_method"),
        F.lit(None).cast("bigint").alias("promo_id"),
        *[F.lit(10).cast("decimal(18,2)").alias(c) for c in ("order_subtotal", "order_discount", "delivery_fee", "total_amount")],
    )
    trips = ids.select(F.col("id").alias("order_id"), F.lit(1).cast("bigint").alias("sla_breach_flag"))
    restaurants = spark.range(997).select(F.col("id").alias("restaurant_id"), F.lit(0.2).alias("commission_rate"))
    dates = rows([(20240101,)], "date_key bigint").withColumn("full_date", F.to_date(F.lit("2024-01-01")))
    fact = fct_order_enhanced(orders, dates, trips, restaurants)
    totals = fact.agg(F.count("*").alias("n"), F.sum("platform_commission").alias("c"), F.max("payment_method"), F.sum("end_to_end_min"))
    text = final_plan(totals)
    assert "skew=true" in text
    assert (totals.first().n, float(totals.first().c)) == (n, n * 2.0)

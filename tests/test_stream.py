"""The daily city table as a stream: whatever the order of arrival, it ends where the batch mart does."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin import schemas
from tiffin.sources.tables import empty
from tiffin.streaming.daily_city import PERIOD, city_store, daily_city_kpi_stream, land, land_orders, period_figures, read_daily_city_kpi

ORDER = (
    "order_id bigint, customer_id bigint, restaurant_id bigint, order_created_at timestamp_ntz, order_status string, payment_method string,"
    " promo_id bigint, order_subtotal decimal(38,2), order_discount decimal(38,2), delivery_fee decimal(38,2), total_amount decimal(38,2),"
    " expected_delivery_at timestamp_ntz, actual_delivery_at timestamp_ntz, cancellation_reason string, delivery int"
)
TRIP = (
    "trip_id bigint, order_id bigint, agent_id bigint, pickup_time timestamp_ntz, drop_time timestamp_ntz, distance_km double,"
    " estimated_time_min bigint, actual_time_min bigint, sla_breach_flag bigint, delivery int"
)
FEEDBACK = (
    "feedback_id bigint, order_id bigint, customer_id bigint, rating bigint, comment string, sentiment_score double,"
    " created_at timestamp_ntz, delivery int"
)
KINDS = {"orders": ORDER, "trips": TRIP, "feedback": FEEDBACK}
D1, D2 = datetime(2024, 3, 1, 12), datetime(2024, 3, 2, 9)


def order(key, when=D1, status="DELIVERED", amount=10, delivery=1):
    money, none = Decimal(amount), Decimal(0)
    return (key, 1, 10, when, status, "CASH", None, money, none, none, money, None, None, None, delivery)


def trip(key, order_id, late=0, delivery=1):
    return (key, order_id, 5, D1, D1, 1.0, 20, 20, late, delivery)


def feedback(key, order_id, rating, delivery=1):
    return (key, order_id, 1, rating, "c", 0.5, D1, delivery)


@pytest.fixture
def city(spark, rows, work):
    """Land rows, run the stream over what is new, and read the table."""
    dates = rows([(20240300 + d, date(2024, 3, d)) for d in range(1, 4)], "date_key bigint, full_date date")
    customers = empty(spark, schemas.DIM_CUSTOMER).unionByName(
        rows([(1, "Delhi", True)], "customer_id bigint, city string, is_current boolean"), allowMissingColumns=True
    )
    places = empty(spark, schemas.DIM_RESTAURANT).unionByName(
        rows([(10, "Pune", True, 0.2)], "restaurant_id bigint, city string, is_current boolean, commission_rate double"), allowMissingColumns=True
    )
    landing = {n: f"{work}/{n}" for n in KINDS}
    typed = {n: empty(spark, k).schema for n, k in KINDS.items()}
    typed["orders"] = typed["orders"].add(PERIOD, "date")

    def run(grain="day", checkpoint="checkpoint", **landed):
        for name in KINDS:
            df = rows(landed.get(name, []), KINDS[name])
            land_orders(df, landing[name], grain) if name == "orders" else land(df, landing[name])
        daily_city_kpi_stream(
            spark,
            landing,
            f"{work}/out",
            f"{work}/{checkpoint}",
            schemas=typed,
            dimensions=lambda: (dates, customers, places),
            latest_by=["delivery"],
            grain=grain,
        ).awaitTermination()
        got = read_daily_city_kpi(spark, f"{work}/out").orderBy("full_date").collect()
        return [(r.full_date and r.full_date.day, r.total_orders, float(r.gmv), r.delivered_orders, r.avg_rating, r.avg_sla_breach_rate) for r in got]

    return run


def test_a_change_of_status_a_late_trip_and_a_late_rating(city):
    assert city(orders=[order(1, status="PLACED"), order(-2, D2)]) == [(1, 1, 10.0, 0, None, None), (2, 1, 10.0, 1, None, None)]
    assert city(orders=[order(1, amount=12, delivery=2)], trips=[trip(7, 1, late=1)]) == [(1, 1, 12.0, 1, None, 1.0), (2, 1, 10.0, 1, None, None)]
    assert city(feedback=[feedback(3, 1, 4), feedback(4, -2, 2)]) == [(1, 1, 12.0, 1, 4.0, 1.0), (2, 1, 10.0, 1, 2.0, None)]
    assert city(feedback=[feedback(3, 1, 5, delivery=2)])[0] == (1, 1, 12.0, 1, 5.0, 1.0)


def test_repeated_deliveries_replays_and_orders_without_an_id(city):
    rows = [order(1), order(None), order(None), order(2, D2)]
    want = [(1, 3, 30.0, 3, None, None), (2, 1, 10.0, 1, None, None)]
    assert city(orders=rows) == want
    assert city(orders=[order(1, delivery=2), order(2, D2, delivery=2)]) == want
    # A checkpoint that is lost replays everything.
    assert city(checkpoint="another") == want


def test_an_order_that_moves_leaves_its_old_day(city):
    assert city(orders=[order(1), order(5, None)]) == [(None, 1, 10.0, 1, None, None), (1, 1, 10.0, 1, None, None)]
    assert city(orders=[order(1, D2, delivery=2)]) == [(None, 1, 10.0, 1, None, None), (2, 1, 10.0, 1, None, None)]


def test_months_as_periods(city):
    assert city("month", orders=[order(1), order(2, D2)]) == [(1, 1, 10.0, 1, None, None), (2, 1, 10.0, 1, None, None)]
    assert city("month", feedback=[feedback(1, 2, 3)]) == [(1, 1, 10.0, 1, None, None), (2, 1, 10.0, 1, 3.0, None)]


def test_a_batch_reads_only_the_folders_it_touches(city, spark, work, rows):
    city(orders=[order(i, datetime(2024, 3, 1 + i % 3, 12)) for i in range(9)], trips=[trip(i, i) for i in range(9)], feedback=[feedback(i, i, 3) for i in range(9)])
    typed = {n: empty(spark, k).schema for n, k in KINDS.items()}
    typed["orders"] = typed["orders"].add(PERIOD, "date")
    dims = (
        rows([(20240301, date(2024, 3, 1))], "date_key bigint, full_date date"),
        empty(spark, schemas.DIM_CUSTOMER),
        empty(spark, schemas.DIM_RESTAURANT),
    )
    figures = period_figures(city_store(f"{work}/out_state", typed, ["delivery"]), spark, ["2024-03-02"], *dims)
    assert {re.search("place=([^/]*)", f).group(1) for f in figures.inputFiles()} == {"2024-03-02"}
    plan = figures._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("FileScan parquet")
    assert 0 < scans < 30
    assert len(re.findall(r"PartitionFilters: \[[^\]]*place", plan)) == scans


def test_nothing_landed_yet(spark, work):
    assert read_daily_city_kpi(spark, f"{work}/none").collect() == []


def test_reads_of_one_day_prune_the_folders(city, spark, work):
    city(orders=[order(1), order(2, D2)])
    one = read_daily_city_kpi(spark, f"{work}/out")
    assert {f.rsplit("=", 1)[1][:10] for f in spark.read.parquet(f"{work}/out").filter(F.col(PERIOD) == date(2024, 3, 1)).inputFiles()} >= {"2024-03-01"}
    assert one.count() == 2

"""Refresh of a small warehouse: order of steps, log, errors, change of a dimension between runs, late facts."""

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal
from threading import Event

import pytest
from pyspark.sql import functions as F

from tiffin.plans import refresh
from tiffin.plans.marts import daily_city_kpi
from tiffin.plans.refresh import Config, enriched_orders, refresh_all, run_step, table
from tiffin.schemas import EVENTS, RAW_COLUMNS, raw_schema
from tiffin.sources.raw import parse_events
from tiffin.sources.tables import list_names, versions

T1, T2 = datetime(2024, 6, 1), datetime(2024, 6, 2)

DATA = {
    "customer": [
        ("1", " Ann ", "Ann@X.com", "+91-1", "2023-01-01", "Delhi", "N", "1", "2", "", "Y", ""),
        ("2", "Bob", "b@x.com", "2", "", "  ", "N", "x", "", "Loyal", "0", "INACTIVE"),
    ],
    "restaurant": [("10", "Wok", "Chinese", "Thai", "Pune", "W", "1", "1", "", "0.15", "TRUE", "2023-01-01")],
    "delivery_agent": [("5", "Raj", "99", "2023-01-01", "Pune", "Bike", "")],
    "menu_item": [("1", "10", "Rice", "Main", "", "Y", "")],
    "promotion": [("1", "P", "10", "2024-01-01", "2024-02-01", "50", "ALL", "ALL")],
    "order_header": [
        ("100", "1", "10", "2024-01-01 10:00:50", "delivered", "upi", "", "200.00", "20.00", "30", "210.00", "", "2024-01-01 10:40:10", ""),
        ("101", "2", "99", "2024-01-02 09:00:00", "CANCELLED", "cash", "1", "0", "", "", "0", "", "", "Customer Cancelled"),
        ("102", "3", "10", "2031-01-01 09:00:00", "DELIVERED", "cash", "1", "100", "", "", "100.10", "", "2031-01-01 09:30:00", ""),
    ],
    "order_item": [],
    "delivery_trip": [("7", "100", "5", "2024-01-01 10:10:00", "2024-01-01 10:40:00", "3.456", "20", "30", "1")],
    "payment": [],
    "customer_feedback": [("9", "100", "1", "", "ok", "0.5", "2024-01-01 12:00:00")],
}
EVENT = '{"event_id":1,"customer_id":1,"event_type":"SEARCH","event_ts":"2024-01-01 09:00:00","metadata":{}}'


@pytest.fixture
def config(spark, work):
    def build(**changed):
        raw = {n: spark.createDataFrame(changed.get(n, DATA[n]), raw_schema(n)) for n in RAW_COLUMNS}
        raw[EVENTS] = parse_events(spark.createDataFrame([(changed.get(EVENTS, EVENT),)], "value string"))
        return Config(root=f"{work}/dwh", raw=raw, latest_by=changed.get("latest_by", {}))

    return build


def test_refresh_and_the_enriched_order(spark, config):
    cfg = config()
    status = refresh_all(spark, cfg, T1)
    assert set(status.values()) == {"SUCCESS"} and list(status)[0] == "dim_date" and list(status)[-1] == "fct_order_secure"
    assert table(spark, cfg.root, "dim_date").count() == 3653
    got = {r.order_id: r for r in enriched_orders(spark, cfg.root).collect()}
    first, second, third = got[100], got[101], got[102]

    assert (first.full_date, first.customer_city, first.restaurant_city) == (date(2024, 1, 1), "Delhi", "Pune")
    assert (first.net_food_amount, first.discount_pct) == (Decimal("180.00"), 0.1)
    # Commission is taken from the total, delivery fee included.
    assert (first.platform_commission, first.restaurant_payout) == (Decimal("31.50"), Decimal("178.50"))
    assert (first.end_to_end_min, first.distance_km) == (40, Decimal("3.46"))
    assert (first.sla_breached, first.sla_breach_flag, first.rating) == (1, 1, 0)  # a blank rating is stored as 0

    # Cancelled, restaurant unknown: no trip gives 0 in one SLA column and NULL in the other; no rate, no commission.
    assert (second.sla_breached, second.sla_breach_flag, second.rating) == (0, None, None)
    assert (second.restaurant_id, second.platform_commission, second.restaurant_payout) == (None, None, None)
    assert (second.discount_pct, second.customer_city, second.customer_segment) == (0.0, None, "Loyal")

    # Outside the calendar and of an unknown customer, but still there.
    assert (third.full_date, third.order_date_key, third.customer_id, third.is_delivered) == (None, None, None, 1)

    assert table(spark, cfg.root, "fct_order_secure").count() == 3
    log = spark.read.parquet(cfg.log_path).collect()
    assert {(r.proc_name, r.run_ts) for r in log} == {(n, T1) for n in status}


def test_second_run_changes_only_what_changed(spark, config):
    refresh_all(spark, config(), T1)
    moved = [DATA["customer"][0][:5] + ("Noida",) + DATA["customer"][0][6:], DATA["customer"][1]]
    cfg = config(customer=moved)
    refresh_all(spark, cfg, T2)
    dim = sorted((r.customer_id, r.city or "", r.is_current) for r in table(spark, cfg.root, "dim_customer").collect())
    assert dim == [(1, "Delhi", False), (1, "Noida", True), (2, "", True)]
    assert {r.customer_city for r in table(spark, cfg.root, "fct_order_secure").filter("order_id = 100").collect()} == {"Noida"}
    assert table(spark, cfg.root, "dim_restaurant").count() == 1


def test_an_error_is_logged_and_the_other_steps_run(spark, config):
    refresh_all(spark, config(), T1)
    cfg = config(**{EVENTS: '{"event_id":"abc"}', "customer": DATA["customer"][:1] * 2})
    status = refresh_all(spark, cfg, T2)
    assert {n for n, s in status.items() if s == "ERROR"} == {"fct_customer_event", "dim_customer"}
    assert table(spark, cfg.root, "fct_customer_event").count() == 1  # the version before
    assert table(spark, cfg.root, "dim_customer").count() == 2
    errors = spark.read.parquet(cfg.log_path).filter("status = 'ERROR'").collect()
    assert {r.proc_name for r in errors} == {"fct_customer_event", "dim_customer"}
    assert any("occurs up to 2 times" in r.message for r in errors)


def test_repeated_deliveries_are_reduced_on_request(spark, config):
    again = DATA["customer"][0][:4] + ("2023-05-05", "Noida") + DATA["customer"][0][6:]
    trip = DATA["delivery_trip"][0]
    late = trip[:4] + ("2024-01-01 11:00:00",) + trip[5:]
    cfg = config(
        customer=[*DATA["customer"], again],
        delivery_trip=[trip, late],
        latest_by={"customer": ["registered_at"], "delivery_trip": ["drop_time"]},
    )
    assert refresh_all(spark, cfg, T1)["dim_customer"] == "SUCCESS"
    assert sorted((r.customer_id, r.city or "") for r in table(spark, cfg.root, "dim_customer").collect()) == [(1, "Noida"), (2, "")]
    assert [r.drop_time for r in table(spark, cfg.root, "fct_delivery").collect()] == [datetime(2024, 1, 1, 11)]
    assert table(spark, cfg.root, "fct_order_secure").count() == 3


def test_the_last_ingested_row_wins(spark, config):
    """The ingest time is no staged column; keys are compared as numbers all the same."""
    cfg = config(customer=[*DATA["customer"], (" 1 ", *DATA["customer"][0][1:5], "Noida", *DATA["customer"][0][6:])])
    seen = F.when(F.col("city") == "Noida", 2).otherwise(1)
    cfg = replace(cfg, raw={**cfg.raw, "customer": cfg.raw["customer"].withColumn("_ingest_ts", seen)}, latest_by={"customer": ["_ingest_ts"]})
    assert refresh_all(spark, cfg, T1)["dim_customer"] == "SUCCESS"
    assert sorted((r.customer_id, r.city or "") for r in table(spark, cfg.root, "dim_customer").collect()) == [(1, "Noida"), (2, "")]


def test_a_second_trip_fails_the_order_fact_and_skips_what_reads_it(spark, config):
    """Two trips of an order would multiply it: the step says so, and the table built on it is not touched."""
    cfg = config(delivery_trip=[DATA["delivery_trip"][0], ("9", *DATA["delivery_trip"][0][1:])])
    status = refresh_all(spark, cfg, T1)
    assert (status["fct_order_enhanced"], status["fct_order_secure"], status["fct_delivery"]) == ("ERROR", "SKIPPED", "SUCCESS")
    log = {r.proc_name: r.message for r in spark.read.parquet(cfg.log_path).collect()}
    assert "order_id occurs up to 2 times" in log["fct_order_enhanced"]
    assert log["fct_order_secure"] == "fct_order_secure waits for fct_order_enhanced"
    allowed = refresh_all(spark, replace(cfg, one_per_order=False), T2)
    assert allowed["fct_order_secure"] == "SUCCESS"


def test_old_versions_expire(spark, config):
    for when in (T1, T2, datetime(2024, 6, 3)):
        refresh_all(spark, replace(config(), keep=2), when)
    cfg = config()
    assert len(versions(spark, cfg.path("dim_customer"))) == 2
    assert len(list_names(spark, cfg.path("dim_customer/data"))) == 2
    assert table(spark, cfg.root, "fct_order_secure").count() == 3


def test_redelivered_events_are_reduced(spark, config):
    cfg = config()
    events = cfg.raw[EVENTS]
    newer = events.withColumn("seen", F.lit(1)).unionByName(events.withColumn("seen", F.lit(2)))
    cfg = replace(cfg, raw={**cfg.raw, EVENTS: newer}, latest_by={EVENTS: ["seen"]})
    assert refresh_all(spark, cfg, T1)["fct_customer_event"] == "SUCCESS"
    assert table(spark, cfg.root, "fct_customer_event").count() == events.count()


def test_new_orders_show_up_in_the_daily_city_table(spark, config):
    """Orders that land after the first load reach the marts with the next refresh of the facts."""
    refresh_all(spark, config(), T1)
    more = [
        (str(7700 + i), "1", "10", "2024-06-02 19:05:00", "DELIVERED", "CARD", "", "321.10", "21.10", "17.25", "317.25",
         "2024-06-02 19:30:00", "2024-06-02 19:41:00", "")
        for i in range(7)
    ]
    cfg = config(order_header=[*DATA["order_header"], *more])
    refresh_all(spark, cfg, T2)
    today = daily_city_kpi(table(spark, cfg.root, "fct_order_secure")).filter("full_date = '2024-06-02'").collect()
    assert [(r.customer_city, r.restaurant_city, r.total_orders, r.gmv, r.avg_rating) for r in today] == [
        ("Delhi", "Pune", 7, Decimal("2220.75"), None)
    ]
    assert (today[0].delivered_orders, today[0].avg_sla_breach_rate) == (7, None)  # no trips yet


def test_single_steps_are_logged_too(spark, work):
    def broken():
        raise RuntimeError("no such table")

    assert run_step(spark, "good", lambda: None, f"{work}/log", T1) == "SUCCESS"
    assert run_step(spark, "bad", broken, f"{work}/log", T2) == "ERROR"
    log = sorted(tuple(r) for r in spark.read.parquet(f"{work}/log").collect())
    assert log == [("bad", T2, "ERROR", "no such table"), ("good", T1, "SUCCESS", "good loaded")]


def test_keys_left_out_are_reported(spark, config):
    cfg = config(restaurant=[*DATA["restaurant"], ("x", *DATA["restaurant"][0][1:])])
    refresh_all(spark, cfg, T1)
    note = spark.read.parquet(cfg.log_path).filter("proc_name = 'dim_restaurant'").first().message
    assert note == "dim_restaurant loaded, 1 source rows without restaurant_id left out"
    assert table(spark, cfg.root, "dim_restaurant").count() == 1


def test_money_without_decimals(spark, config, work):
    cfg = replace(config(), root=f"{work}/whole", money_scale=0)
    refresh_all(spark, cfg, T1)
    assert table(spark, cfg.root, "fct_order_enhanced").filter("order_id = 102").first().total_amount == Decimal("100.00")


def test_facts_are_typed_while_the_dimensions_load(spark, config, monkeypatch):
    staged, store_dimension, typed = refresh.staged, refresh.store_dimension, {n: Event() for n in refresh.SOURCES}

    def type_(cfg, name):
        typed[name].set()
        return staged(cfg, name)

    def store(*args, **named):
        assert all(typed[n].wait(60) for n in ("order_header", "delivery_trip", "customer_feedback", EVENTS))
        store_dimension(*args, **named)

    monkeypatch.setattr(refresh, "staged", type_)
    monkeypatch.setattr(refresh, "store_dimension", store)
    assert set(refresh_all(spark, config(), T1).values()) == {"SUCCESS"}

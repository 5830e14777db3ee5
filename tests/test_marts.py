"""Marts against a plain-Python computation on random orders, and the points where definitions are easily mixed up."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiffin.plans import analysis, dashboard, marts
from tiffin.plans.dashboard import Filter

SCHEMA = (
    "order_id bigint, full_date date, total_amount decimal(12,2), restaurant_payout decimal(12,2), platform_commission decimal(12,2),"
    " sla_breached bigint, end_to_end_min bigint, is_delivered bigint, is_cancelled bigint, customer_id bigint, customer_name string,"
    " customer_city string, customer_area string, customer_segment string, restaurant_id bigint, restaurant_name string,"
    " restaurant_city string, cuisine_primary string, distance_km decimal(10,2), sla_breach_flag bigint, rating bigint,"
    " sentiment_score double, order_status string, payment_method string"
)


def order(i, day, amount, rest=1, city="Pune", delivered=1, rating=None, flag=0, sentiment=None, customer=1, cuisine="Thai"):
    flag = flag if delivered else None
    return (
        i, day, Decimal(amount), Decimal(amount), Decimal(0), flag or 0, 30 if delivered else None, delivered, 1 - delivered,
        customer, f"C{customer}", "Delhi", "N", "New", rest, f"R{rest}", city, cuisine, Decimal("1.50") if delivered else None, flag,
        rating, sentiment, "DELIVERED" if delivered else "CANCELLED", "UPI",
    )


@pytest.fixture
def orders(rows):
    return lambda data: rows(list(data), SCHEMA)


def test_rolling_windows_count_days_with_orders(orders):
    """Gaps in the calendar do not empty the window: it is the last 7 or 30 rows, and the lag is 7 rows back."""
    rng, first = random.Random(7), date(2024, 1, 1)
    days = sorted(rng.sample(range(200), 60))
    data, daily = [], defaultdict(Decimal)
    for i in range(400):
        day = first + timedelta(days=rng.choice(days))
        amount = Decimal(rng.randrange(0, 5000)) / 100
        data.append(order(i, day, amount, rest=1))
        daily[day] += amount
    data.append(order(999, None, "5.00", rest=1))
    got = marts.restaurant_advanced_kpi(orders(data)).orderBy(F.col("full_date").asc_nulls_last()).collect()

    series = [daily[d] for d in sorted(daily)] + [Decimal("5.00")]  # an order without a date comes last
    roll = [sum(series[max(0, i - 6) : i + 1]) for i in range(len(series))]
    assert [r.gmv for r in got] == series
    assert [r.gmv_7d for r in got] == roll
    assert [r.gmv_30d for r in got] == [sum(series[max(0, i - 29) : i + 1]) for i in range(len(series))]
    assert [r.gmv_7d_prev for r in got] == [None] * 7 + roll[:-7]
    for i, r in enumerate(got):
        want = None if i < 7 or not roll[i - 7] else float(roll[i] - roll[i - 7]) / float(roll[i - 7])
        assert r.gmv_7d_wow_growth == want


def test_growth_over_zero_is_null(orders):
    data = [order(i, date(2024, 1, 1) + timedelta(days=i), "0.00" if i < 7 else "1.00") for i in range(8)]
    last = marts.restaurant_advanced_kpi(orders(data)).orderBy(F.col("full_date").desc()).first()
    assert (last.gmv_7d_prev, last.gmv_7d_wow_growth) == (Decimal("0.00"), None)


def test_two_sla_columns_and_zero_ratings(orders):
    """Averages over sla_breached count orders without a trip as 0; those over sla_breach_flag leave them out."""
    day = date(2024, 1, 1)
    df = orders([order(1, day, "1", flag=1, rating=0), order(2, day, "1", delivered=0), order(3, day, "1", delivered=0)])
    assert marts.restaurant_advanced_kpi(df).first().sla_breach_rate == 1 / 3
    feedback = marts.restaurant_feedback_kpi(df).first()
    assert (feedback.sla_breach_rate, feedback.avg_customer_rating, feedback.low_rating_orders) == (1.0, 0.0, 1)
    assert (feedback.cancel_rate, feedback.low_rating_delivered_pct) == (2 / 3, 1.0)
    assert float(analysis.city_kpi(df).first().avg_sla_breach_rate) == 1.0


def test_feedback_ratio_without_deliveries_is_null(orders):
    got = marts.restaurant_feedback_kpi(orders([order(1, date(2024, 1, 1), "1", delivered=0)])).first()
    assert (got.low_rating_delivered_pct, got.cancel_rate, got.avg_distance_km) == (None, 1.0, None)


def test_customer_experience(orders):
    df = orders([order(1, date(2024, 1, 5), "1.00", rating=2), order(2, date(2024, 1, 9), "2.00", rating=5)])
    got = marts.customer_experience_kpi(df, date(2024, 1, 20)).first()
    assert (got.first_order_date, got.last_order_date, got.days_since_last_order) == (date(2024, 1, 5), date(2024, 1, 9), 11)
    assert (got.avg_order_value, got.low_rating_orders, got.avg_rating) == (1.5, 1, 3.5)


def test_totals_agree_across_groupings(orders):
    rng = random.Random(3)
    data = [
        order(i, date(2024, 1, 1 + i % 28), Decimal(rng.randrange(1, 10**6)) / 100, rest=i % 9, city=rng.choice(["A", "B", None]),
              cuisine=rng.choice(["x", "y", None]), delivered=int(rng.random() < 0.7), customer=i % 13)
        for i in range(500)
    ]
    df = orders(data)
    total = sum(r[2] for r in data)
    for grouped in (analysis.city_kpi(df), analysis.cuisine_by_city(df), analysis.commission_by_city(df), marts.daily_city_kpi(df)):
        assert grouped.agg(F.sum("gmv")).first()[0] == total


TRIP = "trip_id bigint, order_id bigint, agent_id bigint, pickup_time timestamp_ntz, distance_km decimal(10,2), actual_time_min bigint, sla_breach_flag bigint"
AGENT = "agent_id bigint, agent_name string, city string, vehicle_type string, status string"


def test_agents_count_orders_and_days_once(rows, orders):
    trips = rows(
        [
            (1, 10, 5, datetime(2024, 1, 1, 9), Decimal("2.00"), 20, 1),
            (2, 10, 5, datetime(2024, 1, 1, 10), Decimal("4.00"), 30, 0),
            (3, 11, 5, datetime(2024, 1, 2, 10), Decimal("3.00"), 40, 0),
            (4, 12, 6, None, Decimal("3.00"), 40, 0),
            (5, 13, 99, datetime(2024, 1, 2, 10), Decimal("3.00"), 40, 0),  # unknown agent
            (6, 14, None, datetime(2024, 1, 2, 10), Decimal("3.00"), 40, 0),
        ],
        TRIP,
    )
    agents = rows([(5, "Raj", "Pune", "Bike", "ACTIVE"), (6, "Tia", "Goa", "Cycle", "ACTIVE"), (7, "Idle", "Goa", "Cycle", "ACTIVE")], AGENT)
    got = {r.agent_id: r for r in marts.agent_efficiency_kpi(trips, agents).collect()}
    assert got.keys() == {5, 6}
    assert (got[5].orders_delivered, got[5].days_worked, got[5].avg_orders_per_day) == (2, 2, 1.0)
    assert (got[5].avg_distance_per_order, got[5].avg_delivery_time_min, got[5].sla_breach_rate) == (3.0, 30.0, 1 / 3)
    assert (got[6].days_worked, got[6].avg_orders_per_day) == (0, None)
    rated = marts.agent_feedback_kpi(trips, agents, orders([order(10, date(2024, 1, 1), "1", rating=3)]))
    got = {r.agent_id: r for r in rated.collect()}
    # The order of two trips is rated once per trip.
    assert (got[5].low_rating_orders, got[5].avg_customer_rating, got[5].orders_delivered) == (2, 3.0, 2)
    assert (got[6].low_rating_orders, got[6].avg_customer_rating) == (0, None)


def test_funnel_needs_search_and_order_on_the_same_day(rows):
    events = rows(
        [(1, "SEARCH", datetime(2024, 1, 1, 9)), (1, "APP_OPEN", datetime(2024, 1, 1, 9)), (1, "SEARCH", datetime(2024, 1, 2, 9)),
         (2, "SEARCH", datetime(2024, 1, 1, 23, 59))],
        "customer_id bigint, event_type string, event_ts timestamp_ntz",
    )
    bought = rows(
        [(1, date(2024, 1, 1), 1), (1, date(2024, 1, 1), 1), (1, date(2024, 1, 2), 0), (2, date(2024, 1, 2), 1)],
        "customer_id bigint, full_date date, is_delivered int",
    )
    people = rows([(1, "Delhi", True), (1, "Old", False), (2, "Delhi", True)], "customer_id bigint, city string, is_current boolean")
    got = marts.city_search_to_order(events, bought, people).collect()
    assert [tuple(r) for r in got] == [("Delhi", date(2024, 1, 1), 1, 2, 2.0)]  # a ratio above 1 is possible


def test_prime_members(rows, orders):
    df = orders([order(1, date(2024, 1, 1), "10.00", customer=1, rating=5), order(2, date(2024, 1, 1), "20.00", customer=1),
                 order(3, date(2024, 1, 1), "5.00", customer=2), order(4, date(2024, 1, 1), "7.00", customer=None)])
    people = rows([(1, True, True), (1, False, False), (2, False, True)], "customer_id bigint, is_prime_member boolean, is_current boolean")
    got = [(r.is_prime_member, r.total_orders, r.unique_customers, r.gmv) for r in analysis.prime_kpi(df, people).collect()]
    assert got == [(True, 2, 1, Decimal("30.00")), (False, 2, 1, Decimal("12.00"))]


def test_cancellation_has_two_definitions(orders):
    """Share of all orders in the analysis, share of delivered plus cancelled on the dashboard."""
    df = orders([order(1, date(2024, 1, 1), "1"), order(2, date(2024, 1, 1), "1", delivered=0)])
    pending = df.filter("order_id = 1").withColumns({"is_delivered": F.lit(0).cast("bigint"), "order_id": F.lit(3).cast("bigint")})
    df = df.unionByName(pending)
    assert float(analysis.problem_restaurants(df, min_orders=1).first().cancel_rate) == 0.3333
    assert dashboard.overview(df, Filter(date(2024, 1, 1), date(2024, 1, 1))).first().cancellation_pct == 50.0


def test_overview_of_nothing_is_zeros(orders):
    got = dashboard.overview(orders([order(1, date(2024, 1, 1), "1")]), Filter(date(2020, 1, 1), date(2020, 1, 2))).first()
    assert [float(v) for v in got] == [0.0] * 7


def test_choosing_all_or_nothing_keeps_rows_without_a_value(orders):
    df = orders([order(1, date(2024, 1, 1), "1", city=None), order(2, date(2024, 1, 1), "1", city="O'Hara"), order(3, date(2024, 1, 1), "1")])
    every = ["O'Hara", "Pune"]

    def seen(chosen):
        flt = Filter.chosen(date(2024, 1, 1), date(2024, 1, 1), chosen, every, [], ["Thai"])
        return sorted(r.order_id for r in dashboard.filters(df, flt).collect())

    assert seen([]) == [1, 2, 3]
    assert seen(every) == [1, 2, 3]
    assert seen(["O'Hara"]) == [2]
    assert [r[0] for r in dashboard.cities(df).collect()] == every


def test_explorer_applies_the_filters_that_fit(orders):
    df = orders([order(1, date(2024, 1, 1), "1", city="A"), order(2, date(2025, 1, 1), "1", city="B")])
    catalog = {"orders": lambda: df, "customers": lambda: marts.customer_experience_kpi(df, date(2024, 1, 1))}
    flt = Filter(date(2024, 1, 1), date(2024, 12, 31), cities=["A"])
    assert dashboard.mart_names(catalog) == ["customers", "orders"]
    assert [r.order_id for r in dashboard.explore(catalog, "orders", flt).collect()] == [1]
    assert dashboard.explore(catalog, "customers", flt).first().total_orders == 2


def test_sorted_and_limited_results(orders):
    rng = random.Random(5)
    data = []
    for i in range(300):
        rest = rng.randrange(40)
        data.append(
            order(i, date(2024, 1, 1 + i % 28), rng.choice(["10.00", "20.00"]), rest=rest, city=f"T{rest % 5}" if rest else None,
                  rating=rng.choice([None, 1, 5]) if rest % 3 else None, delivered=int(rng.random() < 0.6))
        )
    df = orders(data)
    top = analysis.top_restaurants(df).collect()
    assert len(top) == 15
    every = analysis.top_restaurants(df, 10**6).collect()
    assert [(-r.gmv, r.restaurant_id) for r in every] == sorted((-r.gmv, r.restaurant_id) for r in every)
    assert top == every[:15]

    worst = analysis.problem_restaurants(df, min_orders=1, n=100).collect()
    key = [(r.avg_rating is None, r.avg_rating or 0, -r.cancel_rate, r.sla_breach_rate is not None, -(r.sla_breach_rate or 0), r.restaurant_id) for r in worst]
    assert key == sorted(key)  # unrated restaurants last, unknown SLA first
    assert all(r.total_orders >= 5 for r in analysis.problem_restaurants(df).collect())

    cities = [r.city for r in analysis.cuisine_by_city(df).withColumnRenamed("restaurant_city", "city").collect()]
    assert cities == [*sorted(c for c in cities if c), None]
    detail = dashboard.order_detail(df, Filter(date(2024, 1, 1), date(2024, 12, 31))).collect()
    assert [(r.full_date, r.order_id) for r in detail] == sorted((r.full_date, r.order_id) for r in detail)

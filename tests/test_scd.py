"""Dimension upkeep: hand-made scenarios, and invariants on generated deliveries."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin import schemas
from tiffin.operators import dims
from tiffin.operators.scd import OPEN_END, latest_per_key, scd2_apply, scd2_current, scd2_history
from tiffin.plans.refresh import check_keys
from tiffin.sources.tables import empty

T1, T2, T3 = datetime(2024, 6, 1), datetime(2024, 6, 2), datetime(2024, 6, 3)

CUSTOMER = (
    "customer_id bigint, customer_name string, email string, primary_phone string, city string, area string, segment string,"
    " is_prime_member boolean, status string, lat double"
)


def customer(key, city="Delhi", segment="New", lat=1.0, prime=False):
    return (key, f"C{key}", f"c{key}@x.y", "98", city, "North", segment, prime, "ACTIVE", lat)


@pytest.fixture
def people(rows):
    return lambda *data: rows(list(data), CUSTOMER)


def versions(dim):
    got = dim.orderBy("customer_id", "effective_from").collect()
    return [(r.customer_id, r.city, r.effective_from, r.effective_to, r.is_current) for r in got]


def stored(spark, df):
    """Cut the lineage between runs, as storing the table does."""
    return spark.createDataFrame(df.collect(), df.schema)


def test_type2_change_opens_a_version(spark, people):
    first = stored(spark, dims.next_customers(empty(spark, schemas.DIM_CUSTOMER), people(customer(5), customer(6)), T1))
    assert versions(first) == [(5, "Delhi", T1, OPEN_END, True), (6, "Delhi", T1, OPEN_END, True)]
    second = stored(
        spark, dims.next_customers(first, people(customer(5, "Noida", "High Value"), customer(6), customer(7)), T2)
    )
    assert versions(second) == [
        (5, "Delhi", T1, T2, False),
        (5, "Noida", T2, OPEN_END, True),
        (6, "Delhi", T1, OPEN_END, True),
        (7, "Delhi", T2, OPEN_END, True),
    ]
    assert [r.city for r in scd2_history(second, "customer_id", 5).collect()] == ["Delhi", "Noida"]
    assert scd2_current(second).count() == 3
    keys = [r.customer_sk for r in second.collect()]
    assert len(set(keys)) == len(keys)
    old = {r.customer_sk for r in first.collect()}
    assert min(set(keys) - old) > max(old)
    assert {r.record_source for r in second.collect()} == {"stg_customer"}


def test_type2_same_delivery_twice_changes_nothing(spark, people):
    src = people(customer(1), customer(2, "Pune"))
    once = stored(spark, dims.next_customers(empty(spark, schemas.DIM_CUSTOMER), src, T1))
    again = dims.next_customers(once, src, T2)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_type2_null_equals_default_and_untracked_columns_are_ignored(spark, people):
    first = stored(
        spark, dims.next_customers(empty(spark, schemas.DIM_CUSTOMER), people(customer(1, city=None, prime=None)), T1)
    )
    same = dims.next_customers(first, people(customer(1, city="", lat=9.0, prime=False)), T2)
    assert versions(same) == [(1, None, T1, OPEN_END, True)]


def test_type2_vanished_key_stays_open_and_null_key_is_left_out(spark, people):
    first = stored(spark, dims.next_customers(empty(spark, schemas.DIM_CUSTOMER), people(customer(1), customer(2)), T1))
    second = dims.next_customers(first, people(customer(2), customer(None)), T2)
    assert versions(second) == [(1, "Delhi", T1, OPEN_END, True), (2, "Delhi", T1, OPEN_END, True)]


def test_type2_back_to_an_earlier_value_is_a_new_version(spark, people):
    dim = empty(spark, schemas.DIM_CUSTOMER)
    for now, city in ((T1, "A"), (T2, "B"), (T3, "A")):
        dim = stored(spark, dims.next_customers(dim, people(customer(1, city)), now))
    assert versions(dim) == [(1, "A", T1, T2, False), (1, "B", T2, T3, False), (1, "A", T3, OPEN_END, True)]


def test_type2_text_keys_and_few_counters(spark, rows):
    schema = "sk bigint, k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, record_source string"
    src = rows([(f"k{i}", "x") for i in range(50)], "k string, v string")
    dim = scd2_apply(empty(spark, schema), src, key="k", sk="sk", tracked={"v": ""}, now=T1, source="s", counters=4)
    keys = [r.sk for r in dim.collect()]
    assert len(set(keys)) == 50 and min(keys) >= 1


RESTAURANT = (
    "restaurant_id bigint, restaurant_name string, cuisine_primary string, cuisine_secondary string, city string, area string,"
    " lat double, lng double, avg_rating double, commission_rate double, is_active boolean, onboarded_at timestamp_ntz"
)


def restaurant(key, cuisine="Chinese", city="Pune", name="R", onboarded=T1, rating=4.0):
    return (key, name, cuisine, "Bakery", city, "West", 1.0, 2.0, rating, 0.2, True, onboarded)


def test_type2_restaurant_carries_but_does_not_compare_onboarding(spark, rows):
    dim = empty(spark, schemas.DIM_RESTAURANT)
    dim = stored(spark, dims.next_restaurants(dim, rows([restaurant(3)], RESTAURANT), T1))
    same = dims.next_restaurants(dim, rows([restaurant(3, onboarded=T3)], RESTAURANT), T2).collect()
    assert [(r.onboarded_at, r.is_current) for r in same] == [(T1, True)]
    changed = dims.next_restaurants(dim, rows([restaurant(3, rating=4.5, onboarded=T3)], RESTAURANT), T2)
    assert sorted((r.avg_rating, r.onboarded_at, r.is_current) for r in changed.collect()) == [(4.0, T1, False), (4.5, T3, True)]


def test_type3_shifts_only_on_cuisine_change(spark, rows):
    dim = empty(spark, schemas.DIM_RESTAURANT_SCD3)
    dim = stored(spark, dims.next_restaurant_cuisines(dim, rows([restaurant(3), restaurant(4)], RESTAURANT), T1))
    assert [(r.current_cuisine, r.previous_cuisine, r.last_change_date) for r in dim.collect()] == [("Chinese", None, T1)] * 2
    nxt = rows([restaurant(3, "Continental", "Goa", "Renamed"), restaurant(4, city="Goa", name="Renamed"), restaurant(9)], RESTAURANT)
    got = {r.restaurant_id: tuple(r)[1:] for r in dims.next_restaurant_cuisines(dim, nxt, T2).collect()}
    assert got == {
        3: ("R", "Continental", "Chinese", T2, "Goa", "West"),  # the name never follows
        4: ("R", "Chinese", None, T1, "Pune", "West"),  # nor does the city without a change of cuisine
        9: ("R", "Chinese", None, T2, "Pune", "West"),
    }


def test_type3_null_cuisine_equals_blank_and_vanished_rows_stay(spark, rows):
    dim = stored(
        spark,
        dims.next_restaurant_cuisines(
            empty(spark, schemas.DIM_RESTAURANT_SCD3), rows([restaurant(1, None), restaurant(2)], RESTAURANT), T1
        ),
    )
    got = dims.next_restaurant_cuisines(dim, rows([restaurant(1, "")], RESTAURANT), T2)
    assert sorted((r.restaurant_id, r.current_cuisine, r.last_change_date) for r in got.collect()) == [
        (1, None, T1),
        (2, "Chinese", T1),
    ]


def test_type1_overwrites_inserts_and_keeps(spark, rows):
    schema = "agent_id bigint, agent_name string, phone string, hire_date timestamp_ntz, city string, vehicle_type string, status string"
    dim = dims.next_agents(
        empty(spark, schemas.DIM_DELIVERY_AGENT),
        rows([(1, "A", "9", T1, "Delhi", "Bike", "ACTIVE"), (2, "B", "9", T1, "Delhi", "Bike", "ACTIVE")], schema),
    )
    dim = dims.next_agents(
        dim,
        rows([(1, "A", "9", T1, "Kolkata", "Bike", "INACTIVE"), (3, "C", "9", T1, "Goa", "Cycle", "ACTIVE"), (None,) * 7], schema),
    )
    assert sorted((r.agent_id, r.city, r.status) for r in dim.collect()) == [
        (1, "Kolkata", "INACTIVE"),
        (2, "Delhi", "ACTIVE"),
        (3, "Goa", "ACTIVE"),
    ]


def test_latest_per_key_keeps_one_row_even_for_a_hot_key(rows):
    src = rows([(1, i, f"v{i}") for i in range(500)] + [(2, 1, "only")] + [(None, 1, "a")] * 2, "k bigint, n bigint, v string")
    got = [tuple(r) for r in latest_per_key(src, "k", ["n"]).collect()]
    assert sorted(got, key=str) == [(1, 499, "v499"), (2, 1, "only"), (None, 1, "a"), (None, 1, "a")]


def test_repeated_keys_fail_loudly(rows):
    src = rows([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    with pytest.raises(ValueError, match="occurs up to 2 times"):
        check_keys(src, "k")
    assert check_keys(src.distinct(), "k").startswith("1 source rows without k")


deliveries = st.lists(st.dictionaries(st.integers(0, 6), st.sampled_from(["A", "B", None]), max_size=5), min_size=1, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deliveries)
def test_type2_against_a_plain_model(spark, people, batches):
    """Versions per key are contiguous, exactly one is current, and the values follow the deliveries."""
    dim, model = empty(spark, schemas.DIM_CUSTOMER), {}
    for day, batch in enumerate(batches, start=1):
        now = datetime(2024, 6, day)
        dim = stored(spark, dims.next_customers(dim, people(*[customer(k, city) for k, city in batch.items()]), now))
        for k, city in batch.items():
            history = model.setdefault(k, [])
            if not history or (history[-1][0] or "") != (city or ""):
                if history:
                    history[-1][2] = now
                history.append([city, now, OPEN_END])
    got = {}
    for k, city, start, end, current in versions(dim):
        got.setdefault(k, []).append([city, start, end])
        assert current == (end == OPEN_END)
    assert got == model
    assert dim.select("customer_sk").distinct().count() == dim.count()
    assert dim.filter(F.col("customer_sk").isNull()).count() == 0


def test_type2_numbers_only_new_versions_and_spreads_strided_keys(spark, rows):
    """Ids that are all multiples of 1,024 use many counters, and no window runs over unchanged rows."""
    schema = "sk bigint, k bigint, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, record_source string"
    src = spark.range(4_000).select((F.col("id") * 1024).alias("k"), F.lit("x").alias("v"))
    first = scd2_apply(empty(spark, schema), src, key="k", sk="sk", tracked={"v": ""}, now=T1, source="s", counters=64)
    keys = sorted(r.sk for r in first.collect())
    assert len(set(keys)) == 4_000
    assert len({k % 64 for k in keys}) == 64 and keys[-1] < 3 * 4_000
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Filter" in window
    assert plan.count("Window [") == 1

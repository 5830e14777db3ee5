"""Masks, row rules and the delivery-time bucket."""

import pytest
from pyspark.sql import functions as F

from tiffin import schemas
from tiffin.functions.policy import mask_email, mask_phone, sla_bucket
from tiffin.operators.access import apply_masks, apply_row_access
from tiffin.operators.edit import update_where

ORDERS = [
    (1, "Pune", 3),
    (2, "Pune", 7),
    (3, "Goa", 3),
    (4, "Delhi", 8),
    (5, None, None),
]
ACCESS = [
    ("CITY_A", "CITY", "Pune", None),
    ("REST_3", "RESTAURANT", None, 3),
    ("BOTH", "CITY", "Delhi", None),
    ("BOTH", "RESTAURANT", None, 7),
    ("BOTH", "CITY", "Delhi", None),
    ("WRONG", "CITY", None, 3),  # a restaurant id on a city entry opens nothing
    ("WRONG", "RESTAURANT", "Pune", None),
]


@pytest.fixture
def orders(rows):
    return rows(ORDERS, "order_id bigint, restaurant_city string, restaurant_id bigint")


@pytest.fixture
def access(rows):
    return rows(ACCESS, schemas.ROLE_ACCESS)


SEEN = {
    "CITY_A": [1, 2],
    "REST_3": [1, 3],  # one restaurant only, and not every row
    "BOTH": [2, 4],
    "WRONG": [],
    "NOBODY": [],
    "ADMIN": [1, 2, 3, 4, 5],
    "SYSADMIN": [1, 2, 3, 4, 5],
}


@pytest.mark.parametrize("role, ids", SEEN.items())
def test_rows_by_role(orders, access, role, ids):
    """Rows of a city and of a restaurant, each once, however often the mapping names them."""
    got = apply_row_access(orders, access, role)
    assert got.columns == orders.columns
    assert sorted(r.order_id for r in got.collect()) == ids


def test_a_revoked_role_sees_nothing_from_the_next_run_on(spark, orders, access, work):
    """The mapping is read when the result is, not when the query is built."""
    path = f"{work}/access"
    access.write.parquet(path)
    query = apply_row_access(orders, spark.read.schema(access.schema).parquet(path), "REST_3")
    assert sorted(r.order_id for r in query.collect()) == [1, 3]
    access.filter("role_name <> 'REST_3'").write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    assert apply_row_access(orders, spark.read.schema(access.schema).parquet(path), "REST_3").collect() == []


def test_masks(rows):
    values = ["alice@x.com", "a@b.c", "alice@x@y.com", "noat", "", None]
    df = rows([(v,) for v in values], "v string")
    masked = [r.v for r in apply_masks(df, {"v": mask_email}, "ANALYST").collect()]
    assert masked == ["a*****@x.com", "a*****@b.c", "a*****@y.com", "noat", "", None]
    assert [r.v for r in apply_masks(df, {"v": mask_email}, "PII_ADMIN").collect()] == values
    phones = rows([(v,) for v in ["919876543210", "12", "", None]], "v string")
    assert [r.v for r in apply_masks(phones, {"v": mask_phone}, "ANALYST").collect()] == ["XXXXXX3210", "XXXXXX12", "XXXXXX", None]
    assert [r.v for r in apply_masks(phones, {"v": mask_phone}, "ADMIN").collect()] == ["919876543210", "12", "", None]


def test_sla_bucket(rows):
    df = rows([(30, None), (30, 30), (30, 31), (30, 40), (30, 41), (None, 5), (None, None)], "e bigint, a bigint")
    got = [r.b for r in df.select(sla_bucket(F.col("e"), F.col("a")).alias("b")).collect()]
    assert got == ["UNKNOWN", "ON_TIME", "SLIGHT_DELAY", "SLIGHT_DELAY", "HEAVY_DELAY", "HEAVY_DELAY", "UNKNOWN"]


def test_update_where_leaves_false_and_null_conditions(rows):
    df = rows([(1, "a", 1), (2, "b", 2), (None, "c", 3)], "k bigint, v string, n int")
    got = update_where(df, F.col("k") == 1, {"v": F.lit("z"), "n": F.col("n") * 10})
    assert [tuple(r) for r in got.collect()] == [(1, "z", 10), (2, "b", 2), (None, "c", 3)]
    assert got.schema["n"].dataType == df.schema["n"].dataType

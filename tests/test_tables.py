"""Versioned tables: refresh, append, reading back, restore."""

import pytest

from tiffin.operators.edit import update_where
from tiffin.sources.tables import append_table, overwrite_table, read_as_of, read_table, restore_as_of, versions
from pyspark.sql import functions as F


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_may_read_the_table_it_replaces(spark, rows, work):
    path = f"{work}/t"
    overwrite_table(rows([(1, "a"), (2, "b")], "k int, v string"), path)
    overwrite_table(read_table(spark, path).filter("k = 2"), path)
    assert values(read_table(spark, path)) == [(2, "b")]


def test_a_failed_write_leaves_the_old_version(spark, rows, work):
    path = f"{work}/t"
    overwrite_table(rows([(1, "7")], "k int, v string"), path)
    with pytest.raises(Exception):
        overwrite_table(rows([(1, "x")], "k int, v string").withColumn("v", F.col("v").cast("int")), path)
    assert values(read_table(spark, path)) == [(1, "7")]
    assert len(versions(spark, path)) == 1


def test_a_table_never_written(spark, work):
    assert read_table(spark, f"{work}/none", schema="k int, m decimal(5,2)").schema.simpleString() == "struct<k:int,m:decimal(5,2)>"
    assert read_table(spark, f"{work}/none", schema="k int").count() == 0
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{work}/none")


def test_undo_a_wrong_update(spark, rows, work):
    """Read a table as it was before a mistake, then make that version current again."""
    path = f"{work}/dim"
    overwrite_table(rows([(31, "Gold"), (32, "Trial")], "customer_id int, segment string"), path, at_millis=1_000_000)
    broken = update_where(read_table(spark, path), F.col("customer_id") == 31, {"segment": F.lit("OOPS")})
    overwrite_table(broken, path, at_millis=1_400_000)
    assert values(read_table(spark, path)) == [(31, "OOPS"), (32, "Trial")]
    assert values(read_as_of(spark, path, 1_250_000)) == [(31, "Gold"), (32, "Trial")]
    with pytest.raises(FileNotFoundError):
        read_as_of(spark, path, 999_999)
    restore_as_of(spark, path, 1_250_000, at_millis=1_500_000)
    assert values(read_table(spark, path)) == [(31, "Gold"), (32, "Trial")]
    assert values(read_as_of(spark, path, 1_450_000)) == [(31, "OOPS"), (32, "Trial")]
    with pytest.raises(FileNotFoundError):
        restore_as_of(spark, path, 5)


def test_publish_times_grow_even_within_one_millisecond(spark, rows, work):
    path, df = f"{work}/t", rows([(1,)], "k int")
    first = overwrite_table(df, path, at_millis=50)
    assert overwrite_table(df, path, at_millis=50) == first + 1


def test_append(spark, rows, work):
    append_table(rows([(1,)], "k int"), f"{work}/a")
    append_table(rows([(1,), (2,)], "k int"), f"{work}/a")
    assert values(spark.read.parquet(f"{work}/a")) == [(1,), (1,), (2,)]

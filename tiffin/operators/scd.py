"""Dimension upkeep: overwrite (type 1), version history (type 2), previous value (type 3).

Each operator takes the stored dimension and the staged source and returns the next state of the dimension; storing it
is left to ``sources.tables``. Source rows without a key are left out: they could never match again and would be
inserted anew on every run. Keys are expected to be unique in the source; ``latest_per_key`` makes them so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN_END = datetime(9999, 12, 31)

KEPT, CLOSED, FRESH = 0, 1, 2


def _ntz(ts: datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def latest_per_key(df: DataFrame, key: str | Column, order_by: Sequence[str]) -> DataFrame:
    """The last delivered row of each key; rows without a key are all kept.

    The greatest ordering wins and carries its row along, so only the ordering columns are compared, and columns without an
    order, such as VARIANT, may be part of a row. Equal orderings are told apart by a hash of the other columns that have one.
    Re-delivered copies of a hot key are reduced before the shuffle.
    """
    keyed = df.withColumn("_key", F.col(key) if isinstance(key, str) else key)
    plain = [c for c, kind in df.dtypes if "variant" not in kind and "map<" not in kind and c not in order_by]
    texts = [F.to_json(c) for c, kind in df.dtypes if kind == "variant"]
    tie = F.xxhash64(*[F.col(c) for c in plain], *texts) if plain or texts else F.lit(0)
    newest = F.max_by(F.struct(*df.columns), F.struct(*order_by, tie)).alias("newest")
    last = keyed.filter("_key is not null").groupBy("_key").agg(newest).select("newest.*")
    return last.unionByName(keyed.filter("_key is null").drop("_key"))


def scd1_upsert(dim: DataFrame, src: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Source rows replace stored rows of the same key; stored rows without a source row stay."""
    types = dict((f.name, f.dataType) for f in dim.schema.fields)
    incoming = src.filter(F.col(key).isNotNull()).select(*[F.col(c).cast(types[c]).alias(c) for c in (key, *cols)])
    kept = dim.join(incoming.select(key), key, "left_anti")
    return kept.select(key, *cols).unionByName(incoming)


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    *,
    key: str,
    sk: str,
    tracked: Mapping[str, object],
    carried: Sequence[str] = (),
    now: datetime,
    source: str,
    counters: int | None = None,
) -> DataFrame:
    """Close the current version of every key whose tracked columns changed, and open one for each key without any.

    ``tracked`` maps each compared column to the value NULL is taken for, so NULL and that value are equal.
    ``carried`` columns are stored but do not open a version by themselves. Keys missing from the source stay open.

    Closed versions of earlier runs pass through untouched; where they are stored apart, ``dim`` may be the current versions alone (see
    ``sources.tables.advance_history``): the highest surrogate key is always one of theirs, because a key that loses its version gets a new
    one with a higher number. Current versions and source meet in one full outer join on the key, which
    yields up to two rows per key. Only the new versions are numbered, from the highest surrogate key on: a hash of the key picks one
    of ``counters`` (by default as many as there are shuffle partitions), and each counter deals every ``counters``-th number, which
    needs no global sort. Numbers are unique and grow from run to run, but may skip.
    """
    types = {f.name: f.dataType for f in dim.schema.fields}
    attributes = [key, *tracked, *carried]
    current = dim.filter("is_current").select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"old_{c}") for c in dim.columns], F.lit(True).alias("_stored")
    )
    incoming = src.filter(F.col(key).isNotNull()).select(
        F.col(key).cast(types[key]).alias("_key"),
        *[F.col(c).cast(types[c]).alias(f"new_{c}") for c in attributes],
        F.lit(True).alias("_delivered"),
    )

    differs = F.lit(False)
    for c, default in tracked.items():
        differs = differs | (F.coalesce(f"old_{c}", F.lit(default)) != F.coalesce(f"new_{c}", F.lit(default)))
    kinds = (
        F.when(F.col("_stored").isNull(), F.array(F.lit(FRESH)))
        .when(F.col("_delivered") & differs, F.array(F.lit(CLOSED), F.lit(FRESH)))
        .otherwise(F.array(F.lit(KEPT)))
    )
    met = current.join(incoming, "_key", "full").withColumn("_kind", F.explode(kinds))

    fresh, closed = F.col("_kind") == FRESH, F.col("_kind") == CLOSED
    fresh_values = {
        **{c: F.col(f"new_{c}") for c in attributes},
        "effective_from": _ntz(now),
        "effective_to": _ntz(OPEN_END),
        "is_current": F.lit(True),
        "record_source": F.lit(source),
    }
    stored_values = {
        **{c: F.col(f"old_{c}") for c in dim.columns},
        "effective_to": F.when(closed, _ntz(now)).otherwise(F.col("old_effective_to")),
        "is_current": ~closed,
    }
    others = [c for c in dim.columns if c != sk]
    versions = met.select(
        fresh.alias("_fresh"),
        F.col(f"old_{sk}").alias(sk),
        *[F.when(fresh, fresh_values[c]).otherwise(stored_values[c]).cast(types[c]).alias(c) for c in others],
    )

    n = counters or int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    highest = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()
    turn = F.row_number().over(Window.partitionBy("_counter").orderBy(key)).cast("bigint")
    numbered = (
        versions.filter("_fresh")
        .withColumn("_counter", F.pmod(F.xxhash64(key), F.lit(n).cast("bigint")))
        .withColumn("_turn", turn)
        .withColumn(sk, highest + 1 + F.col("_counter") + (F.col("_turn") - 1) * n)
    )
    stay = versions.filter("not _fresh").select(*dim.columns)
    return dim.filter("not is_current").unionByName(stay).unionByName(numbered.select(*dim.columns))


def scd2_current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def scd2_history(dim: DataFrame, key: str, *values: object) -> DataFrame:
    """All versions of the given keys, or of every key, oldest first."""
    chosen = dim.filter(F.col(key).isin(list(values))) if values else dim
    return chosen.orderBy(key, "effective_from", "effective_to")


def scd3_apply(
    dim: DataFrame,
    src: DataFrame,
    *,
    key: str,
    source_col: str,
    current_col: str,
    previous_col: str,
    stamp_col: str,
    refresh: Sequence[str],
    insert: Sequence[str],
    now: datetime,
) -> DataFrame:
    """On change of one column, move its value to the previous-value column, stamp the row and refresh a few others.

    Rows without a change, or without a source row, stay as they are; unseen keys are inserted with no previous value.
    """
    stored = dim.select(F.col(key).alias("_key"), *[F.col(c).alias(f"old_{c}") for c in dim.columns], F.lit(True).alias("_stored"))
    incoming = src.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(f"new_{c}") for c in dict.fromkeys([source_col, *refresh, *insert])],
        F.lit(True).alias("_delivered"),
    )
    unseen = F.col("_stored").isNull()
    changed = (
        F.col("_stored")
        & F.col("_delivered")
        & (F.coalesce(f"old_{current_col}", F.lit("")) != F.coalesce(f"new_{source_col}", F.lit("")))
    )

    def next_value(c: str) -> Column:
        old = F.col(f"old_{c}")
        if c == key:
            return F.col("_key")
        if c == current_col:
            return F.when(unseen | changed, F.col(f"new_{source_col}")).otherwise(old)
        if c == previous_col:
            return F.when(changed, F.col(f"old_{current_col}")).otherwise(old)
        if c == stamp_col:
            return F.when(unseen | changed, _ntz(now)).otherwise(old)
        return F.when(unseen | changed if c in refresh else unseen, F.col(f"new_{c}")).otherwise(old)

    met = stored.join(incoming, "_key", "full")
    return met.select(*[next_value(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns])

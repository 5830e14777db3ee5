"""Merkle manifest of a table: one tree of 8 children a node for each group of rows, and one tree over the groups.

Nodes carry the interval of leaf ranks that they cover. A node of level l covers the ranks of one bucket of 8^l ranks, so a
containment join of a level with the level above is an equality on the bucket, checked by the intervals: ancestors are attached from
the root downwards, a level at a time, and every level above the leaves is at most an eighth of the one below. The siblings of a node
are the difference of its parent's interval and its own: children that end before it and children that begin after it.

Ranks come from a range partitioning by group and order: a group of any size is dealt out over many tasks, which number their rows from
the sums of the ranges before. No group is collected, no bucket holds more than eight rows.

Nulls: a null group is a group of its own, the first; a null order key comes first; a null column reads ``-`` in its leaf. Rows with
equal keys are ordered by their leaves, equal rows are leaves of their own. Empty texts count 0 bytes, long ones are hashed whole. An
empty table gives an empty manifest. Only the named columns are read, so other columns can't clash; the result has no column of the
input but the kept ones, which must not be named like its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiffin.llm.store import stored

FAN = 8
_STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as its length in UTF-8 bytes, a colon and itself, or ``-`` for null."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(part, values))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds the interval [lo, hi) of each row's rank in its ``grp``, and the number ``n`` of rows there."""
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order, "digest")]
    placed = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "merkle-order"
    )
    # Rows of a group in one range have consecutive numbers: one short row for each group and range.
    part = F.shiftright("_at", 33)
    runs = placed.groupBy("grp", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("grp")
    ahead = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    runs = runs.withColumns({"_ahead": ahead, "n": F.sum("_rows").over(group)})
    lo = F.col("_at") - F.col("_first") + F.col("_ahead")
    ranked = placed.withColumn("_part", part).join(runs, ["grp", "_part"]).withColumn("lo", lo).withColumn("hi", F.col("lo") + 1)
    return ranked.drop("_at", "_part", "_first", "_rows", "_ahead")


def _bucket(level: int) -> Column:
    return F.floor(F.col("lo") / F.lit(FAN**level)).cast("long").alias("bucket")


def _grown(leaves: DataFrame) -> list[DataFrame]:
    """The levels above the leaves: nodes with their interval, digest and children. A group stops at its one top node."""
    most = leaves.agg(F.max("n").alias("most")).first().most or 0
    levels: list[DataFrame] = []
    nodes, width = leaves, 1
    while width < most:
        child = F.struct("lo", "hi", "digest")
        runs = nodes.filter(F.col("n") > width).groupBy("grp", "n", _bucket(len(levels) + 1)).agg(F.array_sort(F.collect_list(child)).alias("children"))
        built = runs.select(
            "grp",
            "n",
            "bucket",
            F.get("children", F.lit(0))["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join("children.digest", "")).alias("digest"),
            "children",
        )
        nodes = stored(built, f"merkle-level{len(levels) + 1}", small=True)
        levels.append(nodes)
        width *= FAN
    return levels


def _tops(leaves: DataFrame, levels: Sequence[DataFrame]) -> DataFrame:
    """The node of each group that covers the whole group."""
    tops = [t.filter("lo = 0 and hi = n").select("grp", "digest") for t in (leaves, *levels)]
    found = tops[0]
    for t in tops[1:]:
        found = found.unionByName(t)
    return found


def _attached(nodes: DataFrame, level: int, parents: DataFrame | None, tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Nodes of a level with the steps from them to the root, and the columns that their group's top node carries."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    done = nodes.filter(whole).join(tops.select("grp", "path", *carried), "grp")
    if parents is None:
        return done
    siblings = F.col("parent.children")

    def others(side) -> Column:
        return F.array_join(F.transform(F.filter(siblings, side), lambda c: c["digest"]), "")

    step = F.struct(
        others(lambda c: c["hi"] <= F.col("lo")).alias("left"), others(lambda c: c["lo"] >= F.col("hi")).alias("right")
    )
    parent = F.struct("lo", "hi", "children", "path", *carried).alias("parent")
    met = (
        nodes.filter(~whole)
        .withColumn("above", _bucket(level + 1))
        .join(parents.select("grp", F.col("bucket").alias("above"), parent), ["grp", "above"])
        .filter("parent.lo <= lo and hi <= parent.hi")
    )
    path = F.concat(F.array(step), F.col("parent.path")).alias("path")
    return done.unionByName(met.select(*nodes.columns, path, *[f"parent.{c}" for c in carried]))


def _paths(leaves: DataFrame, levels: Sequence[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    parents = None
    for level in range(len(levels), 0, -1):
        parents = stored(_attached(levels[level - 1], level, parents, tops, carried), f"merkle-path{level}", small=True)
    return _attached(leaves, 0, parents, tops, carried)


def manifest(rows: DataFrame, row_digest: Column, *, group: str, order: Sequence[str], keep: Mapping[str, Column]) -> DataFrame:
    """One row per row of the input: the kept columns, ``leaf``, ``subroot``, ``root`` and ``path``.

    ``path`` lists, from the leaf upwards, the digests left and right of the node in its run, each side as one text; the steps of the
    group's tree come before those of the tree over the groups. ``fold`` leads from a leaf and its path to the root.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    sort = [f"_order{i}" for i in range(len(order))]
    wanted = rows.select(
        key.alias("grp"), row_digest.alias("digest"), *[F.col(c).alias(s) for c, s in zip(order, sort, strict=True)], *[c.alias(n) for n, c in keep.items()]
    )
    # Stored before it is ordered: the range partitioning samples its input, which would hash every row twice.
    leaves = stored(_ranked(stored(wanted, "merkle-leaves"), sort).drop(*sort), "merkle-ranked")
    levels = _grown(leaves)
    subroots = stored(
        _ranked(_tops(leaves, levels).select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest"), ["member"]),
        "merkle-subroots",
        small=True,
    )
    upper = _grown(subroots)
    root = _tops(subroots, upper).select("grp", F.col("digest").alias("root"), F.array().cast(_STEP).alias("path"))
    members = stored(_paths(subroots, upper, root, ["root"]), "merkle-members", small=True)
    tops = members.select(F.col("member").alias("grp"), F.col("digest").alias("subroot"), "root", "path")
    done = _paths(leaves, levels, tops, ["subroot", "root"])
    return done.select(*keep, F.col("digest").alias("leaf"), "subroot", "root", "path")


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf_digest, lambda h, s: digest(s["left"], h, s["right"]))


def proof(path: Column) -> Column:
    """All digests of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")

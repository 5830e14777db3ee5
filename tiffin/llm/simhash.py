"""SimHash fingerprints of whole texts, and all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words (the word itself in a text of one word), A-Z lower-cased; each term's hash votes on every bit,
with the weight of its occurrences in the text. A bit is set if more than half of the votes are for it. Equal texts have
equal fingerprints; null texts and texts without words have all bits clear.

``within_radius`` finds neighbours with permuted block tables: the bits are cut into radius + 2 blocks, of which two fingerprints
within the radius share two at least; there is one table for each pair of blocks, keyed by their bits. Crowded keys are cut into
tiles, so no task holds all fingerprints of a key, and only counts leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tiffin.llm.text import Words, chunks, mix, shingles

BITS = 128
#: Fingerprints of one key that a task compares with one another, or with as many others.
TILE = 2_000
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def votes(hashes: np.ndarray) -> np.ndarray:
    """One row of BITS zeros and ones for each term hash."""
    both = np.stack([hashes, mix(hashes ^ _SECOND)], axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1)


def fingerprints(column: pa.Array) -> np.ndarray:
    """BITS / 8 bytes for each text of the column."""
    out = np.zeros((len(column), BITS // 8), np.uint8)
    for first, part in chunks(column, 1 << 20):
        words = Words(part, lower=True)
        count = np.diff(words.first)
        terms = shingles(words.hash, 2)
        single = words.first[:-1][count == 1]
        terms[single] = words.hash[single]
        last = words.first[1:][count > 1] - 1
        keep = np.ones(len(terms), bool)
        keep[last] = False
        terms = terms[keep]
        n = np.where(count > 1, count - 1, count)
        lanes = votes(terms).view(np.uint64)  # eight one-byte counters a lane: sums of up to 255 terms can't overflow
        begins = np.concatenate([[0], np.cumsum(n)])
        blocks = -(-n // 255)
        owner = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        if not len(owner):
            continue
        sums = np.add.reduceat(lanes, begins[owner] + 255 * number, axis=0).view(np.uint8).astype(np.int64)
        total = np.zeros((len(n), BITS), np.int64)
        filled = np.flatnonzero(blocks)
        total[filled] = np.add.reduceat(sums, (np.cumsum(blocks) - blocks)[filled], axis=0)
        out[first : first + len(part)] = np.packbits(2 * total > n[:, None], axis=1)
    return out


def as_hex(prints: np.ndarray) -> pa.Array:
    text = prints.tobytes().hex()
    size = BITS // 4
    return pa.array([text[i : i + size] for i in range(0, len(text), size)], pa.string())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each whole text in hexadecimal digits. A column named like ``out`` is replaced."""
    kept = [f.name for f in df.schema if f.name != out]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"`{out}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = as_hex(fingerprints(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), added], [*kept, out])

    return df.mapInArrow(run, schema)


def table_keys(prints: np.ndarray, radius: int) -> list[np.ndarray]:
    """The key of each fingerprint in each permuted table: the bits of two of radius + 2 blocks, as bytes."""
    bits = np.unpackbits(prints, axis=1)
    blocks = np.array_split(np.arange(BITS), radius + 2)
    return [np.packbits(bits[:, np.concatenate(two)], axis=1) for two in combinations(blocks, 2)]


def within_radius(prints: DataFrame, radius: int = 3, fingerprint: str = "fingerprint") -> DataFrame:
    """(fingerprint, n_near): for each distinct fingerprint, how many other ones lie within ``radius`` bits.

    Null fingerprints are left out; repeated ones count once; an empty table gives an empty result.
    """
    if not 0 <= radius <= BITS // 8:
        raise ValueError("radius out of range")
    distinct = prints.select(F.col(fingerprint).alias("fingerprint")).filter("fingerprint is not null").distinct()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hexes = batch.column(0).to_pylist()
            raw = np.frombuffer(bytes.fromhex("".join(hexes)), np.uint8).reshape(-1, BITS // 8)
            for t, keys in enumerate(table_keys(raw, radius)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t] * len(raw), pa.int32()),
                        pa.array([k.tobytes() for k in keys], pa.binary()),
                        pa.array([x.tobytes() for x in raw], pa.binary()),
                    ],
                    ["tab", "block", "print"],
                )

    entries = distinct.mapInArrow(spread, "tab int, block binary, print binary")
    crowd = entries.groupBy("tab", "block").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    tiles = F.ceil(F.col("crowd") / TILE).cast("int")
    own = F.pmod(F.xxhash64("print"), tiles).cast("int")
    tiled = (
        entries.join(crowd, ["tab", "block"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("tab", "block", "print", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    )

    def compare(table: pa.Table) -> pa.Table:
        t = table.column("tab")[0].as_py()
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        raw = np.frombuffer(b"".join(table.column("print").to_pylist()), np.uint8).reshape(-1, BITS // 8)
        own = table.column("own").to_numpy()
        keys = table_keys(raw, radius)
        wide = raw.view(np.uint64)
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        n = np.zeros(len(raw), np.int64)
        for begin in range(0, len(left), 256):
            rows = left[begin : begin + 256]
            near = np.bitwise_count(wide[rows][:, None, :] ^ wide[right][None, :, :]).sum(axis=2, dtype=np.int64) <= radius
            i, j = np.nonzero(near)
            i, j = rows[i], right[j]
            if a == b:
                i, j = i[i < j], j[i < j]
            # Each pair counts in the first table that joins it.
            for earlier in keys[:t]:
                fresh = (earlier[i] != earlier[j]).any(axis=1)
                i, j = i[fresh], j[fresh]
            n += np.bincount(i, minlength=len(raw)) + np.bincount(j, minlength=len(raw))
        some = np.flatnonzero(n)
        return pa.table({"fingerprint": pa.array([raw[x].tobytes().hex() for x in some], pa.string()), "n": pa.array(n[some])})

    found = tiled.groupBy("tab", "block", "a", "b").applyInArrow(compare, "fingerprint string, n long")
    near = found.groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
    return distinct.join(near, "fingerprint", "left").select("fingerprint", F.coalesce("n_near", F.lit(0)).alias("n_near"))


def _in_order(df: DataFrame, key: str, text: str) -> DataFrame:
    """(part, tail, key, text): the rows dealt by ranges of the key and sorted in each; the first rows of a range also stand, as its
    tail, behind the range before it, so that no task has to know of more than its own range."""
    spark = df.sparkSession
    top = (1 << 63) - 1
    rows = df.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("rank", F.coalesce(F.col("key").cast("long"), F.lit(top)))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(rows.filter("key is not null").approxQuantile("rank", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    cuts = np.array(cuts, np.float64)

    def part_of(rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(cuts, rank.astype(np.float64), "right").astype(np.int32)

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(0).to_numpy()
            part = part_of(rank)
            own = np.unique(part)
            least = [int(rank[part == p].min()) for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(least, pa.int64())], ["part", "least"])

    # One row for each range, whose number is a setting.
    found = rows.select("rank").mapInArrow(lowest, "part int, least long").groupBy("part").agg(F.min("least").alias("least")).collect()
    firsts = dict(sorted((r["part"], r["least"]) for r in found))
    parts = [*firsts]
    before = {firsts[p]: parts[i - 1] for i, p in enumerate(parts)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = np.array(sorted(before), np.int64)
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of(rank)), pa.array(np.zeros(len(rank), bool)), *batch.columns], ["part", "tail", *batch.schema.names]
            )
            also = np.flatnonzero(np.isin(rank, heads))
            if len(also):
                own = batch.take(pa.array(also))
                to = pa.array([before[int(r)] for r in rank[also]], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(also), bool)), *own.columns], ["part", "tail", *own.schema.names])

    kind = df.schema[key].dataType.simpleString()
    dealt = rows.mapInArrow(deal, f"part int, tail boolean, key {kind}, text string, rank long")
    ordered = dealt.repartition(n, "part").sortWithinPartitions("part", "tail", "rank", F.col("key").isNull(), "text")
    return ordered.select("part", "tail", "key", "text")


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """(keys, texts, next texts) of rows in order, a few megabytes at a time."""
    waiting = None  # the last row read, which still lacks its next text
    for batch in batches:
        for first, part in chunks(batch.column("text"), 2 << 20):
            out = []
            for number, tail, key, text in zip(*(c.to_pylist() for c in batch.slice(first, len(part)).columns), strict=True):
                if waiting is not None and waiting[0] == number:
                    out.append((waiting[1], waiting[2], text))
                waiting = None if tail else (number, key, text)
            if out:
                yield tuple(map(list, zip(*out, strict=True)))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next_text): each row with the text of the row after it in ascending order of ``key``; after the last, the first.

    Null keys come last; rows with equal keys are ordered by their texts, null texts as empty ones. A single row follows itself.
    """
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, after in _followed(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, to_arrow_type(kind)), pa.array(texts, pa.string()), pa.array(after, pa.string())], [key, text, "next_text"]
            )

    return _in_order(df, key, text).mapInArrow(run, f"`{key}` {kind.simpleString()}, `{text}` string, next_text string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points (rounded down) replaced by the first as many of the following text, or all of it."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next): each whole text against its edited form
    and against the next row's text (see ``with_next``)."""
    kind = df.schema[key].dataType
    names = [key, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, after in _followed(batches):
            changed = pa.array([edited(t, x) for t, x in zip(texts, after, strict=True)], pa.string())
            prints, other = fingerprints(pa.array(texts, pa.string())), fingerprints(changed)
            # The next text is nearly always that of the next row; only the others are fingerprinted here.
            apart = [i for i, x in enumerate(after) if i + 1 == len(texts) or texts[i + 1] != x]
            follow = np.roll(prints, -1, axis=0)
            follow[apart] = fingerprints(pa.array([after[i] for i in apart], pa.string()))
            size = pa.array([len(t) for t in texts], pa.int64())
            likes = [pa.array(likeness(prints, x)) for x in (other, follow)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, to_arrow_type(kind)), size, changed, as_hex(prints), as_hex(other), *likes], names)

    schema = (
        f"`{key}` {kind.simpleString()}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double,"
        " near_next double"
    )
    return _in_order(df, key, text).mapInArrow(run, schema)

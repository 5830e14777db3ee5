"""Exact Jaccard join of documents on word n-grams, returned as components.

A document's set holds the hashes of its n-word shingles (A-Z lower-cased); a shorter text is one shingle as a whole. Two
documents link if 100 * intersection >= percent * union.

1. Documents with equal sets form a class; the smallest id stands for it.
2. Size-derived bounds: two linked sets of sizes a and b differ in at most d = (a + b)(100 - percent) / (100 + percent) shingles. Sets of
   similar size are cut into d + 1 (and some spare) buckets by shingle hash, so linked sets agree in some bucket that is not empty
   (sets with more empty buckets than spare ones also give those). A bucket's content is its signature. Of a set's signatures the most
   frequent ones go, as many as linked sets share beyond the first; only documents that still share one are compared.
3. In each group of a shared signature everybody is first compared with the group's smallest id. That joins nearly all of a large
   group of copies in linear work. Blocks are rows of the document by n-gram matrix times the block's first row.
4. Groups that still hold several components are compared in full: blocked products of tiles of the incidence matrix accumulate overlap
   counts, and pairs below the bound are discarded. A block emits a spanning forest of its links.

Before texts are moved for steps 3 and 4, sketches of one byte a bucket rule out pairs that agree in fewer buckets than linked sets must.

No step holds a whole group: classes and signatures are reduced before the shuffle, blocks and tiles have bounded numbers of
documents. Shingles are compared by 64-bit hashes, sets by 128 bits.

Null texts, empty ones and texts without words have an empty set and link with nothing. Rows with equal ids count as one
document whose texts all link for it. Rows without an id link with nothing and have no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.graph import components
from tiffin.llm.sieve import sieved
from tiffin.llm.store import bounded_batches, bounded_broadcasts, stored
from tiffin.llm.text import Words, chunks, mix, ranges, shingles
from tiffin.session import freed_shuffles

#: Sizes of a class differ by this factor at most.
CLASS_RATIO = 1.5
#: Documents of a block beside its first one, and of a tile.
BLOCK = 256
TILE = 400
#: Documents of a tile of sketches, and their bytes together.
SKETCHES = 4_000
SKETCH_BYTES = 4 << 20
#: Columns of the incidence matrix multiplied at once.
COLUMNS = 4096
_CHUNK = 2 << 20
#: Bytes of rows that Python gets at once: a little less than two chunks, so that none is left with a few rows.
BATCH_BYTES = 7 << 19
#: Bytes of a table that the steps broadcast at most.
BROADCAST_BYTES = 1 << 20
#: Parts in which the rows of a class of equal sets meet.
CLASS_PARTS = 64
#: Signatures that a task sorts at once.
_SORTED = 1 << 18
#: A signature's bits above this one name its frame; 64 frames reach sets of 10 ** 10 shingles.
FRAME_SHIFT = 58
#: Signatures of at least so many sets are ordered by their frequency, the others by their bits alone.
FREQUENT = 4
_SALT = np.uint64(0xA24BAED4963EE407)


def sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, one after the other, and where each text's begin."""
    words = Words(column, lower=True)
    grams = shingles(words.hash, n)
    out = []
    for i in range(len(column)):
        a, b = words.first[i], words.first[i + 1]
        out.append(np.unique(grams[a : b - n + 1]) if b - a >= n else shingles(words.hash[a:b], int(b - a))[:1])
    sizes = np.array([len(x) for x in out], np.int64)
    return np.concatenate([*out, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum(sizes)])


def overlap_bound(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least number of shared shingles with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


class Frames:
    """Size classes and the buckets into which their sets are cut: all classes that a partner of a set of up to ``largest`` can be of,
    whether or not the caller holds such a partner."""

    def __init__(self, percent: int, largest: int):
        self.percent, self.low, self.high = percent, [], []
        low = 1
        while percent * low <= 100 * largest:
            high = max(low, int(low * CLASS_RATIO))
            self.low.append(low)
            self.high.append(high)
            low = high + 1
        high = np.array(self.high, np.int64)
        self.differ = 2 * high * (100 - percent) // (100 + percent)
        self.spare = 3 + (self.differ + 1) // 10
        self.buckets = self.differ + 1 + self.spare

    def of(self, sizes: np.ndarray) -> list[np.ndarray]:
        """For each frame the documents that may have a partner whose larger set is of that class."""
        return [
            np.flatnonzero((100 * sizes >= self.percent * low) & (sizes <= high) & (differ > 0))
            for low, high, differ in zip(self.low, self.high, self.differ, strict=True)
        ]

    def cut(self, grams: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(frame, documents, bucket places that are not empty, hashes of their contents); place = number in documents * buckets + bucket."""
        sizes = np.diff(first)
        for f, members in enumerate(self.of(sizes)):
            if not len(members):
                continue
            k, salt = int(self.buckets[f]), self.salt(f)
            own = grams[ranges(first[:-1][members], sizes[members])]
            place = np.repeat(np.arange(len(members)), sizes[members]) * k + (mix(own ^ salt) % np.uint64(k)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, own = place[order], mix(own[order] + salt)
            opens = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            filled = place[opens]
            yield f, members, filled, mix(np.add.reduceat(own, opens) ^ mix((filled % k).astype(np.uint64) ^ salt))

    @staticmethod
    def salt(f: int) -> np.uint64:
        return mix(np.array([f + 1], np.uint64) * _SALT)[0]

    def signatures(self, grams: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signature, document) of all documents, and an array of (document, frame, spare signatures). The frame is in a signature's top bits.

        Linked sets of a frame share one signature more than either has to spare: they agree in 1 + spare buckets, of which no more are
        empty than one of them has empty ones. A set that gives its empty buckets too has none to spare, as its partner may not give them.
        """
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        spared = [np.zeros((3, 0), np.int64)]
        for f, members, filled, content in self.cut(grams, first):
            k, top = int(self.buckets[f]), np.uint64(f << FRAME_SHIFT)
            found.append((content >> np.uint64(64 - FRAME_SHIFT) | top, members[filled // k]))
            empty = np.ones(len(members) * k, bool)
            empty[filled] = False
            empty = empty.reshape(-1, k)
            free = self.spare[f] - empty.sum(axis=1)
            bare, some = np.flatnonzero(free < 0), np.flatnonzero(free > 0)
            at, bucket = np.nonzero(empty[bare])
            content = mix(mix(bucket.astype(np.uint64) ^ self.salt(f)) + np.uint64(1))
            found.append((content >> np.uint64(64 - FRAME_SHIFT) | top, members[bare[at]]))
            spared.append(np.stack([members[some], np.full(len(some), f), free[some]]))
        return *(np.concatenate([x[i] for x in found]) for i in (0, 1)), np.concatenate(spared, axis=1)

    def sketches(self, grams: np.ndarray, first: np.ndarray) -> list[list[tuple[int, bytes]]]:
        """For each document its frames, each with one byte of every bucket's content hash (0 if empty)."""
        out: list[list[tuple[int, bytes]]] = [[] for _ in range(len(first) - 1)]
        for f, members, filled, content in self.cut(grams, first):
            k = int(self.buckets[f])
            table = np.zeros(len(members) * k, np.uint8)
            table[filled] = (content & np.uint64(0xFF)).astype(np.uint8)
            for row, doc in zip(table.reshape(-1, k), members.tolist(), strict=True):
                out[doc].append((f, row.tobytes()))
        return out

    @staticmethod
    def agree(k: np.ndarray | int, percent: int) -> int:
        """In how many of its k buckets linked sets agree at least: all but the shingles by which they can differ."""
        differ = 0
        while (differ + 1) + 1 + 3 + (differ + 2) // 10 <= k:
            differ += 1
        return int(k) - differ


def _signed(docs: DataFrame, n: int, percent: int, parts: int) -> DataFrame:
    """(kind, a, b, c, d): kind 0 are (signature, id) of signatures that at least two sets have, kind 1 (id, size, hash, hash) of all rows,
    kind 2 (id, frame, spare signatures) of sets that have spare ones.

    A task sends a signature once, however many of its documents have it; the others are known to share it.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in chunks(batch.column(1), _CHUNK):
                ids = batch.column(0).slice(begin, len(part)).to_numpy()
                grams, first = sets(part, n)
                sizes = np.diff(first)
                one = np.zeros(len(part), np.uint64)
                two = sizes.astype(np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    one[full] = np.add.reduceat(mix(grams), first[:-1][full])
                    two[full] += np.add.reduceat(mix(grams ^ _SALT), first[:-1][full])
                info = np.stack([ids, sizes, one.view(np.int64), two.view(np.int64)], axis=1)
                order = np.lexsort((ids, two, one))
                fresh = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
                keep = np.sort(order[fresh])  # one document of each class
                frames = Frames(percent, int(sizes.max(initial=0)))
                sign, doc, spared = frames.signatures(grams[ranges(first[:-1][keep], sizes[keep])], np.concatenate([[0], np.cumsum(sizes[keep])]))
                order = np.argsort(sign, kind="stable")
                sign, owner = sign[order], ids[keep][doc[order]]
                heads = np.concatenate([[True], sign[1:] != sign[:-1]]) if len(sign) else np.zeros(0, bool)
                shared = np.diff(np.append(np.flatnonzero(heads), len(sign))) > 1
                head = np.stack([sign[heads].view(np.int64), owner[heads], shared.astype(np.int64)], axis=1)
                to = (sign[heads] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                edges = np.searchsorted(to[order], np.arange(parts + 1))
                rows = [(p, 0, head[order[i:j]]) for p, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if j > i]
                spread = int(mix(ids[:1].view(np.uint64))[0] % np.uint64(parts))
                more = np.stack([sign[~heads].view(np.int64), owner[~heads]], axis=1)
                spared[0] = ids[keep][spared[0]]
                rows += [(spread, 1, more), (spread, 2, info), (spread, 3, spared.T)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([np.ascontiguousarray(r[2].T).tobytes() for r in rows], pa.binary()),
                    ],
                    ["part", "kind", "body"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
            full = [*columns, *[np.zeros(len(columns[0]), np.int64)] * (4 - len(columns))]
            for i in range(0, len(columns[0]), 100_000):
                own = [pa.array(np.ascontiguousarray(c[i : i + 100_000])) for c in full]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[0]), kind, np.int32)), *own], ["kind", "a", "b", "c", "d"])

        held = []
        for batch in batches:
            for kind, body in zip(batch.column("kind").to_pylist(), batch.column("body"), strict=True):
                rows = np.frombuffer(body.as_buffer(), np.int64).reshape({0: 3, 1: 2, 2: 4, 3: 3}[kind], -1)
                if kind == 0:
                    held.append(rows)
                elif kind == 1:
                    yield from table(0, *rows)
                else:
                    yield from table(kind - 1, *rows)
        # By ranges of the hash, so that beside what was sent only a bounded number is copied and sorted at a time.
        cuts = -(-sum(rows.shape[1] for rows in held) // _SORTED)
        for k in range(cuts):
            low, high = (np.uint64(((1 << 64) - 1) // cuts * x) for x in (k, k + 1))
            picked = []
            for rows in held:
                own = mix(rows[0].view(np.uint64).copy())
                inside = own >= low if k == cuts - 1 else (own >= low) & (own < high)
                picked.append(rows[:, inside])
            sign, owner, shared = np.concatenate(picked, axis=1)
            if not len(sign):
                continue
            order = np.argsort(sign, kind="stable")
            sign, owner, shared = sign[order], owner[order], shared[order]
            heads = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
            count = np.diff(np.append(heads, len(sign)))
            wanted = np.repeat((count > 1) | (np.maximum.reduceat(shared, heads) > 0), count)
            yield from table(0, sign[wanted], owner[wanted])

    dealt = docs.mapInArrow(deal, "part int, kind int, body binary").repartition(parts, "part")
    return dealt.mapInArrow(gather, "kind int, a long, b long, c long, d long")


def _classes(sized: DataFrame) -> DataFrame:
    """(id, rep, size) of (id, size, h1, h2): the smallest id of the rows with equal hashes. A class of very many rows is met in parts."""
    parted = sized.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(CLASS_PARTS)).cast("int"))
    least = parted.groupBy("h1", "h2", "part").agg(F.min("id").alias("rep"))
    named = least.groupBy("h1", "h2").agg(F.min("rep").alias("rep"), F.collect_set("part").alias("parts"))
    named = named.select("h1", "h2", "rep", F.explode("parts").alias("part"))
    return parted.join(named, ["h1", "h2", "part"]).select("id", "rep", "size").distinct()


def _needed(shared: DataFrame, spared: DataFrame) -> DataFrame:
    """The rows (sign, rep, size) without the most frequent signatures of each set and frame, as many as ``spared`` (rep, frame, free) says.

    In any order of all signatures the first one that two linked sets share has as many shared ones after it as either may spare, so it
    stays with both: no link is lost. What goes is mainly what passages shared by many documents give.
    """
    often = shared.groupBy("sign").agg(F.count("*").alias("times")).filter(F.col("times") >= FREQUENT)
    rows = shared.join(often, "sign", "left").withColumn("frame", F.shiftrightunsigned("sign", FRAME_SHIFT))
    order = Window.partitionBy("rep", "frame").orderBy(F.desc_nulls_last("times"), "sign")
    ranked = rows.join(spared, ["rep", "frame"], "left").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") > F.coalesce("free", F.lit(0))).select("sign", "rep", "size")


def _verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v) of the pairs (u, v) that link. A block is one u with a bounded number of its v."""
    crowd = pairs.groupBy("u").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cut"))
    rows = pairs.join(crowd, "u").withColumn("block", F.pmod(F.xxhash64("v"), "cut"))
    sides = rows.select("u", "block", F.lit(1).alias("side"), F.col("v").alias("id")).unionAll(
        rows.select("u", "block", F.lit(0).alias("side"), F.col("u").alias("id")).distinct()
    )
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = pairs.select(F.explode(F.array("u", "v")).alias("id"))
    asked = sieved(texts, "id", ids).filter("_may").select("id", "text")
    ordered = sides.join(asked, "id").select("u", "block", "side", "id", "text").repartition(parts, "u", "block").sortWithinPartitions("u", "block", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, heads = None, []  # the sets of the block's first document
        for batch in batches:
            for begin, part in chunks(batch.column("text"), _CHUNK):
                own = batch.slice(begin, len(part))
                keys = [*zip(own.column("u").to_pylist(), own.column("block").to_pylist(), strict=True)]
                sides_ = own.column("side").to_numpy()
                grams, first = sets(part, n)
                ids, out = own.column("id").to_numpy(), []
                edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
                for i, j in zip(edges, edges[1:], strict=False):
                    if keys[i] != block:
                        block, heads = keys[i], []
                    heads += [grams[first[r] : first[r + 1]] for r in range(i, j) if sides_[r] == 0]
                    rest = np.arange(i, j)[sides_[i:j] == 1]
                    if not len(rest):
                        continue
                    sizes = first[rest + 1] - first[rest]
                    flat = grams[first[rest[0]] : first[rest[-1] + 1]]
                    for head in heads:
                        if not len(head):
                            continue
                        at = np.minimum(np.searchsorted(head, flat), len(head) - 1)
                        sums = np.concatenate([[0], np.cumsum(head[at] == flat)])
                        low = first[rest] - first[rest[0]]
                        shared = sums[low + sizes] - sums[low]
                        out += [(block[0], int(x)) for x in ids[rest[(shared >= overlap_bound(sizes, len(head), percent)) & (sizes > 0)]]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])

    return ordered.mapInArrow(run, "u long, v long").distinct()


def _sketched(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, frame, sketch) of all texts, a row for each frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in chunks(batch.column("text"), _CHUNK):
                ids = batch.column("id").slice(begin, len(part)).to_pylist()
                grams, first = sets(part, n)
                own = Frames(percent, int(np.diff(first).max(initial=0))).sketches(grams, first)
                rows = [(i, f, v) for i, frames in zip(ids, own, strict=True) for f, v in frames]
                kinds = pa.int64(), pa.int32(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["id", "frame", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "id long, frame int, sketch binary")


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sketches agree in as many buckets as those of linked sets must. No linked pair is lost: equal buckets have equal
    bytes."""
    rows = (
        pairs.join(sketches.select(F.col("id").alias("u"), "frame", F.col("sketch").alias("a")), "u")
        .join(sketches.select(F.col("id").alias("v"), "frame", F.col("sketch").alias("b")), ["v", "frame"])
        .select("u", "v", "a", "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed: dict[int, int] = {}
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"), strict=True)):
                a, b = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                if len(a) not in needed:
                    needed[len(a)] = Frames.agree(len(a), percent)
                if np.count_nonzero(a == b) >= needed[len(a)]:
                    keep.append(i)
            yield batch.select(["u", "v"]).take(pa.array(keep, pa.int64()))

    return rows.mapInArrow(run, "u long, v long").distinct()


def _near(clusters: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(u, v): a spanning forest, for every block, of the pairs of a cluster's documents whose sketches agree enough to link. ``clusters``
    has (id, cluster, frame, component); a block is a pair of tiles of the documents of a cluster."""
    rows = clusters.join(sketches, ["id", "frame"])
    rows_ = F.count("*")
    tiles = F.greatest(F.ceil(rows_ / SKETCHES), F.ceil(rows_ * F.max(F.length("sketch")) / SKETCH_BYTES))
    crowd = rows.groupBy("cluster", "frame").agg(tiles.cast("int").alias("tiles"), rows_.alias("n"))
    tiled = rows.join(crowd.filter("n > 1"), ["cluster", "frame"]).withColumn("own", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "cluster", "frame", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component", "sketch"
    )
    parts = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["cluster", "frame", "i", "j"]
    blocks = tiled.repartition(parts, *keys).sortWithinPartitions(*keys, "own", "id")

    def solve(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        own, ids, parent = (np.array([r[k] for r in rows]) for k in (0, 1, 2))
        table = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
        left, right = np.flatnonzero(own == key[2]), np.flatnonzero(own == key[3])
        needed, a, b = Frames.agree(table.shape[1], percent), [], []
        step = max(1, 4_000_000 // (len(right) * table.shape[1] + 1))
        for at in range(0, len(left), step):
            some = left[at : at + step]
            x, y = np.nonzero((table[some][:, None, :] == table[right][None, :, :]).sum(axis=2) >= needed)
            apart = parent[some[x]] != parent[right[y]]
            a.append(some[x[apart]])
            b.append(right[y[apart]])
        if not a:
            return []
        a, b = np.concatenate(a), np.concatenate(b)
        return [(int(ids[a[k]]), int(ids[b[k]])) for k in _forest(a, b, len(rows))]

    return blocks.mapInArrow(_by_block(len(keys), solve), "u long, v long").distinct()


def _by_block(width: int, solve):
    """Runs ``solve(key, rows)`` on each run of rows whose first ``width`` columns are equal; a block may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])

        def tuples(part: pa.RecordBatch) -> Iterator[tuple]:
            return zip(*(c.to_pylist() for c in part.columns), strict=True)

        key, rows = None, []
        for values in (x for batch in batches for at in range(0, batch.num_rows, TILE) for x in tuples(batch.slice(at, TILE))):
            if values[:width] != key:
                if rows and (out := [*solve(key, rows)]):
                    yield packed(out)
                key, rows = values[:width], []
            rows.append(values[width:])
        if rows and (out := [*solve(key, rows)]):
            yield packed(out)

    return run


def tile_links(grams: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether the documents left[i] and right[j] link: overlaps from a product of the two tiles of the incidence matrix, a block of columns
    at a time. Columns with a single document in all are left out."""
    sizes = np.diff(first)
    every = np.concatenate([left, right])
    own = grams[ranges(first[:-1][every], sizes[every])]
    row = np.repeat(np.arange(len(every)), sizes[every])
    _, column, times = np.unique(own, return_inverse=True, return_counts=True)
    several = times[column] > 1
    rank = np.cumsum(times > 1) - 1
    column, row = rank[column[several]], row[several]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int((times > 1).sum()), COLUMNS):
        i, j = np.searchsorted(column, [begin, begin + COLUMNS])
        dense = np.zeros((len(every), COLUMNS), np.float32)
        dense[row[i:j], column[i:j] - begin] = 1
        total += dense[: len(left)] @ dense[len(left) :].T
    a, b = sizes[left][:, None], sizes[right][None, :]
    return (total >= overlap_bound(a, b, percent)) & (a > 0) & (b > 0)


def _forest(u: np.ndarray, v: np.ndarray, nodes: int) -> list[int]:
    """Numbers of the edges of a spanning forest."""
    up = [*range(nodes)]

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for k, (a, b) in enumerate(zip(u.tolist(), v.tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            up[b] = a
            out.append(k)
    return out


def _products(clusters: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v): a spanning forest of the links between documents of a cluster that are not joined yet. ``clusters`` has (id, cluster,
    component). Every pair of tiles of a cluster is a block."""
    crowd = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = clusters.join(crowd, "cluster").withColumn("own", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component"
    )
    parts = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["cluster", "i", "j"]
    asked = sieved(texts, "id", clusters.select("id")).filter("_may").select("id", "text")
    blocks = tiled.join(asked, "id").repartition(parts, *keys).sortWithinPartitions(*keys, "own", "id")

    def solve(key: tuple, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        grams, first = sets(pa.array([r[3] for r in rows], pa.large_string()), n)
        own, ids, parent = (np.array([r[k] for r in rows]) for k in (0, 1, 2))
        left, right = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
        linked = tile_links(grams, first, left, right, percent)
        a, b = np.nonzero(linked)
        a, b = left[a], right[b]
        apart = (parent[a] != parent[b]) & (a != b)
        a, b = a[apart], b[apart]
        _, node = np.unique(parent, return_inverse=True)
        for k in _forest(node[a], node[b], len(rows)):
            yield int(ids[a[k]]), int(ids[b[k]])

    return blocks.select(*keys, "own", "id", "component", "text").mapInArrow(_by_block(len(keys), solve), "u long, v long")


def join_components(df: DataFrame, row_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(row_id, n_shingles, component_id) of every row: the size of its set, and the smallest id that links reach, its own included."""
    if not 50 <= percent <= 100 or n < 1:
        raise ValueError("percent must lie in 50 .. 100 and n be positive")
    spark = df.sparkSession
    with bounded_batches(spark, BATCH_BYTES), bounded_broadcasts(spark, BROADCAST_BYTES), freed_shuffles(spark):
        return _joined(df, row_id, text, n, percent)


def _joined(df: DataFrame, row_id: str, text: str, n: int, percent: int) -> DataFrame:
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = df.select(F.col(row_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = docs.filter("id is not null")
    done = stored(_signed(named, n, percent, parts), "ngram-signatures")
    info = done.filter("kind = 1").select(F.col("a").alias("id"), F.col("b").alias("size"), F.col("c").alias("h1"), F.col("d").alias("h2"))
    member = stored(_classes(info.filter("size > 0")), "ngram-classes", small=True)
    spared = (
        done.filter("kind = 2")
        .select(F.col("a").alias("id"), F.col("b").cast("bigint").alias("frame"), F.col("c").alias("free"))
        .join(member.select("id", "rep"), "id")
        .groupBy("rep", "frame")
        .agg(F.min("free").alias("free"))
    )
    signed = stored(
        done.filter("kind = 0").select(F.col("a").alias("sign"), F.col("b").alias("id")).join(member, "id").select("sign", "rep", "size").distinct(),
        "ngram-signed",
    )
    shared = stored(_needed(signed, spared), "ngram-shared")
    several = shared.groupBy("sign").agg(F.min(F.struct("rep", "size")).alias("p"), F.max("rep").alias("top"))
    pivot = several.filter("p.rep <> top").select("sign", "p")
    grouped = stored(shared.join(pivot, "sign"), "ngram-grouped")
    wanted = stored(grouped.select(F.col("rep").alias("id")).distinct(), "ngram-wanted", small=True)
    asked = sieved(named, "id", wanted).filter("_may").select("id", "text")
    texts = stored(asked.join(wanted, "id", "left_semi"), "ngram-texts")
    pairs = (
        grouped
        .filter("rep <> p.rep")
        .filter(100 * F.least("size", "p.size") >= percent * F.greatest("size", "p.size"))
        .select(F.col("p.rep").alias("u"), F.col("rep").alias("v"))
        .distinct()
    )
    sketches = stored(_sketched(texts, n, percent), "ngram-sketches")
    likely = stored(_likely(pairs, sketches, percent), "ngram-pairs")
    links = stored(_verify(likely, texts, n, percent), "ngram-links")
    near = components(links, "u", "v")
    placed = stored(
        grouped.join(near.withColumnRenamed("node", "rep"), "rep", "left").select("sign", "rep", F.coalesce("component", "rep").alias("component")),
        "ngram-placed",
    )
    open_ = placed.groupBy("sign").agg(F.min("component").alias("lowest"), F.max("component").alias("highest"), F.min("rep").alias("first")).filter("lowest <> highest")
    # Groups meet in a cluster only through documents of one frame. Two nodes of one hash would but put two clusters together.
    framed = placed.join(open_.select("sign", "first"), "sign").withColumn("frame", F.shiftrightunsigned("sign", FRAME_SHIFT).cast("int"))
    rest = stored(
        framed.select(
            F.col("rep").alias("id"), "frame", "component", F.xxhash64("rep", "frame").alias("node"), F.xxhash64("first", "frame").alias("first")
        ).distinct(),
        "ngram-open",
    )
    if rest.limit(1).count():
        crowds = components(rest, "node", "first").withColumnRenamed("component", "cluster")
        placed = rest.select("id", "frame", "component", "node").distinct()
        crowded = stored(placed.join(crowds, "node").select("id", "frame", "component", "cluster"), "ngram-crowds")
        alone = placed.select("id", "component").distinct()
        # Sharing a passage is enough to share a signature; the sketches leave those that may well link.
        close = components(stored(_near(crowded, sketches, percent), "ngram-close"), "u", "v")
        clusters = stored(alone.join(close.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id"), "ngram-clusters")
        links = stored(links.unionAll(_products(clusters, texts, n, percent)), "ngram-links")
        near = components(links, "u", "v")
    # An id that stands for several sets ties their classes together.
    ties = member.select(F.col("id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    several = member.groupBy("id").agg(F.countDistinct("rep").alias("n")).filter("n > 1").select(F.col("id").alias("a"))
    bridges = ties.join(several, "a", "left_semi")
    if bridges.limit(1).count():
        near = components(near.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(bridges))
    by_id = member.join(near.withColumnRenamed("node", "rep"), "rep", "left").groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    rows = info.select("id", "size").join(by_id, "id", "left").select(
        F.col("id").alias(row_id), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    unnamed = docs.filter("id is null").mapInArrow(_sizes(n), "id long, size long")
    return rows.unionAll(unnamed.select(F.col("id").alias(row_id), F.col("size").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))


def _sizes(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in chunks(batch.column(1), _CHUNK):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(part)), pa.array(np.diff(sets(part, n)[1]))], ["id", "size"])

    return run

"""Removal of passages that repeat an earlier passage, word by word.

A window is ``window`` consecutive words of one text. A word goes if a window that covers it also starts earlier: in a row with a smaller
id, or earlier in the same text. Windows are judged on the input.

1. Every window has an anchor, the smallest hash among its 4-word shingles (the leftmost of equals). Neighbouring windows with the same
   anchor form a segment. Equal windows have equal anchors, so a shard per anchor hash sees all windows it has to compare.
2. Segments that occur several times within a task are sent once; the others are known repeats. Anchors that stand in a large share
   of all segments (at most 20,000 such, found in a first pass) are dealt out window by window instead.
3. A shard builds an FM-index over the segments whose anchors occur more than once, and streams the same segments through it: backward
   search over the wavelet matrix gives the matching statistics of every position, and the first place in the shard of each match
   that reaches the window's length. Windows with an earlier place are reported as intervals.
4. The intervals of a row meet its text by id, and its words are kept or removed.

Words are compared by 64-bit hashes. Null texts and texts shorter than a window keep all their words. Rows without an id are
kept whole and compared with nothing. Rows that are equal in id and text are one row's text and get equal results; rows that
share an id but not the text count as different texts, ordered by the checksum of the text. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.fm_index import FMIndex
from tiffin.llm.store import stored
from tiffin.llm.text import Words, chunks, mix, ranges, shingles

WINDOW = 20
ANCHOR = 4
#: Segments of a shard on average, about a million words.
SHARD_SEGMENTS = 35_000
#: An anchor with more than this share of all segments is dealt out by windows; so there are at most as many as its inverse.
HOT_SHARE = 1 / 20_000
_CHUNK = 4 << 20
_META = np.dtype([("id", "<i8"), ("tag", "<u4"), ("at", "<u4"), ("words", "<u2")])
_ODD = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_ODD, -1, 1 << 64)
    return tuple(
        np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, p, np.uint64))]) for p in (_ODD, inverse)
    )


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of the ``width`` values from each position on, the leftmost of equals."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        other, there = best[step:], at[step:]
        smaller = other < best[: len(other)]
        at = np.where(smaller, there, at[: len(other)])
        best = np.where(smaller, other, best[: len(other)])
        have += step
    return at


class Segments:
    """Segments of the texts of one chunk: the windows from ``begin[i]`` on, ``windows[i]`` of them, with their shard key and a hash of
    all their words; ``text[i]`` is the number of the text."""

    def __init__(self, words: Words, window: int, anchor: int, hot: np.ndarray):
        count = np.diff(words.first)
        long = np.flatnonzero(count >= window)
        anchor = min(anchor, window)
        begin = ranges(words.first[:-1][long], count[long] - window + 1)
        owner = np.repeat(long, count[long] - window + 1)
        if not len(begin):
            self.begin = self.windows = self.text = np.zeros(0, np.int64)
            self.key = self.content = np.zeros(0, np.uint64)
            return
        grams = shingles(words.hash, anchor)
        at = _leftmost_least(grams, window - anchor + 1)[begin]
        opens = np.ones(len(begin), bool)
        opens[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        power, inverse = _powers(len(words.hash))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hash * power[:-1], dtype=np.uint64)])
        key = grams[at]
        if len(hot):
            alone = np.isin(key, hot)
            opens |= alone
            key = np.where(alone, mix((sums[begin + window] - sums[begin]) * inverse[begin]), key)
        first = np.flatnonzero(opens)
        self.windows = np.diff(np.append(first, len(begin)))
        self.begin, self.text, self.key = begin[first], owner[first], key[first]
        end = self.begin + self.windows + window - 1
        whole = (sums[end] - sums[self.begin]) * inverse[self.begin]
        # Segments are equal only if their anchors stand at the same place in them.
        self.content = mix(whole ^ mix(((at[first] - self.begin) << 32 | self.windows).astype(np.uint64)))


def _ordered(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(ids, tags, texts) of chunks of a batch of (id, text) without null ids, in the order of ids."""
    for first, part in chunks(batch.column(1), _CHUNK):
        ids = batch.column(0).slice(first, len(part)).to_numpy()
        tags = np.array([zlib.crc32(t.as_buffer()) for t in part], np.uint32)
        order = np.lexsort((tags, ids))
        yield ids[order], tags[order], part.take(pa.array(order))


def _crowded(rows: DataFrame, window: int, anchor: int) -> tuple[np.ndarray, int]:
    """Anchors with a large share of the segments, and how many segments there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _ordered(batch):
                found = Segments(Words(texts), window, anchor, np.zeros(0, np.uint64))
                _, once = np.unique(found.content, return_index=True)
                keys, n = np.unique(found.key[once], return_counts=True)
                many = n >= max(2, len(once) * HOT_SHARE / 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*keys[many].view(np.int64).tolist(), None], pa.int64()),
                        pa.array([*n[many].tolist(), len(once)], pa.int64()),
                    ],
                    ["key", "n"],
                )

    counts = stored(rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "anchors")
    total = counts.filter("key is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = counts.filter(F.col("key").isNotNull() & (F.col("n") > total * HOT_SHARE) & (F.col("n") > 100)).select("key").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64)), total


def _pack(rows: np.ndarray, texts: list[bytes]) -> bytes:
    """Segments as one compressed block: ids as differences, and each byte of a column by itself, as most of them are zero."""
    parts = [len(rows).to_bytes(8, "little")]
    for name in _META.names:
        column = np.diff(rows[name], prepend=rows[name].dtype.type(0)) if name == "id" else np.ascontiguousarray(rows[name])
        parts.append(column.view(np.uint8).reshape(len(rows), column.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=6).compress(b"".join([*parts, *texts]))


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int.from_bytes(raw[:8], "little"), 8
    rows = np.empty(n, _META)
    for name in _META.names:
        size = _META[name].itemsize
        column = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(_META[name])[:, 0]
        rows[name] = np.cumsum(column) if name == "id" else column
        at += n * size
    return rows, raw[at:]


def _deal(rows: DataFrame, window: int, anchor: int, hot: np.ndarray, shards: int) -> DataFrame:
    """(shard, part, id, tag, at, n): packed segments for the shards, and intervals already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tags, texts in _ordered(batch):
                words = Words(texts)
                found = Segments(words, window, anchor, hot)
                if not len(found.begin):
                    continue
                _, once, inverse = np.unique(found.content, return_index=True, return_inverse=True)
                at = found.begin - words.first[found.text]
                earlier = once[inverse]
                moved = (ids[found.text] != ids[found.text[earlier]]) | (tags[found.text] != tags[found.text[earlier]]) | (at != at[earlier])
                again = np.flatnonzero(moved)
                # All words of the chunk with one blank behind each, so that a segment is one slice.
                size = words.end - words.start + 1
                small = np.int32 if len(words.data) < 1 << 30 else np.int64
                lines = np.append(words.data, np.uint8(32))[ranges(words.start, size, small)]
                after = np.concatenate([[0], np.cumsum(size)])
                lines[after[1:] - 1] = 32
                buffer = lines.tobytes()
                once = once[np.argsort(found.key[once] % np.uint64(shards), kind="stable")]
                meta = np.zeros(len(once), _META)
                meta["id"], meta["tag"] = ids[found.text[once]], tags[found.text[once]]
                meta["at"] = at[once]
                meta["words"] = found.windows[once] + window - 1
                low, high = after[found.begin[once]], after[found.begin[once] + meta["words"]]
                shard = (found.key[once] % np.uint64(shards)).astype(np.int64)
                edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
                blobs = [
                    _pack(meta[i:j], [buffer[a:b] for a, b in zip(low[i:j].tolist(), high[i:j].tolist(), strict=True)])
                    for i, j in zip(edges[:-1], edges[1:], strict=True)
                ]
                known = np.zeros(len(again), _META)
                known["id"], known["tag"] = ids[found.text[again]], tags[found.text[again]]
                known["at"], known["words"] = at[again], found.windows[again] + window - 1
                # Known repeats travel with the shard of their first segment's number, whatever their anchor.
                places = shard[edges[:-1]].tolist()
                extra = _pack(known, [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*places, int(mix(ids[:1].view(np.uint64))[0] % np.uint64(shards))], pa.int64()),
                        pa.array([True] * len(places) + [False]),
                        pa.array([*blobs, extra], pa.binary()),
                    ],
                    ["shard", "open", "blob"],
                )

    return rows.mapInArrow(run, "shard long, open boolean, blob binary")


def repeats(meta: np.ndarray, text: bytes, window: int, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the segment, first window, windows) of the intervals of windows that start earlier in some segment of the shard."""
    none = np.zeros(0, np.int64)
    words = Words(pa.array([text], pa.large_binary())).hash
    start = np.concatenate([[0], np.cumsum(meta["words"].astype(np.int64))])[:-1]
    if not len(meta):
        return none, none, none
    # A segment's anchor is the least of all its shingles; segments whose anchor is theirs alone share no window with others.
    anchor = min(anchor, window)
    inside = meta["words"].astype(np.int64) - anchor + 1
    least = np.minimum.reduceat(shingles(words, anchor)[ranges(start, inside)], np.cumsum(inside) - inside)
    _, inverse, times = np.unique(least, return_inverse=True, return_counts=True)
    order = np.lexsort((meta["at"], meta["tag"], meta["id"]))
    order = order[times[inverse[order]] > 1]
    if len(order):
        # The same segment of a repeated row.
        place = meta[order]
        order = order[np.concatenate([[True], place[1:] != place[:-1]])]
    length = meta["words"][order].astype(np.int64)
    if len(order) < 2:
        return none, none, none
    own = words[ranges(start[order], length)]
    symbols = np.unique(own, return_inverse=True)[1].astype(np.int64) + 1
    ends = np.cumsum(length + 1)
    begin = ends - length - 1
    flat = np.zeros(int(ends[-1]), np.int64)
    flat[ranges(begin, length)] = symbols
    index = FMIndex(flat, window)
    _, group = index.matching(flat, begin, length)
    here = np.flatnonzero(group >= 0)
    late = here[index.group_first[group[here]] < here]
    if not len(late):
        return none, none, none
    owner = np.searchsorted(ends, late, "right")
    opens = np.ones(len(late), bool)
    opens[1:] = (np.diff(late) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(opens)
    return order[owner[first]], late[first] - begin[owner[first]], np.diff(np.append(first, len(late)))


def repeated_intervals(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """(row_id, tag, at, n): words at .. at + n - 1 of a text repeat earlier words. ``tag`` is the CRC-32 of the text. Intervals of a row may
    overlap."""
    if window < 2:
        raise ValueError("a window has two words at least")
    spark = df.sparkSession
    rows = df.filter(F.col(row_id).isNotNull() & F.col(text).isNotNull()).select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    hot, total = _crowded(rows, window, anchor)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_SEGMENTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def intervals(meta, at, n) -> pa.RecordBatch:
            columns = [meta["id"], meta["tag"].astype(np.int64), at.astype(np.int64), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tag", "at", "n"])

        metas, texts = [], []
        for batch in batches:
            for opened, blob in zip(batch.column("open").to_pylist(), batch.column("blob"), strict=True):
                meta, body = _unpack(blob.as_buffer())
                if opened:
                    metas.append(meta)
                    texts.append(body)
                elif len(meta):
                    yield intervals(meta, meta["at"], meta["words"])
        if metas:
            meta = np.concatenate(metas)
            owner, first, n = repeats(meta, b"".join(texts), window, anchor)
            if len(owner):
                yield intervals(meta[owner], meta["at"][owner] + first, n + window - 1)

    dealt = _deal(rows, window, anchor, hot, shards).repartition(shards, "shard")
    return dealt.mapInArrow(run, "id long, tag long, at long, n long")


def remove_repeats(
    df: DataFrame, row_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Each row with n_words, n_removed and kept (the words that stay, joined by blanks) in place of its text."""
    found = repeated_intervals(df, row_id, text, window, anchor)
    # A row's intervals are bounded by its own words.
    by_row = found.groupBy("id").agg(F.collect_list(F.struct("tag", "at", "n")).alias("_cut")).withColumnRenamed("id", "_id")
    joined = df.join(by_row, F.col(row_id).cast("long") == F.col("_id"), "left").drop("_id")
    kept = [f.name for f in df.schema if f.name not in (text, "n_words", "n_removed", "kept")]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), "n_words long, n_removed long, kept string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column(text), _CHUNK):
                own = batch.slice(first, len(part))
                cuts = own.column("_cut")
                totals, gone, out = [], [], []
                for i, value in enumerate(part):
                    raw = value.as_buffer().to_pybytes()
                    words = raw.split()
                    stay = np.ones(len(words), bool)
                    if cuts[i].is_valid:
                        rows = cuts[i].values
                        tag, at, n = (rows.field(j).to_numpy() for j in range(3))
                        mine = tag == zlib.crc32(raw)
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, at[mine], 1)
                        np.add.at(edge, at[mine] + n[mine], -1)
                        stay = np.cumsum(edge)[:-1] == 0
                        words = [words[j] for j in np.flatnonzero(stay)]
                    totals.append(len(stay))
                    gone.append(len(stay) - len(words))
                    out.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in kept), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())],
                    [*kept, "n_words", "n_removed", "kept"],
                )

    return joined.mapInArrow(run, schema)

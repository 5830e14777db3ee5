"""Benchmark decontamination: which documents hold passages of which benchmark items.

1. Windows of the items' sizes slide over every document. A window's fingerprint is the SimHash of its neighbouring word pairs, from running
   counts of votes, so a window costs the same whatever its size. Item sizes within ``SIZE_STEP`` of each other share a window
   size; windows advance by a ``STRIDE``-th of their size.
2. Multi-index Hamming blocks: fingerprints are cut into ``BLOCKS`` blocks; two of them within the radius differ by at most
   radius // BLOCKS bits in some block. A table for each block lists every value that close to an item, so looking a window up
   misses no item fingerprint within the radius.
3. Candidates are verified exactly: the weighted share of the item's 5-word shingles that occur in the window and its margin must
   be at least the threshold (0.8). A shingle that several items hold weighs as much less.

Words are lower-cased runs of letters, digits and non-ASCII characters, so punctuation and markup do not hide a passage. Items of
fewer than five such words have no shingle and are linked with nothing, as are null and empty texts. Items travel with the tasks in
blocks of at most ``BLOCK_WORDS`` words; more blocks mean more passes. Repeated documents and items each count for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.text import PLAIN, Words, chunks, shingles

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 18
BLOCKS = 4
SIZE_STEP = 1.07
STRIDE = 9
#: Words of the items that travel with the tasks at once.
BLOCK_WORDS = 2_000_000
#: Words of documents that a task holds votes for at once.
SPAN = 200_000


def _votes(words: np.ndarray) -> np.ndarray:
    """64 zeros and ones for each pair of neighbouring words."""
    return np.unpackbits(np.ascontiguousarray(shingles(words, 2)[:, None]).view(np.uint8), axis=1)


def _print_of(ones: np.ndarray, pairs: int) -> np.ndarray:
    return np.packbits(ones > pairs // 2, axis=1).view(np.uint64)[:, 0]


class Items:
    """A block of benchmark items: fingerprints by window size, block tables, weighted shingles."""

    def __init__(self, ids: list, texts: list[str | None], radius: int):
        words = Words(pa.array([t or "" for t in texts], pa.string()), lower=True, blank=PLAIN)
        own = [(i, words.text(i)) for i in range(len(ids)) if len(words.text(i)) >= SHINGLE]
        self.ids, self.radius = [ids[i] for i, _ in own], radius
        grams = [np.unique(shingles(w, SHINGLE)[: len(w) - SHINGLE + 1]) for _, w in own]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        #: Sorted shingles of all items, and which items hold each: owner[begin[g] : begin[g + 1]].
        self.gram, times = np.unique(every, return_counts=True)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(own)), [len(g) for g in grams])[order]
        self.begin = np.concatenate([[0], np.cumsum(times)])
        self.weight = 1.0 / times
        self.total = np.bincount(self.owner, np.repeat(self.weight, times), len(own)) if own else np.zeros(0)
        size = np.array([len(w) for _, w in own], np.int64)
        prints = [_print_of(_votes(w)[:-1].sum(axis=0, dtype=np.int64)[None, :], len(w) - 1)[0] for _, w in own]
        self.print = np.array(prints, np.uint64)
        self.classes = []
        left = np.argsort(size, kind="stable")
        while len(left):
            near = left[size[left] <= max(size[left[0]], int(size[left[0]] * SIZE_STEP))]
            self.classes.append((int(size[near].mean().round()), near, self._tables(self.print[near])))
            left = left[len(near) :]
        self.longest = int(size.max()) if own else 0

    def _tables(self, prints: np.ndarray) -> np.ndarray:
        """For each block whether a value lies within radius // BLOCKS bits of some item's block."""
        bits = 64 // BLOCKS
        values = np.arange(1 << bits, dtype=np.uint32)
        out = np.zeros((BLOCKS, 1 << bits), bool)
        for b in range(BLOCKS):
            for block in np.unique((prints >> np.uint64(b * bits)) & np.uint64((1 << bits) - 1)):
                out[b] |= np.bitwise_count(values ^ np.uint32(block)) <= self.radius // BLOCKS
        return out

    def near(self, prints: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius, of the items of one size class."""
        _, members, tables = self.classes[number]
        bits = 64 // BLOCKS
        hit = np.zeros(len(prints), bool)
        for b in range(BLOCKS):
            hit |= tables[b][((prints >> np.uint64(b * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        pairs = [at[np.bitwise_count(prints[at] ^ self.print[m]) <= self.radius] for m in members]
        return np.concatenate([*pairs, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(members, [len(p) for p in pairs])


def scan(words: np.ndarray, first: np.ndarray, items: Items, threshold: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, windows) for each text with words[first[i] : first[i + 1]] and each item found in it."""
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    if len(words) < SHINGLE or not items.ids:
        return []
    grams = shingles(words, SHINGLE)
    place = np.searchsorted(items.gram, grams)
    place[place == len(items.gram)] = 0
    known = items.gram[place] == grams
    for j in range(1, SHINGLE):  # a shingle that runs past the end of its text is none
        ends = first[1:] - j
        known[ends[ends >= first[:-1]]] = False
    hits = np.concatenate([[0], np.cumsum(known)])
    ones = np.zeros((len(words) + 1, 64), np.uint64 if items.longest > 60_000 else np.uint16 if items.longest > 250 else np.uint8)
    np.cumsum(_votes(words), axis=0, dtype=ones.dtype, out=ones[1:])
    count = np.diff(first)
    for number, (size, _, _) in enumerate(items.classes):
        step = max(1, size // STRIDE)
        whole = np.flatnonzero(count >= size)
        turns = (count[whole] - size) // step + 2
        start = first[whole].repeat(turns) + step * (np.arange(turns.sum()) - np.repeat(np.cumsum(turns) - turns, turns))
        last = (first[whole + 1] - size).repeat(turns)
        start = np.minimum(start, last)  # the last window ends with its text
        # A text a little shorter than the windows is a window itself.
        short = np.flatnonzero((count < size) & (count >= max(SHINGLE, int(size * threshold))))
        for begin, wide in ((start, size), *((first[i : i + 1], int(count[i])) for i in short)):
            for cut in range(0, len(begin), 1 << 17):
                own = begin[cut : cut + (1 << 17)]
                prints = _print_of(ones[own + wide - 1] - ones[own], wide - 1)
                window, item = items.near(prints, number)
                _verify(own[window], wide, item, words, first, items, known, place, hits, threshold, found)
    return [(t, i, s, at, n) for (t, i), (s, at, n) in sorted(found.items())]


def _verify(begin, wide, item, words, first, items, known, place, hits, threshold, found) -> None:
    margin = wide // STRIDE + 2
    text = np.searchsorted(first, begin, "right") - 1
    low = np.maximum(begin - margin, first[text])
    high = np.minimum(begin + wide + margin, first[text + 1])
    # At the least weight a shingle has, this many must be there; most candidates have none.
    some = np.flatnonzero(hits[high] > hits[low])
    for k in some:
        t, i = int(text[k]), int(item[k])
        at = low[k] + np.flatnonzero(known[low[k] : high[k]])
        gram = np.unique(place[at])
        mine = gram[[i in items.owner[items.begin[g] : items.begin[g + 1]] for g in gram]]
        share = float(items.weight[mine].sum() / items.total[i])
        if share >= threshold:
            best, where, n = found.get((t, i), (0.0, 0, 0))
            place_in = int(begin[k] - first[t])
            found[t, i] = (share, place_in, n + 1) if share > best else (best, where, n + 1)


def _spans(words: Words, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts of at most SPAN words: (words, where each text begins, text numbers, word offsets). Longer texts are cut into
    overlapping spans, so that every window lies whole in one of them."""
    over = 2 * longest + 8
    size = max(SPAN, 4 * over)
    pieces = []
    for t, n in enumerate(np.diff(words.first)):
        for at in range(0, max(1, int(n) - over), size - over) if n > size else [0]:
            pieces.append((t, at, min(int(n), at + size) - at))
    group, total = [], 0
    for piece in [*pieces, None]:
        if group and (piece is None or total + piece[2] > size):
            start = np.array([words.first[t] + at for t, at, _ in group])
            length = np.array([n for _, _, n in group])
            yield (
                np.concatenate([words.hash[s : s + n] for s, n in zip(start, length, strict=True)]),
                np.concatenate([[0], np.cumsum(length)]),
                np.array([t for t, _, _ in group]),
                np.array([at for _, at, _ in group]),
            )
            group, total = [], 0
        if piece is not None:
            group.append(piece)
            total += piece[2]


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """The items in blocks of bounded size, read one after the other in the order of their ids."""
    block, size = [], 0
    rows = items.filter(F.col(text).isNotNull()).select(item_id, text).orderBy(item_id, text)
    for row in rows.toLocalIterator():
        size += len(row[1]) // 2 + 1
        block.append((row[0], row[1]))
        if size > BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_windows): each document that holds a passage of an item, and where it fits best."""
    spark = docs.sparkSession
    kinds = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"`{doc_id}` {kinds[0]}, `{item_id}` {kinds[1]}, similarity double, first_word long, n_windows long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(items, item_id, text):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = Items([x[0] for x in sent.value], [x[1] for x in sent.value], radius)
            for batch in batches:
                ids = batch.column(0)
                for begin, part in chunks(batch.column(1), 2 << 20):
                    best: dict = {}
                    for words, first, texts, offset in _spans(Words(part, lower=True, blank=PLAIN), known.longest):
                        for t, i, share, at, n in scan(words, first, known, threshold):
                            key = (int(texts[t]), i)
                            old = best.get(key, (0.0, 0, 0))
                            best[key] = (share, int(offset[t]) + at, old[2] + n) if share > old[0] else (*old[:2], old[2] + n)
                    if best:
                        rows = sorted(best.items())
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([begin + k[0] for k, _ in rows])),
                                pa.array([known.ids[k[1]] for k, _ in rows], _arrow(kinds[1])),
                                pa.array([v[0] for _, v in rows], pa.float64()),
                                pa.array([v[1] for _, v in rows], pa.int64()),
                                pa.array([v[2] for _, v in rows], pa.int64()),
                            ],
                            [doc_id, item_id, "similarity", "first_word", "n_windows"],
                        )

        out = out.unionByName(docs.select(doc_id, text).mapInArrow(run, schema))
    return out


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

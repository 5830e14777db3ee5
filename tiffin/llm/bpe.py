"""Byte-pair encoding of a public vocabulary, and decoding.

Method: forced-boundary splitting. Two neighbouring bytes that stand side by side in no token of the vocabulary can never end up
in one token, so every such pair is a certain cut. A word is cut there and each fragment is merged by itself; the concatenated
ids are those of the whole word. Normalisation, word pattern and merge ranks come from the vocabulary file.

Null texts count as empty; an empty text has no ids and decodes to an empty text. Repeated rows are encoded each by itself. Other
columns pass through; columns named like the outputs are replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Tokens between white space whose ids a worker keeps in each of two generations.
CACHED_WORDS = 150_000
#: Fragments of more bytes than this are merged one by one.
LONG_FRAGMENT = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next code points from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Reads a word-level BPE file with an end-of-word suffix (normaliser NFC, white space to blank, lower case)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.tokens = {i: t for t, i in (self.ids | special).items()}
        order = sorted(special, key=len, reverse=True)
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, order)) + ")") if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.blanks = regex.compile(r"\p{White_Space}+")
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters], np.int32)
        self.final = np.array([self.ids[c + self.suffix] for c in letters], np.int32)
        self.ranks = {(self.ids[a], self.ids[b]): i for i, (a, b) in enumerate(pairs)}
        self.result = np.array([self.ids[a + b] for a, b in pairs], np.int32)
        both = np.array([*self.ranks], np.uint64).reshape(-1, 2)
        key = (both[:, 0] << np.uint64(32)) | both[:, 1]
        self.order = np.argsort(key)
        self.pair = key[self.order]
        self.joined = self._joined(letters)

    def _joined(self, letters: list[str]) -> np.ndarray:
        """Whether two bytes stand side by side in some token."""
        place = {c: i for i, c in enumerate(letters)}
        out = np.zeros((256, 256), bool)
        for token in self.ids:
            bytes_ = [place[c] for c in token.removesuffix(self.suffix)]
            out[bytes_[:-1], bytes_[1:]] = True
        return out

    def words(self, token: str) -> list[str]:
        """Normalised words of a run of characters without white space or special tokens."""
        if not token.isascii():
            token = unicodedata.normalize("NFC", token)
        # One letter at a time: str.lower() alone would write a sigma at a word's end in its final form.
        token = token.replace("Σ", "σ").lower()
        return [token] if token.isalpha() else self.word.findall(token)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit integers. All words are cut and merged together."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        length = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        if not len(flat):
            return [b""] * len(words)
        ends = np.cumsum(length)
        ids = self.inner[flat]
        ids[ends[length > 0] - 1] = self.final[flat[ends[length > 0] - 1]]
        cut = np.ones(len(flat), bool)
        cut[1:] = ~self.joined[flat[:-1], flat[1:]]
        heads = ends - length
        cut[heads[length > 0]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(flat)))
        keep = np.ones(len(flat), bool)
        for width in np.unique(size[size > 1]):
            own = start[size == width]
            for some in np.array_split(own, len(own) * width // 1_000_000 + 1):
                at = some[:, None] + np.arange(width)
                if width > LONG_FRAGMENT:
                    for row in at:
                        done = self._merged_long(ids[row].tolist())
                        ids[row[: len(done)]], keep[row[len(done) :]] = done, False
                    continue
                done, left = self._merged(ids[at])
                ids[at] = done
                keep[at] = np.arange(width) < left[:, None]
        total = np.concatenate([[0], np.cumsum(keep)]) * 4
        out = ids[keep].astype("<i4").tobytes()
        return [out[i:j] for i, j in zip(total[heads].tolist(), total[ends].tolist(), strict=True)]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, or the number of merges if there is none."""
        key = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        at = np.searchsorted(self.pair, key)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == key, self.order[at], len(self.pair)).astype(np.int32)

    def _merged(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges each row of ids: in every round the pair of the lowest rank, the leftmost among equals. Returns rows and lengths."""
        none, width = len(self.pair), rows.shape[1]
        out, left = rows.copy(), np.full(len(rows), width)
        live = np.arange(len(rows))
        now, rank = rows, self._rank(rows[:, :-1], rows[:, 1:])
        while len(live):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            go = best < none
            if not go.all():
                out[live[~go]] = np.pad(now[~go], ((0, 0), (0, width - now.shape[1])))
                left[live[~go]] = now.shape[1]
                live, now, rank, at, best = live[go], now[go], rank[go], at[go], best[go]
                if not len(live):
                    break
            now[np.arange(len(live)), at] = self.result[best]
            if now.shape[1] == 2:
                out[live, 0], left[live] = now[:, 0], 1
                break
            place = np.arange(now.shape[1] - 1)
            now = np.take_along_axis(now, place + (place > at[:, None]), axis=1)
            place = np.arange(now.shape[1] - 1)
            rank = np.take_along_axis(rank, place + (place >= at[:, None]), axis=1)
            line = np.arange(len(live))
            for side in (at - 1, at):
                fits = (side >= 0) & (side < now.shape[1] - 1)
                x, y = line[fits], side[fits]
                rank[x, y] = self._rank(now[x, y], now[x, y + 1])
        return out, left

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same for one fragment of any length, with a heap over a linked list."""
        n, ranks, result = len(ids), self.ranks, self.result
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(result[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]


class Encoder:
    """Encodes batches of texts, keeping the ids of the words met last in two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str]:
        # str.split() also splits at these four controls, which are no white space in Unicode.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [t for t in self.vocabulary.blanks.split(text) if t]
        return text.split()

    def _learn(self, tokens: set[str]) -> None:
        """Brings the ids of these tokens into the young generation; those not in store are encoded together."""
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        fresh = tokens.difference(self.young)
        self.young.update((t, self.old[t]) for t in fresh.intersection(self.old))
        missing = [*fresh.difference(self.old)]
        words = [self.vocabulary.words(t) for t in missing]
        distinct = {w: i for i, w in enumerate({w for own in words for w in own})}
        ids = self.vocabulary.encode_words([*distinct])
        self.young.update((t, b"".join([ids[distinct[w]] for w in own])) for t, own in zip(missing, words, strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        special = self.vocabulary.special_at
        parts = []
        for text in texts:
            text = text or ""
            marked = special is not None and any(s in text for s in self.vocabulary.special)
            parts.append([self._split(p) if i % 2 == 0 else p for i, p in enumerate(special.split(text) if marked else [text])])
        seen: set[str] = set()
        for own in parts:
            for p in own[::2]:
                seen.update(p)
        self._learn(seen)
        ids = self.young
        one = {s: np.array([i], "<i4").tobytes() for s, i in self.vocabulary.special.items()}
        out = [b"".join([b"".join([ids[t] for t in p]) if i % 2 == 0 else one[p] for i, p in enumerate(own)]) for own in parts]
        for token in seen:
            if len(token) > 100:  # too long to be met again
                del ids[token]
        return out


def _vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _replaced(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c not in columns]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in kept), *columns.values()], names=[*kept, *columns]
    )


def _schema(df: DataFrame, **added: str) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in added]
    return ", ".join([*kept, *(f"`{c}` {t}" for c, t in added.items())])


def _in_parts(batches: Iterator[pa.RecordBatch], text: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    from tiffin.llm.text import chunks

    for batch in batches:
        for first, part in chunks(batch.column(text), limit):
            yield batch.slice(first, len(part))


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of each whole text, as array<int>. The vocabulary travels with the tasks: its size is fixed by its file."""
    spec = df.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(spec.value))
        for batch in _in_parts(batches, text):
            found = encoder.encode(batch.column(text).to_pylist())
            ends = np.cumsum([0, *map(len, found)]) // 4
            flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield _replaced(batch, {ids: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)})

    return df.mapInArrow(run, _schema(df, **{ids: "array<int>"}))


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the decoded text: the tokens joined by blanks, special tokens kept, as the vocabulary file names no decoder.

    Ids that the vocabulary does not have are left out; a null array decodes to an empty text.
    """
    spec = df.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(spec.value).tokens
        table = np.array([known.get(i, "") for i in range(max(known) + 1)], object)
        for batch in batches:
            out = []
            for row in batch.column(ids):
                own = np.asarray(row.values, np.int64) if row.values is not None else np.zeros(0, np.int64)
                own = own[(own >= 0) & (own < len(table))]
                out.append(" ".join([t for t in table[own] if t]))
            yield _replaced(batch, {decoded: pa.array(out, pa.string())})

    return df.mapInArrow(run, _schema(df, **{decoded: "string"}))


def encode_decode(df: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` and ``decoded``."""
    return decode(encode(df, vocabulary_path, text), vocabulary_path)

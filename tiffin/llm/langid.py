"""Language identification by interpolated Kneser-Ney character models.

Training counts character 4-grams of each language over all training texts (Spark sums the counts); every language and every counted
n-gram goes into the model. Lower orders use continuation counts. All orders are interpolated once, for every
n-gram that any language has seen, and stored in sorted arrays of hashes with one row of log probabilities for all languages.
A text is scored over its whole length; the language with the lowest cross-entropy per character wins, the first by name on ties.

Rejection is calibrated on all training texts of each language: a text is rejected if it has no letter, or if its cross-entropy lies
above what texts of its length have in that language, and by ``REJECT_MARGIN`` nats a character at least.

Letters are lower-cased; every run of other characters counts as one blank. Null texts and texts without a letter get ``und``,
score 0 and are rejected. With no training text at all, every text is ``und``. Repeated rows are scored each by itself. Other columns
pass through; columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.store import stored
from tiffin.llm.text import chunks, mix

ORDER = 4
#: Nats a character by which a text must lie above its language's mean to be rejected; random letters lie above by 2 or more.
REJECT_MARGIN = 1.5
UNDETERMINED = "und"
#: Bytes of text scored at once, divided by the languages: the arrays hold a number for each character and language.
_CHUNK = 1 << 20
_ASTRAL = 0xE000


def _fold_table() -> np.ndarray:
    """For each 16-bit code point its lower-case letter, or a blank."""
    out = np.full(1 << 16, 32, np.uint16)
    for c in range(1 << 16):
        s = chr(c)
        if s.isalpha():
            low = ord(s.lower()[0])
            out[c] = low if low < 1 << 16 else c
    return out


def _letters(column: pa.Array, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, each text led by ORDER - 1 zeros; and where each text begins (its zeros)."""
    joined = ("\0" * (ORDER - 1)).join(["", *(t.replace("\0", " ") for t in column.to_pylist())])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = fold[np.minimum(code, 0xFFFF)]
    for at in np.flatnonzero(code > 0xFFFF):
        out[at] = _ASTRAL + code[at] % 0x18FF if chr(code[at]).isalpha() else 32
    out[code == 0] = 0
    blank = out == 32
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & (blank[:-1] | (out[:-1] == 0)))
    out = out[keep]
    zeros = np.flatnonzero(out == 0)
    return out, zeros[:: ORDER - 1]


def _keys(letters: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each character, 16 bits a character, the oldest in the highest bits."""
    key = letters.astype(np.uint64)
    for j in range(1, ORDER):
        key[j:] |= letters[:-j].astype(np.uint64) << np.uint64(16 * j)
    return key


def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): how often each 4-gram occurs in each language; summed in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = _fold_table()
        held: dict[str, list] = {}

        def shrink(parts: list) -> list:
            keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [(keys, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64))]

        for batch in batches:
            names = batch.column(lang).to_pylist()
            for name in sorted(set(names)):
                rows = pa.array([i for i, n in enumerate(names) if n == name])
                for _, part in chunks(batch.column(text).take(rows), 2 << 20):
                    letters, _ = _letters(part, fold)
                    keys, n = np.unique(_keys(letters)[letters > 0], return_counts=True)
                    parts = held.setdefault(name, [])
                    parts.append((keys, n))
                    if len(parts) > 8:
                        held[name] = shrink(parts)
        for name, parts in held.items():
            ((keys, n),) = shrink(parts)
            for i in range(0, len(keys), 50_000):
                own = keys[i : i + 50_000].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(own), pa.string()), pa.array(own), pa.array(n[i : i + 50_000])], ["lang", "gram", "n"]
                )

    parts = df.select(text, lang).mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Table:
    """Rows of numbers under keys, in an array sorted by the keys' hashes; the top bits of a hash give the place to look."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashed = mix(keys.astype(np.uint64))
        order = np.argsort(hashed)
        self.hash, self.rows = hashed[order], np.ascontiguousarray(rows[order], np.float32)
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.place = np.searchsorted(self.hash >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is missing."""
        h = mix(keys)
        at = self.place[h >> self.shift].astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.flatnonzero(at < len(self.hash))
        while len(open_):
            there = self.hash[at[open_]]
            own = h[open_]
            out[open_[there == own]] = at[open_[there == own]]
            open_ = open_[there < own]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.hash)]
        return out


def _suffix(key: np.ndarray, k: int) -> np.ndarray:
    return key & np.uint64((1 << (16 * k)) - 1)


@dataclass
class Model:
    languages: list[str]
    grams: list[Table]  # by order 1..ORDER: log probabilities
    backoff: list[Table]  # by order 1..ORDER: log weights of the next lower order, by context
    unseen: float
    #: Per language: cross-entropy of its own texts (mean, deviation between texts) and deviation per character.
    usual: np.ndarray | None = None

    def scores(self, letters: np.ndarray) -> np.ndarray:
        """Log probability of each character (of a text, not of the zeros before it) under each language."""
        keys = _keys(letters)[letters > 0]
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        left = np.arange(len(keys))
        for k in range(ORDER, 0, -1):
            if not len(left):
                break
            own = _suffix(keys[left], k)
            row = self.grams[k - 1].find(own)
            hit = row >= 0
            out[left[hit]] += self.grams[k - 1].rows[row[hit]]
            left, own = left[~hit], own[~hit]
            row = self.backoff[k - 1].find(own >> np.uint64(16))
            hit = row >= 0
            out[left[hit]] += self.backoff[k - 1].rows[row[hit]]
        out[left] += self.unseen
        return out

    def judge(self, column: pa.Array, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: number of the language (-1: no letter), cross-entropy under it, score, characters."""
        n = len(column)
        best, entropy, score, size = np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        if not self.languages:
            return best, entropy, score, size
        for first, part in chunks(column, _CHUNK // len(self.languages)):
            letters, heads = _letters(part, fold)
            per = self.scores(letters)
            solid = letters > 0
            begins = np.concatenate([[0], np.cumsum(solid)])[heads]
            ends = np.append(begins[1:], len(per))
            total = np.concatenate([np.zeros((1, per.shape[1])), np.cumsum(per, axis=0, dtype=np.float64)])
            count = ends - begins
            lettered = np.concatenate([[0], np.cumsum(solid & (letters != 32))])
            edges = np.append(heads, len(letters))
            has = lettered[edges[1:]] > lettered[edges[:-1]]
            cross = -(total[ends] - total[begins]) / np.maximum(count, 1)[:, None]
            at = cross.argmin(axis=1)
            low = cross.min(axis=1)
            rows = slice(first, first + len(part))
            best[rows] = np.where(has, at, -1)
            entropy[rows], size[rows] = low, count
            spread = np.exp(-(cross - low[:, None]) * np.minimum(count, 20)[:, None])
            score[rows] = np.where(has, 1 / spread.sum(axis=1), 0.0)
        return best, entropy, score, size

    def rejected(self, best: np.ndarray, entropy: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = best < 0
        if self.usual is not None and len(self.usual):
            mean, between, each = self.usual[np.maximum(best, 0)].T
            out |= entropy > mean + np.maximum(REJECT_MARGIN, 4 * between + 6 * each / np.sqrt(np.maximum(size, 1)))
        return out


def build(counts: pd.DataFrame) -> Model:
    """Interpolates the counts (lang, gram, n) into a model."""
    languages = sorted(counts["lang"].unique())
    if not languages:
        return Model([], [], [], 0.0)
    per = {}
    for name, own in counts.groupby("lang"):
        per[name] = own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy().astype(np.float64)
    letters = {int(c) for keys, _ in per.values() for c in np.unique(_suffix(keys, 1))}
    unseen = -float(np.log(len(letters) + 1))
    orders: dict[str, list] = {}
    for name, (keys, n) in per.items():
        levels = [(keys, n)]
        for k in range(ORDER - 1, 0, -1):
            below, times = np.unique(_suffix(levels[-1][0], k), return_counts=True)
            levels.append((below, times.astype(np.float64)))
        orders[name] = levels[::-1]
    grams, backoff = [], []
    lower_keys, lower = None, None
    for k in range(1, ORDER + 1):
        union = np.unique(np.concatenate([orders[name][k - 1][0] for name in languages]))
        contexts = np.unique(union >> np.uint64(16))
        if lower is None:
            base = np.full((len(union), len(languages)), np.exp(unseen))
        else:
            base = lower[np.searchsorted(lower_keys, _suffix(union, k - 1))]
        rows, weights = np.zeros_like(base), np.ones((len(contexts), len(languages)))
        where = np.searchsorted(contexts, union >> np.uint64(16))
        for j, name in enumerate(languages):
            keys, n = orders[name][k - 1]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = min(0.95, max(0.05, ones / max(1.0, ones + 2.0 * twos)))
            own = np.searchsorted(union, keys)
            total = np.bincount(where[own], n, len(contexts))
            kinds = np.bincount(where[own], minlength=len(contexts))
            seen = total > 0
            weights[seen, j] = discount * kinds[seen] / total[seen]
            count = np.zeros(len(union))
            count[own] = n - discount
            rows[:, j] = count / np.maximum(total[where], 1) + weights[where, j] * base[:, j]
        grams.append(Table(union, np.log(rows)))
        backoff.append(Table(contexts, np.log(weights)))
        lower_keys, lower = union, rows
    return Model(languages, grams, backoff, unseen)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from all rows with a text and a language. The distinct n-grams of every language reach the driver, their texts do not."""
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    model = build(stored(gram_counts(rows, text, lang), "gram-counts").toArrow().to_pandas())
    if model.languages:
        model.usual = _calibrate(model, rows, text, lang)
    return model


def _calibrate(model: Model, rows: DataFrame, text: str, lang: str) -> np.ndarray:
    """Mean, deviation between texts and deviation per character of the cross-entropy over all texts of each language."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    place = {name: j for j, name in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = _fold_table()
        for batch in batches:
            for first, part in chunks(batch.column(text), _CHUNK // len(place)):
                names = batch.column(lang).slice(first, len(part)).to_pylist()
                letters, heads = _letters(part, fold)
                per = sent.value.scores(letters)
                begins = np.append(np.concatenate([[0], np.cumsum(letters > 0)])[heads], len(per))
                out = []
                for i, name in enumerate(names):
                    own = -per[begins[i] : begins[i + 1], place[name]]
                    if len(own) >= 20:
                        out.append((name, float(own.mean()), float(own.std())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.string()), *(pa.array([x[j] for x in out], pa.float64()) for j in (1, 2))],
                    ["lang", "mean", "each"],
                )

    seen = rows.mapInArrow(run, "lang string, mean double, each double").groupBy("lang")
    per = seen.agg(F.count("*").alias("n"), F.avg("mean").alias("mean"), F.stddev_samp("mean").alias("between"), F.avg("each").alias("each"))
    out = np.zeros((len(model.languages), 3))
    out[:, 0] = np.inf  # too few texts in all to judge by
    try:
        for r in per.filter("n >= 30").collect():
            out[place[r["lang"]]] = r["mean"], r["between"], r["each"]
    finally:
        sent.destroy()  # the tasks that read it have ended
    return out


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score, cross_entropy and rejected."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    added = {"lang_pred": "string", "score": "double", "cross_entropy": "double", "rejected": "boolean"}
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, known = _fold_table(), sent.value
        names = np.array([*known.languages, UNDETERMINED], object)
        for batch in batches:
            best, entropy, score, size = known.judge(batch.column(text), fold)
            columns = {c: batch.column(c) for c in batch.schema.names if c not in added} | {
                "lang_pred": pa.array(names[best], pa.string()),
                "score": pa.array(score),
                "cross_entropy": pa.array(entropy),
                "rejected": pa.array(known.rejected(best, entropy, size)),
            }
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return df.mapInArrow(run, ", ".join([*kept, *(f"{c} {t}" for c, t in added.items())]))

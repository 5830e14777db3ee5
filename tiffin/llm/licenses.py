"""License scan: cosine of headers and licence files to templates, then inheritance from the nearest directory above.

1. Every line of a text, and every pair of neighbouring lines (a notice may wrap), is a candidate header. Its sparse TF-IDF vector is
   compared with the templates' vectors. Inverse document frequencies of the templates' terms come from all texts; a term that no
   template has weighs as one that no text has.
2. A row declares the template of the best cosine that reaches ``THRESHOLD``, the first by name on ties; a text whose words, taken
   together, reach ``FILE_THRESHOLD`` is a licence file and also speaks for its directory.
3. A row without a declaration inherits from the nearest directory above it that has a licence file, by one equi-join for each depth of the
   directories that have one. Several licence files of a directory: the highest cosine, then the smallest name, decides.

Null or empty texts declare nothing; null or empty paths lie in the root directory; an empty table gives an empty result. Repeated
rows get equal results. Templates are few and travel with the tasks; what is counted of the texts is one number for each of their terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.store import stored
from tiffin.llm.text import PLAIN, Words, chunks

THRESHOLD = 0.6
FILE_THRESHOLD = 0.5
#: Notices by which the licences are recognised.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License (CC BY 4.0)",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def _hashes(texts: list[str]) -> list[np.ndarray]:
    words = Words(pa.array(texts, pa.large_string()), lower=True, blank=PLAIN)
    return [words.text(i) for i in range(len(texts))]


class Templates:
    """Unit TF-IDF vectors of the templates over their sorted terms."""

    def __init__(self, templates: dict[str, str], frequency: dict[int, int] | None = None, total: int = 0):
        self.names = sorted(templates)
        terms = _hashes([templates[n] for n in self.names])
        self.terms = np.unique(np.concatenate([*terms, np.zeros(0, np.uint64)]))
        seen = np.array([(frequency or {}).get(int(t.view(np.int64)), 0) for t in self.terms])
        self.idf = np.log((1 + total) / (1 + seen)) + 1
        self.rare = math.log(1 + total) + 1
        vectors = np.stack([np.bincount(np.searchsorted(self.terms, t), minlength=len(self.terms)) for t in terms]) * self.idf
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    def cosines(self, words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
        """Cosine of each group of words with each template. ``group`` must be sorted."""
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = self.terms[at] == words
        # The norm needs each other term's count in its group.
        key = np.stack([group[~known].astype(np.uint64), words[~known]])
        order = np.lexsort(key[::-1])
        key = key[:, order]
        fresh = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])) if key.shape[1] else np.zeros(0, np.int64)
        times = np.diff(np.append(fresh, key.shape[1]))
        square = np.bincount(key[0, fresh].astype(np.int64), (times * self.rare) ** 2.0, groups)
        counts = np.zeros((groups, len(self.terms)))
        np.add.at(counts, (group[known], at[known]), 1)
        counts *= self.idf
        norm = np.sqrt(square + (counts**2).sum(axis=1))
        return counts @ self.vectors.T / np.maximum(norm, 1e-300)[:, None]


def term_frequencies(df: DataFrame, text: str, templates: dict[str, str]) -> tuple[dict[int, int], int]:
    """In how many texts each term of the templates occurs, and how many texts there are."""
    terms = Templates(templates).terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for _, part in chunks(batch.column(0), 4 << 20):
                words = Words(part, lower=True, blank=PLAIN)
                at = np.minimum(np.searchsorted(terms, words.hash), len(terms) - 1)
                own = np.repeat(np.arange(len(part)), np.diff(words.first))
                pair = np.unique((own * len(terms) + at)[terms[at] == words.hash])
                count += np.bincount(pair % len(terms), minlength=len(terms))
                total += len(part)
        keys = [*terms.view(np.int64).tolist(), None]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([*count.tolist(), total], pa.int64())], ["term", "n"])

    rows = df.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    total = found.pop(None, 0)
    return found, total


def _lines(text: str) -> list[str]:
    lines = [line for line in text.split("\n") if line.strip()]
    return lines + [f"{a} {b}" for a, b in zip(lines, lines[1:], strict=False)]


def declared(df: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Adds license, cosine (of the best header) and is_file."""
    frequency, total = term_frequencies(df, text, templates)
    added = {"license": "string", "cosine": "double", "is_file": "boolean"}
    kept = [f.name for f in df.schema if f.name not in added]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} {t}" for c, t in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, frequency, total)
        names = np.array([*known.names, None], object)
        for batch in batches:
            for begin, part in chunks(batch.column(text), 2 << 20):
                own = batch.slice(begin, len(part))
                whole = Words(part, lower=True, blank=PLAIN)
                at = np.minimum(np.searchsorted(known.terms, whole.hash), len(known.terms) - 1)
                hits = np.concatenate([[0], np.cumsum(known.terms[at] == whole.hash)])
                some = np.flatnonzero(hits[whole.first[1:]] > hits[whole.first[:-1]])
                best = np.zeros((len(part), len(known.names)))
                file = np.zeros(len(part))
                for few in np.array_split(some, len(some) // 64 + 1) if len(some) else []:
                    self_ = np.repeat(np.arange(len(few)), np.diff(whole.first)[few])
                    words = np.concatenate([whole.text(i) for i in few])
                    file[few] = known.cosines(words, self_, len(few)).max(axis=1)
                    lines = [_lines(part[int(i)].as_py()) for i in few]
                    flat = [x for own_lines in lines for x in own_lines]
                    cut = Words(pa.array(flat, pa.large_string()), lower=True, blank=PLAIN)
                    near = np.minimum(np.searchsorted(known.terms, cut.hash), len(known.terms) - 1)
                    # A line with under two of the templates' terms can't come near one.
                    inside = np.concatenate([[0], np.cumsum(known.terms[near] == cut.hash)])
                    good = np.flatnonzero(inside[cut.first[1:]] - inside[cut.first[:-1]] >= 2)
                    if not len(good):
                        continue
                    size = np.diff(cut.first)[good]
                    score = known.cosines(np.concatenate([cut.text(i) for i in good]), np.repeat(np.arange(len(good)), size), len(good))
                    np.maximum.at(best, few[np.repeat(np.arange(len(few)), [len(x) for x in lines])[good]], score)
                top = best.max(axis=1, initial=0.0)
                found = top >= THRESHOLD
                columns = {c: own.column(c) for c in kept} | {
                    "license": pa.array(names[np.where(found, best.argmax(axis=1), -1)], pa.string()),
                    "cosine": pa.array(top),
                    "is_file": pa.array(found & (file >= FILE_THRESHOLD)),
                }
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return df.mapInArrow(run, schema)


def _directory(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan(df: DataFrame, path: Column, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """The rows with license, cosine, is_file, and license_from: ``declared``, the directory it is inherited from, or null. The text is dropped."""
    rows = stored(
        declared(df.withColumn("_path", F.coalesce(path, F.lit(""))).select(*df.columns, "_path"), text, templates).drop(text), "license-rows", small=True
    ).withColumn("_dir", _directory(F.col("_path")))
    offers = (
        rows.filter("is_file")
        .groupBy("_dir")
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "_path", "license")).alias("o"))
        .select(F.col("_dir").alias("_at"), F.col("o.license").alias("_offer"), F.when(F.col("_dir") == "", 0).otherwise(F.size(F.split("_dir", "/"))).alias("_depth"))
    )
    depths = [r[0] for r in offers.select("_depth").distinct().orderBy(F.desc("_depth")).collect()]
    out = rows.withColumns({"_from": F.lit(None).cast("string"), "_got": F.lit(None).cast("string")})
    for depth in depths:
        # Directories of this depth above a row; nearer ones have been tried before.
        above = F.when(F.lit(depth == 0), "").when(F.size(F.split("_dir", "/")) >= depth, F.substring_index("_dir", "/", depth))
        level = offers.filter(F.col("_depth") == depth).drop("_depth")
        out = out.withColumn("_above", above).join(level, F.col("_above") == F.col("_at"), "left")
        out = out.withColumns(
            {"_from": F.coalesce("_from", F.when(F.col("_offer").isNotNull(), F.col("_at"))), "_got": F.coalesce("_got", "_offer")}
        ).drop("_above", "_at", "_offer")
    return out.withColumns(
        {
            "license_from": F.when(F.col("license").isNotNull(), "declared").otherwise(F.col("_from")),
            "license": F.coalesce("license", "_got"),
        }
    ).drop("_dir", "_path", "_from", "_got")

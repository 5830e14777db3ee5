"""The Merkle manifest, against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tiffin.llm import merkle, queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree(leaves):
    """Root, and for each leaf its steps (left, right)."""
    steps = [[] for _ in leaves]
    place, nodes = list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, k in enumerate(place):
            run = k - k % 8
            steps[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + 8])))
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        place = [k // 8 for k in place]
    return nodes[0], steps


def expected(data):
    groups = {}
    for doc_id, text, lang, source, n_chars in data:
        groups.setdefault(lang, []).append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), (source, lang, n_chars, text)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = tree([r[1] for r in groups[lang]])
    root, upper = tree([trees[g][0] for g in langs])
    out = []
    for place, lang in enumerate(langs):
        subroot, steps = trees[lang]
        for (doc_id, leaf, rest), path in zip(groups[lang], steps, strict=True):
            path = [*path, *upper[place]]
            h = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = None if rest[3] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[3])
                h = leaf_of(doc_id, *rest[:3], text)
            for left, right in path:
                h = H(left, h, right)
            out.append((doc_id, leaf, subroot, root, H(*[a + b for a, b in path]), h, h == root))
    return sorted(out, key=str)


def answer(spark, rows, data, work):
    rows(data, DOCS).write.parquet(f"{work}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_merkle(spark, work).collect()), key=str)


def docs(n, langs, seed=1):
    pick = random.Random(seed)
    return [(i, f"Text {i} Ä", pick.choice(langs), "s", i) for i in pick.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_trees_of_several_heights(spark, rows, work, n):
    data = docs(n, ["en"] * 5 + ["de", None, "fr"])
    assert answer(spark, rows, data, work) == expected(data)


def test_many_groups_make_a_tree_of_their_own(spark, rows, work):
    data = docs(80, [f"l{i}" for i in range(30)] + ["Z", "é", ""])
    assert answer(spark, rows, data, work) == expected(data)


def test_nulls_repeats_and_ties(spark, rows, work):
    data = [(None, None, None, None, None), (None, "A", None, "s", 1), (3, "", "en", None, 0), (3, "", "en", None, 0), (3, "x", "en", None, 1), (4, "L" * 1_000_000, "en", "s", 2)]
    assert answer(spark, rows, data, work) == expected(data)


def test_empty_table_and_clashing_columns(spark, rows):
    def run(df):
        fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
        return merkle.manifest(df, merkle.leaf(*fields), group="lang", order=["doc_id"], keep={"doc_id": F.col("doc_id")})

    assert run(rows([], DOCS)).count() == 0
    clash = rows(docs(20, ["en", "de"]), DOCS).withColumns({c: F.lit("!") for c in ("grp", "lo", "hi", "n", "digest", "children", "path", "root", "above")})
    assert run(clash).filter(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 20


def test_a_changed_row_is_seen(spark):
    got = queries.op11_merkle(spark, "/root/testdata/sf0.001").collect()
    assert {r.verified for r in got if zlib.crc32(str(r.doc_id).encode()) % 3} == {True}
    assert not all(r.verified for r in got)

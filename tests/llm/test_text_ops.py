"""Operators on words, tokens and languages against brute force and the reference library."""

import hashlib
import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tiffin.llm import bpe, decontaminate, langid, queries, simhash, substring_dedup
from tiffin.llm.fm_index import FMIndex
from tiffin.llm.text import Words, shingles

SF = "/root/testdata/sf0.001"


# ---- words ----------------------------------------------------------------------------------------------------------


@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\r\x1cé漢", max_size=30), max_size=8))
@settings(deadline=None)
def test_words_are_what_bytes_split_gives(texts):
    words = Words(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        own = [bytes(words.data[a:b]) for a, b in zip(words.start[words.first[i] : words.first[i + 1]], words.end[words.first[i] :], strict=False)]
        assert own == text.encode().split()
    flat = [w for t in texts for w in t.encode().split()]
    assert len({*words.hash.tolist()}) == len({*flat})


def test_shingles_depend_on_order_and_length():
    words = Words(pa.array(["a b a b"])).hash
    pairs = shingles(words, 2)
    assert pairs[0] == pairs[2] != pairs[1]
    assert shingles(words[:2], 2)[0] == pairs[0] != shingles(words[:1], 1)[0]


# ---- substring dedup ------------------------------------------------------------------------------------------------


def test_matching_statistics_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        limit = int(rng.integers(2, 6))
        kept = [rng.integers(1, 4, rng.integers(1, 14)) for _ in range(rng.integers(1, 8))]
        index = FMIndex(np.concatenate([np.append(s, 0) for s in kept]).astype(np.int64), limit)
        asked = [rng.integers(0, 6, rng.integers(1, 15)) for _ in range(4)] + kept
        start = np.cumsum([0, *map(len, asked)])[:-1]
        found, group = index.matching(np.concatenate(asked), start, np.array([*map(len, asked)]))
        place, at = {}, 0
        parts = {tuple(s[i:j]) for s in kept for i in range(len(s)) for j in range(i + 1, min(len(s), i + limit) + 1)}
        for s in kept:
            for i in range(len(s) - limit + 1):
                place.setdefault(tuple(s[i : i + limit]), at + i)
            at += len(s) + 1
        for q, a in zip(asked, start, strict=True):
            q = tuple(q)
            for i in range(len(q)):
                best = max((m for m in range(limit + 1) if m == 0 or i + m <= len(q) and q[i : i + m] in parts), default=0)
                assert found[a + i] == best
                assert (group[a + i] >= 0) == (best == limit)
                if best == limit:
                    assert index.group_first[group[a + i]] == place[q[i : i + limit]]


def plain_dedup(rows, window):
    seen, out = set(), {}
    for key, text in sorted(rows):
        words = text.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            own = tuple(words[i : i + window])
            if own in seen:
                gone[i : i + window] = [True] * window
            seen.add(own)
        out[key] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


@pytest.mark.parametrize("window, anchor", [(2, 1), (5, 3), (20, 4)])
def test_repeats_are_removed_as_by_brute_force(spark, window, anchor):
    rng = random.Random(window)
    passages = [" ".join(rng.choices("abcdefgh", k=window * 2)) for _ in range(6)]
    rows = [(i, " ".join(rng.choices([*passages, "x", "y z", "a", "q" * 9], k=rng.randint(0, 9)))) for i in range(60)]
    rows += [(100, "a " * 70), (101, ""), (102, "   "), (103, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(df, window=window, anchor=anchor).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == plain_dedup(rows, window)


def test_dedup_of_odd_rows(spark):
    long = " ".join(str(i) for i in range(30))
    rows = [(None, long, 1), (None, None, 2), (5, None, 3), (7, long, 4), (7, long, 5), (9, long, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()), key=str)
    assert got == sorted([(None, 30, 0), (None, 0, 0), (5, 0, 0), (7, 30, 0), (7, 30, 0), (9, 30, 30)], key=str)
    assert substring_dedup.remove_repeats(df.limit(0)).collect() == []


def test_crowded_anchors_are_dealt_by_windows(spark, monkeypatch):
    """With every anchor taken for a crowded one the result stays the same."""
    rng = random.Random(8)
    rows = [(i, " ".join(["hot passage of words that all of them hold"] + rng.choices("abc", k=20))) for i in range(200)]
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 1 / 1_000_000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hot, _ = substring_dedup._crowded(df.select(df.doc_id.alias("id"), "text"), 6, 2)
    assert len(hot) > 0
    got = substring_dedup.remove_repeats(df, window=6, anchor=2).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == plain_dedup(rows, 6)


# ---- BPE ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        return bpe.Encoder(bpe.Vocabulary(json.load(f)))


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


ALPHABET = "abcSIs' ΣσςİıéÉ̀ \t\n\x1c\x85 漢字가ㄱ😀123٣½$%&'tl<|>_-.,"


@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=20))
@settings(deadline=None, max_examples=150)
def test_ids_equal_the_library(library, encoder, texts):
    assert [ids(r) for r in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_special_tokens_long_words_and_nulls(library, encoder):
    texts = ["a<|startoftext|>b <|endoftext|>", "ab" * 400, "é" * 3000, "'" * 500, "don't WE'LL", "x" * 70 + "!" * 70]
    assert [ids(r) for r in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode([None, ""]) == [b"", b""]


def test_fragments_never_hide_a_merge(encoder):
    """Both ways of merging agree, and no merge joins two bytes across a forced cut."""
    v = encoder.vocabulary
    assert not any(v.joined[a, b] for a, b in [(ord("q"), 255)])
    words = ["internationalisation", "qqqqzzz", "ünïcödé", "日本語テキスト"]
    whole = [v._merged_long([*v.inner[list(w.encode())[:-1]].tolist(), int(v.final[w.encode()[-1]])]) for w in words]
    assert [ids(r) for r in v.encode_words(words)] == whole


def test_bpe_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op2_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        e = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = library.decode(e, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_keeps_other_columns_and_replaces_clashing_ones(spark):
    df = spark.createDataFrame([(1, "the cat", "x"), (2, None, "y")], "k int, text string, ids string")
    got = bpe.encode_decode(df, queries.tokenizer_path()).orderBy("k").collect()
    assert [(r.k, r.text, len(r.ids), r.decoded) for r in got] == [(1, "the cat", 2, "the</w> cat</w>"), (2, None, 0, "")]
    assert bpe.encode(df.limit(0), queries.tokenizer_path()).collect() == []


# ---- SimHash --------------------------------------------------------------------------------------------------------


def test_edits_and_neighbours_against_plain_code(spark):
    rows = [(3, "zyx wvu tsr"), (1, "ab"), (2, "héllo wörld " * 30), (9, None), (5, ""), (7, "a" * 5000)]
    got = {r.doc_id: r for r in simhash.compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(k for k, _ in rows)
    text = {k: t or "" for k, t in rows}
    assert sorted(got) == order
    for i, k in enumerate(order):
        follow = order[(i + 1) % len(order)]
        assert (got[k].n_chars, got[k].edited) == (len(text[k]), simhash.edited(text[k], text[follow]))
        differ = bin(int(got[k].fingerprint, 16) ^ int(got[follow].fingerprint, 16)).count("1")
        assert got[k].near_next == pytest.approx(1 - differ / simhash.BITS)


def test_next_of_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "c")], "doc_id long, text string")
    got = {(r.doc_id, r.text): r.next_text for r in simhash.with_next(df).collect()}
    assert got == {(1, "a"): "b", (1, "b"): "c", (2, "c"): "n", (None, "n"): "a"}
    assert simhash.with_next(df.limit(0)).collect() == []
    assert [r.next_text for r in simhash.with_next(df.filter("doc_id = 2")).collect()] == ["c"]


def test_equal_texts_have_equal_fingerprints_and_likeness_falls_with_change():
    base = " ".join(f"w{i}" for i in range(400))
    other = " ".join(f"v{i}" for i in range(400))
    half = " ".join([f"w{i}" for i in range(200)] + [f"v{i}" for i in range(200)])
    a, b, c, d = simhash.fingerprints(pa.array([base, base.upper(), half, other]))
    assert (a == b).all()
    near, far = simhash.likeness(a[None], c[None])[0], simhash.likeness(a[None], d[None])[0]
    assert 1 > near > far > 0.3


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_all_neighbours_within_the_radius_are_found(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 7)
    rng = random.Random(radius)
    seeds = [rng.getrandbits(simhash.BITS) for _ in range(6)]
    prints = {s for s in seeds for _ in range(9) for s in [s ^ sum(1 << rng.randrange(simhash.BITS) for _ in range(rng.randint(0, 5)))]}
    hexes = [f"{p % (1 << simhash.BITS):032x}" for p in prints]
    df = spark.createDataFrame([(h,) for h in [*hexes, hexes[0], None]], "fingerprint string")
    got = {r.fingerprint: r.n_near for r in simhash.within_radius(df, radius).collect()}
    want = {h: sum(0 <= bin(int(h, 16) ^ int(x, 16)).count("1") <= radius for x in set(hexes) if x != h) for h in hexes}
    assert got == want


# ---- decontamination ------------------------------------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_leaks_are_found_wherever_they_stand_and_clean_texts_are_not(spark):
    rng = random.Random(2)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghijk", k=rng.randint(2, 6))) for _ in range(n))

    items = [(i, prose(rng.randint(15, 60))) for i in range(40)] + [(90, "too few words"), (91, None), (92, items_copy := prose(30)), (93, items_copy)]
    rows, want = [], set()
    for i in range(40):
        before, after = prose(rng.randint(0, 300)), prose(rng.randint(0, 300))
        rows.append((i, f"{before} {items[i][1].upper().replace(' ', ' ** ')} {after}"))
        want.add((i, i))
    rows += [(100 + i, prose(200)) for i in range(60)] + [(300, items[5][1]), (301, None), (302, ""), (303, f"x {items_copy}")]
    want |= {(300, 5), (303, 92), (303, 93)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert min(r.similarity for r in got) >= 0.8
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []


def test_leaks_across_spans_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SPAN", 300)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(words[s : s + 30])) for i, s in enumerate((0, 285, 290, 1111, 1970))]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, i) for i in range(5)]


def test_block_tables_miss_no_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    known = decontaminate.Items([0], [" ".join(f"w{i}" for i in range(20))], 18)
    flips = [rng.choice(64, rng.integers(0, 19), replace=False) for _ in range(300)]
    near = np.array([int(known.print[0]) ^ sum(1 << int(b) for b in f) for f in flips], np.uint64)
    window, item = known.near(near, 0)
    assert sorted(window.tolist()) == [*range(300)] and set(item.tolist()) == {0}


def test_decontamination_query_against_brute_force(spark):
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    items = {r.item_id: grams(plain_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        own = grams(plain_words(r.text))
        want |= {(r.doc_id, i) for i, g in items.items() if g and len(g & own) >= 0.8 * len(g)}
    assert {(r.doc_id, r.item_id) for r in queries.op9_decontaminate(spark, SF).collect()} == want


# ---- language ID ----------------------------------------------------------------------------------------------------


def test_probabilities_of_a_context_sum_to_one():
    """Interpolated Kneser-Ney leaves no mass over: all letters of the alphabet and one unseen letter add up to 1."""
    import pandas as pd

    text = "abracadabra alakazam "
    letters, _ = langid._letters(pa.array([text]), langid._fold_table())
    keys, n = np.unique(langid._keys(letters)[letters > 0], return_counts=True)
    model = langid.build(pd.DataFrame({"lang": "x", "gram": keys.view(np.int64), "n": n}))
    known = sorted({int(c) for c in letters if c})
    for context in ("abr", "zam", "bra"):
        total = 0.0
        for c in [*known, ord("q")]:
            stream = np.array([0, 0, 0, *map(ord, context), c], np.uint16)
            total += float(np.exp(model.scores(stream)[-1, 0]))
        assert total == pytest.approx(1, abs=1e-5)


def test_lookups_find_what_is_there_and_nothing_else():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 60, 5000, dtype=np.uint64))
    table = langid.Table(keys, np.arange(len(keys), dtype=np.float64)[:, None])
    row = table.find(keys)
    assert (table.rows[row][:, 0] == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_held_out_accuracy_and_outputs(spark):
    got = {r.doc_id: r for r in queries.op10_langid(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").collect()
    import zlib

    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert {d.doc_id for d in held} == {k for k, r in got.items() if r.held_out}
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert not any(r.rejected for r in got.values())


def test_rare_languages_are_calibrated_beside_many_copies(spark):
    rng = random.Random(9)
    words = {"en": ["the", "and", "house", "water", "green"], "de": ["der", "und", "haus", "wasser", "grün"]}
    rows = [("en", "the house and the water are green and so on")] * 12_000
    rows += [(name, " ".join(rng.choices(words[name], k=30))) for name in ("en", "de") for _ in range(40)]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string").repartition(4))
    assert model.languages == ["de", "en"] and np.isfinite(model.usual).all() and (model.usual[:, 1] > 0).all()
    odd = spark.createDataFrame([("ü".join(rng.choices("qxzjkvwpyü", k=400)),), (rows[-1][1],)], "text string")
    assert [(r.lang_pred, r.rejected) for r in langid.identify(odd, model).collect()] == [("de", True), ("de", False)]


def test_every_language_and_every_gram_is_kept(spark):
    """33 languages with letters of their own; one of them has more kinds of 4-grams than a 33rd part of 400,000."""
    rng = random.Random(8)
    rows = [(f"l{j:02}", " ".join("".join(chr(0x4E00 + 10 * j + rng.randrange(10)) for _ in range(4)) for _ in range(20))) for j in range(33)]
    rows.append(("l00", "".join(chr(0xAC00 + rng.randrange(3000)) for _ in range(14_000))))
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"))
    kinds = set()
    for _, text in rows:
        letters, _ = langid._letters(pa.array([text]), langid._fold_table())
        kinds |= set(langid._keys(letters)[letters > 0].tolist())
    assert len(model.grams[-1].hash) == len(kinds)
    got = langid.identify(spark.createDataFrame(rows[:33], "lang string, text string"), model).collect()
    assert [r.lang_pred for r in got] == [r.lang for r in got]


def test_texts_without_letters_and_unlike_any_language(spark):
    rng = random.Random(4)
    words = [["the", "and", "house", "water", "green"], ["der", "und", "haus", "wasser", "grün"]]
    rows = [(["en", "de"][i % 2], " ".join(rng.choices(words[i % 2], k=60))) for i in range(200)]
    model = langid.train(spark.createDataFrame([*rows, (None, "x"), ("en", None)], "lang string, text string"))
    odd = [(1, "the green water"), (2, None), (3, "12 34 !?"), (4, ""), (5, "".join(rng.choices("qxzjkvwpy", k=400))), (6, "das haus und")]
    got = langid.identify(spark.createDataFrame(odd, "k int, text string"), model).orderBy("k").collect()
    assert [r.lang_pred for r in got[:4]] == ["en", "und", "und", "und"] and got[5].lang_pred == "de"
    assert [r.rejected for r in got] == [False, True, True, True, True, False]
    empty = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame(odd, "k int, text string"), empty).collect()} == {"und"}

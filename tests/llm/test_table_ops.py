"""Operators on pairs, pages, spans and licences against brute force, and the pipeline against its operators."""

import base64
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect
from tiffin.llm import licenses, ngram_join, pii, queries, sieve, url_filter, warc
from tiffin.llm.graph import components
from tiffin.llm.store import bounded_broadcasts

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# ---- components -----------------------------------------------------------------------------------------------------


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7), (200, 200), (300, 301), (301, 300)]
    links += [(rng.randint(400, 430), rng.randint(400, 430)) for _ in range(25)]
    df = spark.createDataFrame([*links, (None, 5), (6, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == roots({x for p in links for x in p}, links)
    assert components(df.limit(0)).collect() == []


# ---- n-gram join ----------------------------------------------------------------------------------------------------


def plain_sets(rows, n):
    out = {}
    for key, text in rows:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        out[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    return out


def plain_components(rows, n, percent):
    sets = plain_sets(rows, n)
    keys = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {k: (len(sets[k]), c) for k, c in roots(keys, links).items()}


def near_copies(seed, words=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(words)}" for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 11, 25, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if own:
                    own[rng.randrange(len(own))] = f"W{rng.randrange(words)}"
            rows.append((len(rows) * 3, rng.choice([" ", "\n"]).join(own)))
    return rows


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_join_components_equal_brute_force(spark, monkeypatch, n, percent, seed):
    monkeypatch.setattr(ngram_join, "TILE", 9)
    monkeypatch.setattr(ngram_join, "SKETCHES", 7)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = near_copies(seed)
    df = spark.createDataFrame([*rows, (None, "a b c d"), (None, None)], "doc_id long, text string").repartition(4)
    got = ngram_join.join_components(df, n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == plain_components(rows, n, percent)
    assert [(r.component_id) for r in got if r.doc_id is None] == [None, None]


def test_join_of_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(4, "a b c d e f"), (4, "x y z u v w"), (9, "x y z u v w"), (2, ""), (4, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in ngram_join.join_components(df).collect())
    assert got == [(2, 2), (4, 4), (4, 4), (4, 4), (9, 4)]
    assert ngram_join.join_components(df.limit(0)).collect() == []


def test_linked_sets_always_share_a_signature():
    rng = np.random.default_rng(0)
    for percent in (60, 80, 90):
        for size in (5, 9, 10, 14, 60, 400):
            for _ in range(15):
                a = rng.integers(0, 1 << 62, size, dtype=np.uint64)
                most = 2 * size * (100 - percent) // (100 + percent)
                b = np.concatenate([a[most - most // 2 :], rng.integers(0, 1 << 62, most // 2, dtype=np.uint64)])
                a, b = np.unique(a), np.unique(b)
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both) or (a.shape == b.shape and (a == b).all()):
                    continue
                frames = ngram_join.Frames(percent, 1000)
                sign, doc, spared = frames.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
                both = set(sign[doc == 0].tolist()) & set(sign[doc == 1].tolist())
                assert both
                free = {(d, f): n for d, f, n in spared.T.tolist()}
                shared = [sum(x >> ngram_join.FRAME_SHIFT == f for x in both) for f in range(64)]
                # In the frame of the larger set both may leave out what they have to spare and still share one.
                assert any(n > max(free.get((0, f), 0), free.get((1, f), 0)) for f, n in enumerate(shared))


def test_passages_that_many_share_neither_hide_nor_make_links(spark):
    rng = random.Random(11)
    passages = [[f"p{k}_{i}" for i in range(70)] for k in range(3)]
    rows = []
    for k in range(60):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([20, 60, 90]))] + passages[k % 3]
        for _ in range(rng.choice([1, 1, 2, 4])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(df, n=5, percent=80).collect()}
    assert got == plain_components(rows, 5, 80)


def test_frequent_signatures_go_as_far_as_sets_can_spare_them(spark):
    rows = [(7, rep, 10) for rep in range(9)] + [(5, 0, 10), (5, 1, 10), (6, 0, 10), (6, 2, 10)]
    spared = spark.createDataFrame([(0, 0, 1), (1, 0, 2), (3, 1, 5)], "rep long, frame long, free long")
    got = ngram_join._needed(spark.createDataFrame(rows, "sign long, rep long, size long"), spared).collect()
    assert sorted((r.sign, r.rep) for r in got) == [(5, 0), (6, 0), (6, 2), *((7, k) for k in range(2, 9))]


@pytest.mark.parametrize(("percent", "small", "large"), [(90, 91, 95), (80, 39, 42), (50, 60, 100)])
def test_links_across_a_class_boundary_and_chunks(spark, monkeypatch, percent, small, large):
    monkeypatch.setattr(ngram_join, "_CHUNK", 1)  # every text is a chunk of its own
    words = [f"w{i}" for i in range(large)]
    rows = [(1, " ".join(words[:small])), (2, " ".join(words)), (3, " ".join(f"x{i}" for i in range(large)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(df, n=1, percent=percent).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_tile_products_count_overlaps():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcdef"), rng.integers(1, 12))) for _ in range(30)]
    grams, first = ngram_join.sets(pa.array(texts), 2)
    sets = [set(grams[first[i] : first[i + 1]].tolist()) for i in range(30)]
    left, right = np.arange(12), np.arange(8, 30)
    got = ngram_join.tile_links(grams, first, left, right, 70)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            assert got[i, j] == (100 * len(sets[a] & sets[b]) >= 70 * len(sets[a] | sets[b]))


def test_ngram_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_ngram_join(spark, SF).collect()}
    assert got == plain_components(rows, 3, 90)


# ---- URL filter -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_statement(spark, name):
    df = queries.QUERIES[name](spark, SF)
    con = connect(SF).execute(queries.SQL[name])
    names = [c[0] for c in con.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(con.fetchall(), key=str)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == want


def page(canonical=None, refresh=None):
    head = f"<LINK href='{canonical}' rel=canonical>" if canonical else ""
    head += f'<meta http-equiv="Refresh" content="0; URL={refresh}">' if refresh else ""
    return f"<html><head>{head}</head></html>"


def test_decisions_travel_over_aliases(spark):
    rows = [
        (1, "http://bad.example.com/en/x", page()),
        (2, "https://alias.org/p#top", page("http://bad.example.com/en/x")),
        (3, "https://far.org/q?a=1&b=2", page(refresh="https://alias.org/p")),
        (4, "https://www.example.com/en/", page("http://bad.example.com/en/x")),
        (5, "https://lone.org", page("/self")),
        (6, None, None),
        (7, "no scheme", page("x")),
        (8, "HTTP://UP.Example.COM/en/a/b", None),
        (9, "https://xcom/", None),
        (10, "ftp://a.net/es/?q#f", None),
        (10, "ftp://a.net/es/?q#f", None),
        (11, "https://moved.org/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = url_filter.rule_table(spark, queries.URL_RULES)
    moves = spark.createDataFrame([("https://moved.org", "http://z.net/fr/"), (None, "x")], "from_url string, to_url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict, r.decided_by) for r in url_filter.filter_urls(pages, rules, moves).collect())
    # 4 is allowed by its own rule, which also frees the aliases that no rule names; the blocked page itself stays blocked.
    assert got == [
        (1, "bad.example.com", "/en/x", "example.com/en/", "block", "rule"),
        (2, "alias.org", "/p", None, "allow", "alias"),
        (3, "far.org", "/q", None, "allow", "alias"),
        (4, "www.example.com", "/en/", "www.example.com/en/", "allow", "rule"),
        (5, "lone.org", "", None, "allow", "default"),
        (6, "", "", None, "allow", "default"),
        (7, "", "", None, "allow", "default"),
        (8, "up.example.com", "/en/a/b", "example.com/en/", "block", "rule"),
        (9, "xcom", "/", None, "allow", "default"),
        (10, "a.net", "/es/", "net/es/", "block", "rule"),
        (10, "a.net", "/es/", "net/es/", "block", "rule"),
        (11, "moved.org", "/", None, "block", "alias"),
    ]
    without = {r.page_id: r.verdict for r in url_filter.filter_urls(pages.filter("page_id <> 4"), rules).collect()}
    assert without[2] == without[3] == "block"
    none = url_filter.filter_urls(pages, url_filter.rule_table(spark, []))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


# ---- personal data --------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k in PATTERNS for m in re.finditer(PATTERNS[k], text or "") if passes(k, m[0])]


def test_base_spans_equal_plain_regular_expressions(spark):
    rng = random.Random(6)
    pieces = ["a@b.co", "_x@d.com", "@", ".", "..", "1.2.3.4", "256.1.1.1", "007.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824"]
    pieces += ["+", "-", " ", "  ", "é", "😀", "\x01", "\x02", "\n", "12345678901234567890123", "0000000000000000", "x.y@z-1.a.b-", "%+._-@q.w", "5", "+49 30 1234567", "("]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "a@b" + ".c" * 3000 + " 1" * 3000 + " " + "9" * 20000 + " " + "k" * 50000, "1.2.3.4 " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_personal_data(df).collect():
        assert [(s.kind, s.start, s.end) for s in r.base_spans] == plain_spans(texts[r.doc_id]), texts[r.doc_id]
        assert {tuple(s) for s in r.base_spans} <= {tuple(s) for s in r.spans}
    assert pii.find_personal_data(df.limit(0)).collect() == []


def test_context_finds_identifiers_that_break_the_rule(spark):
    """Cards behind one phrase make it a pattern; a mistyped card behind it is found, a number elsewhere is not."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222", "378282246310005", "6011111111111117"]
    rows = [(i, f"we charged card number {c} today") for i, c in enumerate(good)]
    rows += [(50, "your card number 4111111111111112 was declined"), (51, "the parcel 4111111111111112 is late"), (52, "nothing here")]
    found = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in found[50].spans] == [("card", 17, 33)] and found[50].base_spans == []
    assert found[51].spans == [] and found[52].spans == []
    masked = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert masked[50] == "your card number [CARD] was declined" and masked[51] == rows[-2][1]
    assert masked[0] == "we charged card number [CARD] today"


def test_every_trusted_pattern_finds_its_identifiers(spark):
    """1,100 phrases with seeds of their own; each also stands before a number that breaks the rule, in copies too."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005", "6011111111111117"]
    phrases = ["phrase" + "".join("abcdefghij"[int(d)] for d in f"{k:04}") for k in range(1_100)]
    rows = [f"{p} {c}" for p in phrases for c in good]
    odd = [f"{p} 4111111111111112" for p in phrases]
    texts = [*rows, *odd, odd[0], None, "4111111111111112"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(df).collect()}
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    for i, text in enumerate(texts[:-2]):
        assert found[i] == [("card", 11, len(text))] and masked[i] == f"{text[:11]}[CARD]"
    assert found[len(texts) - 2] == found[len(texts) - 1] == []
    assert masked[len(texts) - 2] is None and masked[len(texts) - 1] == texts[-1]


def test_masking_of_overlapping_spans_and_nulls(spark):
    rows = [(1, "call +1 (743) 555-3824 or a@b.co, é 1.2.3.4"), (2, None), (3, "+4111 1111 1111 1111 x")]
    got = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "call [PHONE] or [EMAIL], é [IP]" and got[2] is None
    assert re.fullmatch(r"\+?\[(CARD|PHONE)\] x", got[3])


def test_addresses_found_loosely_are_the_ones_found_properly(spark):
    """Twenty proper addresses behind a phrase and eight that break the rule: an address counts once, so the phrase is trusted."""
    good = [f"mail to user{i}@site{i}.org now" for i in range(40)]
    odd = [f"mail to root{i}@localhost now" for i in range(8)]
    df = spark.createDataFrame(list(enumerate([*good, *odd, "see root@else now"])), "doc_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(df).collect()}
    for i, text in enumerate([*good, *odd]):
        assert spans[i] == [("email", 8, len(text) - 4)], text
    assert spans[48] == []


def test_bootstrapping_goes_on_from_what_it_discovers(spark):
    """Addresses discovered behind one phrase make another one a pattern, which discovers a fresh address."""
    good = [f"mail to user{i}@site{i}.org now" for i in range(40)]
    odd = [f"mail to root{i}@localhost now" for i in range(8)]
    again = [f"reach via root{i}@localhost please" for i in range(8)]
    df = spark.createDataFrame(list(enumerate([*good, *odd, *again, "reach via fresh@localhost please"])), "doc_id long, text string")
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert {masked[i] for i in range(48)} == {"mail to [EMAIL] now"}
    assert {masked[i] for i in range(48, 57)} == {"reach via [EMAIL] please"}


def test_personal_data_beside_columns_of_any_name(spark):
    names = ["spans", "_text", "_row", "found", "_t", "_e", "_c", "_in", "_plain", "_cover", "_known", "_base", "base_spans", "_gap", "_hit", "_end"]
    df = spark.createDataFrame([(1, "call a@b.co"), (2, None), (3, "")], "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in names])
    assert {r.doc_id: (r.text, r.spans, r._in) for r in pii.mask(df).collect()} == {1: ("call [EMAIL]", "x", "x"), 2: (None, "x", "x"), 3: ("", "x", "x")}
    assert {r.doc_id: (len(r.spans), r.found, r._row) for r in pii.find_personal_data(df).collect()} == {1: (1, "x", "x"), 2: (0, "x", "x"), 3: (0, "x", "x")}


def test_the_search_stands_in_the_plan_of_masking_once(spark):
    df = spark.createDataFrame([(1, "call a@b.co")], "doc_id long, text string")
    assert pii.mask(df)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 0  # done and stored before


def test_pii_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op6_pii(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in spans) for x in PATTERNS]
        assert set(joined.split(",")) <= set(r.spans.split(","))


# ---- WARC -----------------------------------------------------------------------------------------------------------


def test_archives_round_trip_roll_and_repeat(spark, tmp_path):
    rows = [(i, f"http://h/{i} x", ["same", "", "é" * i, f"own {i}" * 50][i % 4]) for i in range(40)] + [(None, None, None), (None, "u", "own 3" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    for folder in folders:
        manifest = warc.write(pages, file_bytes=900, folder=folder)
        names = [r.file for r in manifest.collect()]
    assert len(names) > 8
    files = {n: [(tmp_path / x / n).read_bytes() for x in "ab"] for n in names}
    assert all(a == b for a, b in files.values())
    assert not list((tmp_path / "a").glob("_temporary*"))
    got = sorted(warc.read(spark, manifest).collect(), key=lambda r: (r.row_id is None, r.row_id or 0, r.payload_bytes))
    assert len(got) == len(rows)
    first = {}
    for r, (key, _, text) in zip(got, sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len((r[2] or "").encode()))), strict=True):
        body = (text or "").encode()
        assert (r.row_id, r.payload_bytes) == (key, len(body))
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        origin = first.setdefault(body, key) if key is not None else None
        assert (r.record_type, r.refers_to) == (("response", None) if origin in (None, key) else ("revisit", origin))
        assert bytes(r.block) == (body if r.record_type == "response" else b"")
    large = warc.read(spark, warc.write(pages, min_bytes=10, folder=f"file://{tmp_path}/c")).filter("payload_bytes < 10")
    assert large.filter("record_type <> 'response'").count() == 0
    assert warc.read(spark, warc.write(pages.limit(0), folder=f"file://{tmp_path}/d")).collect() == []


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 100)], "page_id long, url string, html string")
    manifest = warc.write(pages, folder=f"file://{tmp_path}/a")
    file = tmp_path / "a" / manifest.first().file
    file.write_bytes(file.read_bytes()[:-9])
    with pytest.raises(Exception, match="cut off|manifest says"):
        warc.read(spark, manifest).collect()


# ---- licences -------------------------------------------------------------------------------------------------------


def test_headers_files_and_inheritance(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "a/b/c/x", filler),
        (3, "a/b/LICENSE", "Released under the\nMIT License."),
        (4, "a/y", f"{filler}\nThis work is licensed under the GNU General Public License, version 3.\n{filler}"),
        (5, "z/y", filler),
        (6, "ab/y", "license license license of words"),
        (7, None, None),
        (8, "a/q", ""),
        (9, "a/b/w", "LICENSED*** UNDER*** CC*** BY-NC*** 4.0***\n" + filler),
    ]
    df = spark.createDataFrame(rows, "doc_id int, path string, text string")
    got = {r.doc_id: (r.license, r.is_file, r.license_from) for r in licenses.scan(df, F.col("path")).collect()}
    assert got == {
        1: ("Apache-2.0", True, "declared"),
        2: ("MIT", False, "a/b"),
        3: ("MIT", True, "declared"),
        4: ("GPL-3.0", False, "declared"),
        5: (None, False, None),
        6: (None, False, None),
        7: (None, False, None),
        8: ("Apache-2.0", False, "a"),
        9: ("CC-BY-NC-4.0", False, "declared"),
    }
    assert licenses.scan(df.limit(0), F.col("path")).collect() == []


def test_cosines_equal_the_formula():
    frequency = {int(t.view(np.int64)): 3 for t in licenses.Templates(licenses.TEMPLATES).terms[:5]}
    known = licenses.Templates(licenses.TEMPLATES, frequency, 10)
    text = "licensed under the apache license and and others"
    (words,) = licenses._hashes([text])
    got = known.cosines(words, np.zeros(len(words), np.int64), 1)[0]
    weight = {int(t): w for t, w in zip(known.terms, known.idf, strict=True)}
    own = {}
    for w in words.tolist():
        own[w] = own.get(w, 0) + weight.get(w, known.rare)
    for name, value in zip(known.names, got, strict=True):
        vector = {}
        for w in licenses._hashes([licenses.TEMPLATES[name]])[0].tolist():
            vector[w] = vector.get(w, 0) + weight[w]
        dot = sum(own.get(w, 0) * x for w, x in vector.items())
        assert value == pytest.approx(dot / (sum(x * x for x in own.values()) * sum(x * x for x in vector.values())) ** 0.5)


def test_license_query_finds_every_notice(spark):
    notices = {"Apache License": "Apache-2.0", "MIT License": "MIT", "GNU General Public": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0"}
    got = {r.doc_id: r for r in queries.op8_licenses(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = {v for k, v in notices.items() if k in r.text}
        own = got[r.doc_id]
        assert ({own.license} if own.license_from == "declared" else set()) == want if len(want) < 2 else own.license in want


# ---- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline_keeps_clean_documents_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    groups = plain_components([(d.doc_id, d.text) for d in docs], 5, 80)
    leaked = {r.doc_id for r in queries.op9_decontaminate(spark, SF).collect()}
    want = {d.doc_id for d in docs if groups[d.doc_id][1] == d.doc_id} - leaked
    assert set(got) == want
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    for d in docs:
        if d.doc_id in got and not plain_spans(d.text):
            assert list(got[d.doc_id].ids) == library.encode(d.text, add_special_tokens=False).ids


def test_stages_return_documents_and_stand_nulls(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the water and the house", "en", "a", 23), (2, None, None, None, None), (None, "the water and the house", "en", "a", 23)]
    rows += [(3, "", "en", "a", 0), (4, "das wasser und das haus", "de", "a", 23), (1, "the water and the house", "en", "a", 23)]
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            stage(spark, docs, SF).collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


# ---- rows that stay where they are ----------------------------------------------------------------------------------


@pytest.fixture
def no_small_tables(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def collected(df, column):
    """The rows of a DataFrame, and how many rows with a column (or a field) of this name its shuffles wrote."""
    rows = df.collect()

    def written(node):
        if "QueryStage" in node.nodeName():
            return written(node.plan())
        own = node.metrics().get("shuffleRecordsWritten")
        here = own.get().value() if own.isDefined() and f"{column}:string" in node.schema().simpleString() else 0
        children = node.children()
        return here + sum(written(children.apply(i)) for i in range(children.size()))

    return rows, written(df._jdf.queryExecution().executedPlan().executedPlan())


def long_texts(count):
    rng = random.Random(7)
    return [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)), "en", "a", 1) for i in range(count)]


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("words", [1, 2, 1 << 18])
def test_sieve_loses_no_key_and_passes_few_others(spark, monkeypatch, words):
    monkeypatch.setattr(sieve, "WORDS", words)
    df = spark.createDataFrame([(i, f"k{i}") for i in range(-500, 500)] + [(None, None)], "n int, s string")
    keys = spark.createDataFrame([(i, f"k{i}") for i in range(-30, 30)] * 2 + [(None, None), (900, "k900")], "n long, s string")
    for key in ("n", "s"):
        got = {r[key]: r["_may"] for r in sieve.sieved(df, key, keys.select(key)).collect()}
        assert len(got) == 1001 and not got[None]
        assert all(got[x] for x in ([*range(-30, 30)] if key == "n" else [f"k{i}" for i in range(-30, 30)]))
        assert words < 1 << 18 or sum(got.values()) < 70
        assert not any(r["_may"] for r in sieve.sieved(df, key, keys.select(key).limit(0)).collect())
        assert sieve.sieved(df.limit(0), key, keys.select(key)).collect() == []


def test_join_hands_python_bounded_batches(spark, monkeypatch):
    """Batches as large as a task's input are held by the JVM and by Python at once; the session's own limit holds again afterwards."""
    most, name = 2 * ngram_join.BATCH_BYTES, "spark.sql.execution.arrow.maxBytesPerBatch"
    before, rng = spark.conf.get(name), random.Random(4)
    rows = [(i, " ".join(str(rng.randrange(10**8)) for _ in range(450))) for i in range(2500)]
    df = spark.createDataFrame([*rows, (2500, rows[7][1])], "doc_id long, text string").coalesce(1)
    limits = []

    def narrow(column, limit, inner=ngram_join.chunks):
        if column.nbytes > most:
            raise MemoryError(f"a batch of {column.nbytes} bytes")
        return inner(column, limit)

    def spied(df, what, small=False, inner=ngram_join.stored):
        limits.append(int(spark.conf.get(name).rstrip("b")))
        return inner(df, what, small)

    monkeypatch.setattr(ngram_join, "chunks", narrow)
    monkeypatch.setattr(ngram_join, "stored", spied)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(df).collect()}
    assert got == {i: i for i in range(2500)} | {2500: 7}
    assert max(limits) == ngram_join.BATCH_BYTES
    assert spark.conf.get(name) == before


def test_near_duplicates_moves_copies_and_repeated_ids_alone(spark, no_small_tables, monkeypatch):
    texts = []

    def spied(df, name, small=False, inner=ngram_join.stored):
        if name == "ngram-texts":
            texts.append(collected(df, "text"))
        return inner(df, name, small)

    monkeypatch.setattr(ngram_join, "stored", spied)
    rows = long_texts(300)
    rows[200] = (200, *rows[10][1:])  # copies, also near ones
    rows[201] = (201, rows[11][1] + " more", *rows[11][2:])
    again = [(20, "zz", "en", "a", 1), (20, None, "en", "a", 1), (None, rows[10][1], "en", "a", 1), (None, None, None, None, None)]
    got, moved = collected(corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows + again, DOCUMENTS), SF), "text")
    want = [r for r in rows if r[0] not in (200, 201, 20)] + [min(rows[20], again[0]), *again[2:]]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert moved <= 8
    ((found, moved),) = texts
    assert {11, 201} <= {r.id for r in found}
    assert moved <= len(found) < 150


def test_decontamination_moves_documents_with_a_passage_alone(spark, no_small_tables):
    passages = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(2).collect()]
    rows = [*long_texts(300), (900, passages[0], "en", "a", 1), (None, passages[1], "en", "a", 1), (None, "free", "en", "a", 1), (901, None, None, None, None)]
    got, moved = collected(corpus_pipeline.benchmark_free(spark, spark.createDataFrame(rows, DOCUMENTS), SF), "text")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [r for r in rows if r[1] not in passages]))
    assert moved <= 5


def test_masking_moves_texts_with_spans_alone(spark, no_small_tables):
    rows = [*long_texts(300), (900, "call a@b.co", "en", "a", 1), (901, "call a@b.co", "en", "a", 1), (902, None, None, None, None)]
    got, moved = collected(pii.mask(spark.createDataFrame(rows, DOCUMENTS)), "_plain")
    want = [(*r[:1], r[1] and r[1].replace("a@b.co", "[EMAIL]"), *r[2:]) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert moved <= 5


def test_join_bounds_broadcasts_and_frees_shuffles(spark, monkeypatch):
    seen = set()
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def spy(df, name, small=False, stored=ngram_join.stored):
        seen.add(tuple(spark.conf.get(n) for n in names))
        return stored(df, name, small)

    before = [spark.conf.get(n) for n in names]
    monkeypatch.setattr(ngram_join, "stored", spy)
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words that stand here alone")], "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in ngram_join.join_components(docs).collect()}
    assert rows == {1: 1, 2: 1, 3: 3}
    assert seen == {(str(ngram_join.BROADCAST_BYTES), "true")} and [spark.conf.get(n) for n in names] == before


@pytest.mark.parametrize("limit, bound", [("10m", "1000"), ("500b", "500"), ("100", "100"), ("-1", "-1")])
def test_broadcasts_are_bounded_by_the_lower_limit(spark, limit, bound):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, limit)
        with pytest.raises(KeyError), bounded_broadcasts(spark, 1000):
            assert spark.conf.get(name) == bound
            raise KeyError
        assert spark.conf.get(name) == limit
    finally:
        spark.conf.set(name, before)

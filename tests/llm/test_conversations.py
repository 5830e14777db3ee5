"""Chat formatting and structure repair, against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tiffin.llm import chat, queries, repair

CONVERSATION = "conv_id bigint, turn bigint, role string, text string"
SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- chat


def read_back(rows, data):
    done = chat.format_chats(rows(data, CONVERSATION)).withColumns(
        {"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("formatted"), F.col("loss_mask"))}
    )
    return {r.conv_id: r for r in done.collect()}


ODD = ["", "[INST]", "</s>", "<s>", "[\\INST]", "[\\\\/INST]", "<\\/s>", "[", "<", "\\", "a[INST", "]", "[[/INST]", "ü\n😀", "s>", "/s>", "<s><s>"]


def test_any_text_comes_back_and_the_loss_covers_the_assistant(rows):
    pieces = random.Random(3)
    texts = ["".join(pieces.choices(ODD, k=pieces.randint(0, 5))) for _ in range(300)]
    roles = [pieces.choice(["user", "assistant", "system", "[INST]x</s>", ""]) for _ in texts]
    data = [(i // 10, i % 10, r, t) for i, (r, t) in enumerate(zip(roles, texts, strict=True))]
    got = read_back(rows, data)
    for conv in range(30):
        mine = [(r, t) for c, _, r, t in data if c == conv]
        assert [(t.role, t.text) for t in got[conv].turns] == mine
        assert got[conv].loss == [t for r, t in mine if r == "assistant"]
        runs = len([1 for k, _ in itertools.groupby(mine, key=lambda m: m[0])])
        assert got[conv].formatted.count("[INST]") == got[conv].formatted.count("</s>") == len(got[conv].loss_mask) == runs


def test_template_and_merged_turns(rows):
    got = read_back(rows, [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c[INST]")])[1]
    assert got.formatted == "[INST]user[/INST]a</s>[INST]assistant[/INST]b<s>c[\\INST]</s>"
    assert got.loss_mask[0] is None
    start, end = got.loss_mask[1]
    assert "[INST]assistant[/INST]b<s>c[\\INST]</s>"[start:end] == "b<s>c[\\INST]"


def test_chat_nulls_ties_repeats_and_other_columns(rows):
    data = [(None, None, None, None), (None, 1, "user", "x"), (5, 2, "b", "z"), (5, 2, "a", "y"), (5, 2, "a", "y"), (5, None, "user", None)]
    got = read_back(rows, data)
    assert [tuple(t) for t in got[None].turns] == [("", ""), ("user", "x")]
    assert [tuple(t) for t in got[5].turns] == [("user", ""), ("a", "y"), ("a", "y"), ("b", "z")]
    extra = rows(data, CONVERSATION).withColumns({c: F.lit("!") for c in ("turns", "blocks", "formatted", "loss_mask", "one")})
    assert chat.format_chats(extra).columns == ["conv_id", "formatted", "loss_mask"] and chat.format_chats(extra).count() == 2
    assert chat.format_chats(rows([], CONVERSATION)).count() == 0


def test_a_long_conversation_with_long_texts(rows):
    data = [(1, i, "user" if i % 2 else "assistant", "x<s>" * (50_000 if i == 7 else 3)) for i in range(3000)]
    got = read_back(rows, data)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in data]
    assert got.loss == [t for _, _, r, t in data if r == "assistant"]


# ---------------------------------------------------------------- repair


def plain_damage(rows):
    space = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall("[^\x20\x09-\x0d]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, faults):
    """Least (cost, audit) over every sequence of edits, by the row and the text written so far."""
    best = {(0, ""): (0, "", ())}  # (rows done, roles so far) -> way
    found = []
    wanted = re.compile(r"(s?(ua)+)?\Z")
    grows = re.compile(r"(s?(ua)*u?)?\Z")
    edge = list(best)
    while edge:
        at, roles = edge.pop()
        cost, audit, lines = best[at, roles]
        ways = []
        if at < len(rows):
            _, role, text = rows[at]
            more = 3 if faults[at] == "truncated" else 0
            ways.append((at + 1, roles, cost + 4, audit + "D", lines))
            if faults[at] not in ("blank", "duplicate"):
                ways.append((at + 1, roles + (role[:1] or "-"), cost + more, audit + "K", (*lines, f"{role}:{text}")))
                ways += [(at + 1, roles + r[0], cost + 3 + more, audit + "R", (*lines, f"{r}:{text}")) for r in ("user", "assistant")]
        if len(roles) <= 2 * len(rows) + 2:
            ways += [(at, roles + r[0], cost + 3, audit + "I", (*lines, f"{r}:")) for r in ("user", "assistant")]
        for a, r, c, au, li in ways:
            if grows.match(r) and ((a, r) not in best or (c, au) < best[a, r][:2]):
                best[a, r] = (c, au, li)
                edge.append((a, r))
    for (at, roles), way in best.items():
        if at == len(rows) and wanted.match(roles):
            found.append(way)
    return min(found)


def expected(data):
    out = {}
    hurt = plain_damage(data)
    for conv in {r[0] for r in data}:
        rows = sorted((r[1:] for r in hurt if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))
        faults = faults_of(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, audit, lines = cheapest(rows, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(lines)))
    return out


def repaired(df):
    told, turns = repair.repair(queries.damaged(df))
    prints = {r.conv_id: r.sha256 for r in repair.line_digests(turns, ["block", "at", "part"], F.concat_ws(":", "role", "text")).collect()}
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, prints.get(r.conv_id, sha("")))
        for r in told.collect()
    }


def test_repair_of_random_conversations(rows):
    pick = random.Random(11)
    texts = ["Yes.", "No", "", "  \t", "Why?", "Yes. ", "ok!\n"]
    data = [
        (conv, pick.choice([None, *range(4)]) if conv % 5 == 0 else 2 * turn if conv % 7 == 0 else turn, pick.choice(["system", "user", "assistant", "tool", "", None]), pick.choice([*texts, f"{conv} {turn}.", None]))
        for conv in range(60)
        for turn in range(pick.randint(1, 7))
    ]
    want = expected(data)
    empty = (0, 0, 0, 0, 0, 0, "", sha(""))
    got = repaired(rows(data, CONVERSATION))
    assert {c: got.get(c, empty) for c in want} == want


def test_query_on_the_given_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_repair(spark, SF).collect()}
    assert got == expected(data)


def test_a_long_conversation_in_many_pieces(spark, rows):
    pick = random.Random(2)
    data = [(1, i // 2, pick.choice(["user", "assistant", "system"]), pick.choice([f"{i}.", f"{i}", "again."])) for i in range(4000)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # so little data would be merged into one range
    try:
        told, turns = repair.repair(rows(data, CONVERSATION))
        one = told.first()
        assert turns.select("block").distinct().count() > 4
    finally:
        spark.conf.set(merge, "true")
    ordered = sorted(((t, r, x) for _, t, r, x in data), key=lambda r: (r[0], r[1], sha(r[2])))
    # The same rows as one span, without pieces.
    seen, span = set(), []
    for _, role, text in ordered:
        kind = "D" if (role, text) in seen else role[0]
        seen.add((role, text))
        span.append(kind.upper() if text[-1] != "." else kind)
    cost, audit, _ = repair.chain([repair.parse("".join(span))])
    assert (one.cost, one.audit) == (cost, audit)
    roles = [r.role[0] for r in turns.orderBy("block", "at", "part").collect()]
    assert re.fullmatch("(s?(ua)+)?", "".join(roles))


def test_repair_edges(spark, rows):
    assert repair.repair(rows([], CONVERSATION))[0].count() == 0
    told, turns = repair.repair(rows([(None, None, None, None)] * 3 + [(2, 0, "user", "Hi. " * 100_000)], CONVERSATION))
    got = {r.conv_id: (r.blank, r.cost, r.audit) for r in told.collect()}
    assert got == {None: (3, 12, "DDD"), 2: (0, 3, "KI")}
    assert [(r.role, len(r.text)) for r in turns.orderBy("part").collect()] == [("user", 400_000), ("assistant", 0)]
    clash = rows([(1, 0, "user", "Hi."), (1, 0, "user", "Hi.")], CONVERSATION).withColumns({c: F.lit("!") for c in ("block", "at", "blank", "edits", "print", "n")})
    assert repair.repair(clash)[0].first().audit == "KDI"


@pytest.mark.parametrize("symbols", ["".join(s) for n in range(4) for s in itertools.product("suaxUAD", repeat=n)][::7])
def test_any_split_of_a_span_gives_the_same_cell(symbols):
    whole = repair.parse(symbols)
    for at in range(len(symbols) + 1):
        assert repair._combine(repair.parse(symbols[:at]), repair.parse(symbols[at:])) == whole

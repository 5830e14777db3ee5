"""Repair of the turn structure of conversations, by weighted interval parsing.

The wanted role sequence is ``(s?(ua)+)?`` over the first letters of the roles. Its automaton has four states: nothing yet, after the
system turn, after a user turn, after an assistant turn (the first and the last may end). The repair grammar in Chomsky normal form has a
nonterminal N[p,q] for every two states, "these rows, repaired, lead from p to q":

    N[p,q] -> N[p,r] N[r,q]          two neighbouring spans
    N[p,q] -> row                    kept (0), made a user or assistant turn (3), deleted (4); 3 more for an undeleted truncated row
    N[p,q] -> I[p,s] row I[t,q]      insertion closure: any number of inserted user and assistant turns (3 each) beside it

A cell of a span holds for each nonterminal the least (cost, audit), the audit being the letters of the edits in order (K, R, D, I). Cells
are combined bottom-up by span length: 1, 2, 4, ... Because every derivation of N[p,q] over a span passes some state at every inner
boundary, one split of a span gives the same cell as all of its splits, so the spans of a binary tree suffice, and the work is linear in
the rows where a table of all spans takes the cube. Equal costs are told apart by the audit, least in ASCII. That order holds under
concatenation: two audits of the same rows and cost are never prefixes of one another, since an insertion costs something.

Rows are range-sorted by conversation and place, so one of any size is dealt out over many tasks; each parses its piece, and the pieces'
cells are combined per conversation, a few at most. Only where a digest of a whole conversation is asked for does one task read all
of its rows, in order and without keeping them: SHA-256 can't be split.

Rows go by turn, null first; equal turns by role and text digest. Equal rows are counted once before the sort and repeated by their number.
Null roles and texts count as one space, a null conversation is one of its own. Only the four named columns (and a number of copies) are
read, so others can't clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.store import stored

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK = " \t\n\x0b\x0c\r"

#: State after a role's letter, by state; states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
NEXT_STATE = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
STATES = range(4)
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


def _combine(a: Cell, b: Cell) -> Cell:
    """The cell of two neighbouring spans."""

    def least(p: int, q: int):
        ways = [(a[p][r][0] + b[r][q][0], r) for r in STATES if a[p][r] and b[r][q]]
        if not ways:
            return None
        cost = min(ways)[0]
        return cost, min(a[p][r][1] + b[r][q][1] for c, r in ways if c == cost)

    return tuple(tuple(least(p, q) for q in STATES) for p in STATES)


def _inserted() -> Cell:
    """No row: inserted turns only. A round of two inserted turns that comes back to its state never pays."""
    ways = [[None] * 4 for _ in STATES]
    for p in STATES:
        state, cost, audit = p, 0, ""
        for _ in STATES:
            if ways[p][state] is None:
                ways[p][state] = (cost, audit)
            state = next(t for letter, t in NEXT_STATE[state].items() if letter in "ua")
            cost, audit = cost + INSERT, audit + "I"
    return tuple(map(tuple, ways))


_INSERTED = _inserted()


def _row_cell(symbol: str) -> Cell:
    """The closed cell of one row: ``D`` must go; a small letter is its role's, a capital one that of a truncated row."""
    ways = [[None] * 4 for _ in STATES]
    more = TRUNCATED if symbol.isupper() else 0
    for p in STATES:
        options = [(DELETE, "D", p)]
        if symbol != "D":
            for letter, t in NEXT_STATE[p].items():
                if letter == symbol.lower():
                    options.append((more, "K", t))
                if letter in "ua":
                    options.append((REROLE + more, "R", t))
        for cost, audit, t in options:
            if ways[p][t] is None or (cost, audit) < ways[p][t]:
                ways[p][t] = (cost, audit)
    return _combine(_combine(_INSERTED, tuple(map(tuple, ways))), _INSERTED)


@lru_cache(maxsize=50_000)
def _short(span: str) -> Cell:
    if len(span) == 1:
        return _row_cell(span)
    half = 1 << (len(span) - 1).bit_length() - 1
    return _combine(_short(span[:half]), _short(span[half:]))


def parse(symbols: str, leaf: int = 8) -> Cell:
    """The cell of a span, bottom-up by span length. Cells of short spans, which recur, are remembered."""
    if not symbols:
        return _INSERTED
    cells = [_short(symbols[i : i + leaf]) for i in range(0, len(symbols), leaf)]
    while len(cells) > 1:
        cells = [_combine(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def chain(cells: Iterable[Cell]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and audit of neighbouring pieces from the first state to an end, and each piece's first state and part of the audit."""
    ways: dict[int, tuple[int, str, list]] = {0: (0, "", [])}
    for cell in cells:
        after: dict[int, tuple[int, str, list]] = {}
        for q in STATES:
            found = [(c + cell[p][q][0], a + cell[p][q][1], p) for p, (c, a, _) in ways.items() if cell[p][q]]
            if found:
                cost, audit, p = min(found)
                after[q] = (cost, audit, ways[p][2] + [(p, cell[p][q][1])])
        ways = after
    return min((ways[q] for q in ENDS if q in ways), key=lambda w: w[:2])


def edits(state: int, audit: str, copies: Iterable[int]) -> Iterator[list[str]]:
    """For each row of so many equal copies what it becomes: ``k`` kept, ``u`` or ``a`` made that role, ``U`` or ``A`` inserted.

    Kept rows change the state by the only role that can be kept there, which a structure of alternating roles determines: ``K`` in the
    first state is the caller's row, so its role is sent in by the caller as the answer to a yielded ``None``.
    """
    at = 0
    copies = list(copies)
    for number, n in enumerate(copies):
        out: list[str] = []
        left, last = n, number == len(copies) - 1
        while at < len(audit) and (left or (last and audit[at] == "I")):
            what, at = audit[at], at + 1
            left -= what != "I"
            if what == "D":
                continue
            letter = "a" if state == 2 else "u"
            out.append({"K": "k", "R": letter, "I": letter.upper()}[what])
            if what == "K" and state == 0:
                state = yield None
            else:
                state = 3 if letter == "a" else 2
        yield out


# ---------------------------------------------------------------- rows


def prepared(rows: DataFrame) -> DataFrame:
    """Equal rows of conv_id, turn, role, text (and copies, if there is such a column) counted once; nulls become one space."""
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    space = F.lit(" ")
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        copies.alias("copies"),
    )
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    body = F.rtrim("text", F.lit(BLANK))
    return counted.withColumns(
        {
            "print": F.sha2(F.col("text").cast("binary"), 256),
            "blank": body == "",
            "cut": ~F.right(body, F.lit(1)).isin(".", "!", "?"),
        }
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their faults, sorted into pieces of conversations: ``block`` is a range of the sort, ``at`` a row's number in it."""
    kept = stored(prepared(rows), "repair-rows")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    # Only texts that occur at several turns need the place of their first one.
    again = kept.groupBy("conv_id", "role", "print").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    first = again.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("print").alias("_print"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("print") == F.col("_print"))
    later = F.col("first").isNotNull() & (F.col("first") < place)
    judged = kept.join(first, same, "left").withColumn("later", F.coalesce(later, F.lit(False)))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("print")]
    judged = stored(judged.select("conv_id", "turn", "role", "text", "copies", "print", "blank", "cut", "later"), "repair-judged")
    sort = judged.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(sort.drop("print").withColumn("at", F.monotonically_increasing_id()).withColumn("block", F.shiftright("at", 33)), "repair-sorted")


def _sorted_batches(df: DataFrame, by: list[str], order: list[str], function, schema: str) -> DataFrame:
    """Runs a function over partitions that hold whole keys, in order."""
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    return df.repartition(*by).sortWithinPartitions(*keys).mapInArrow(function, schema)


def _rows_of(batches: Iterable[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _emit(schema: pa.Schema, rows: Iterable[tuple], size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_LIGHT = ("conv_id", "block", "turn", "letter", "copies", "blank", "cut", "later")
_PIECE = (
    "conv_id long, block long, turns long, low long, high long, blank long, duplicate long, truncated long, illegal long,"
    " first string, last string, costs array<long>, audits array<string>"
)
_PIECE_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "block", "turns", "low", "high", "blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)
LEGAL = frozenset(("su", "ua", "au"))


def symbols(letter: str, copies: int, blank: bool, cut: bool, later: bool) -> str:
    """The symbols of a row and its further copies, which are duplicates."""
    kind = "D" if blank or later else (letter if letter in ("s", "u", "a") else "x")
    return (kind.upper() if cut else kind) + "D" * (copies - 1)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and block: counts, what stands at its ends, and the cell of its span."""

    def found() -> Iterator[tuple]:
        key, count, span, low, high, turn_before, ends = None, [0] * 5, [], None, None, None, ["", ""]

        def piece() -> tuple:
            cell = parse("".join(span))
            flat = [way for line in cell for way in line]
            return (
                *key, count[0], low, high, *count[1:], *ends,
                [None if w is None else w[0] for w in flat], [None if w is None else w[1] for w in flat],
            )

        for conv, block, turn, letter, copies, blank, cut, later in _rows_of(batches, _LIGHT):
            if key != (conv, block):
                if key is not None:
                    yield piece()
                key, count, span, low, high, turn_before, ends = (conv, block), [0] * 5, [], None, None, None, [letter, letter]
                follows = False
            if turn is not None:
                count[0] += turn != turn_before
                low, high, turn_before = turn if low is None else low, turn, turn
            if blank:
                count[1] += copies
            else:
                count[2] += copies - 1 + later
                count[3] += cut and not later
            if follows:
                count[4] += ends[1] + letter not in LEGAL
            count[4] += (copies - 1) * (letter + letter not in LEGAL)
            ends[1], follows = letter, True
            span.append(symbols(letter, copies, blank, cut, later))
        if key is not None:
            yield piece()

    return _emit(_PIECE_ARROW, found())


_CHAIN = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " parts array<struct<block:long,state:int,audit:string>>"
)
_CHAIN_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("parts", pa.list_(pa.struct([("block", pa.int64()), ("state", pa.int32()), ("audit", pa.string())])))]
)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces in order."""

    def whole(conv, pieces: list[tuple]) -> tuple:
        cells = []
        for p in pieces:
            ways = [None if c is None else (c, a) for c, a in zip(p[11], p[12], strict=True)]
            cells.append(tuple(tuple(ways[4 * s : 4 * s + 4]) for s in STATES))
        cost, audit, parts = chain(cells)
        dated = [p for p in pieces if p[3] is not None]
        distinct = sum(p[2] for p in pieces) - sum(a[4] == b[3] for a, b in zip(dated, dated[1:], strict=False))
        gaps = dated[-1][4] - dated[0][3] + 1 - distinct if dated else 0
        illegal = sum(p[8] for p in pieces) + sum(a[10] + b[9] not in LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
        sums = [sum(p[i] for p in pieces) for i in (5, 6, 7)]
        given = [{"block": p[1], "state": s, "audit": a} for p, (s, a) in zip(pieces, parts, strict=True)]
        return conv, gaps, *sums, illegal, cost, audit, given

    def found() -> Iterator[tuple]:
        pieces: list[tuple] = []
        for row in _rows_of(batches, tuple(_PIECE_ARROW.names)):
            if pieces and pieces[0][0] != row[0]:
                yield whole(pieces[0][0], pieces)
                pieces = []
            pieces.append(row)
        if pieces:
            yield whole(pieces[0][0], pieces)

    return _emit(_CHAIN_ARROW, found())


_EDIT_ARROW = pa.schema([("at", pa.int64()), ("edits", pa.list_(pa.string()))])


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What becomes of each row: a piece's first state and audit come before its rows."""

    def found() -> Iterator[tuple]:
        held: list[tuple] = []
        state, audit = 0, ""

        def piece() -> Iterator[tuple]:
            steps = edits(state, audit, [copies for _, copies, _ in held])
            for at, _, letter in held:
                out = next(steps)
                while out is None:  # the first state keeps a row of either role
                    out = steps.send(NEXT_STATE[0][letter])
                yield at, out

        for at, copies, letter, first, own in _rows_of(batches, ("at", "copies", "letter", "state", "audit")):
            if own is not None:
                yield from piece()
                held, state, audit = [], first, own
            else:
                held.append((at, copies, letter))
        yield from piece()

    return _emit(_EDIT_ARROW, found())


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Faults, cost and edits per conversation, and the repaired turns.

    The first table has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit; the second conv_id, block, at, part (which
    order the turns of a conversation), role and text. A conversation without rows is in neither.
    """
    placed = _placed(rows)
    letter = F.left("role", F.lit(1)).alias("letter")
    light = placed.select("conv_id", "block", "at", "turn", letter, "copies", "blank", "cut", "later")
    pieces = stored(_sorted_batches(light, ["conv_id", "block"], ["at"], _pieces, _PIECE), "repair-pieces", small=True)
    told = stored(_sorted_batches(pieces, ["conv_id"], ["block"], _conversations, _CHAIN), "repair-conversations", small=True)

    given = told.select("conv_id", F.inline("parts"))
    ahead = given.select("conv_id", "block", F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("copies"), F.lit("").alias("letter"), "state", "audit")
    each = light.select("conv_id", "block", "at", "copies", "letter", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("audit"))
    become = _sorted_batches(each.unionByName(ahead), ["conv_id", "block"], ["at"], _edited, "at long, edits array<string>")
    turns = placed.select("conv_id", "block", "at", "role", "text").join(become.filter(F.size("edits") > 0), "at")
    part = turns.select("conv_id", "block", "at", "role", "text", F.posexplode("edits").alias("part", "edit"))
    new_role = F.when(F.col("edit") == "k", F.col("role")).when(F.lower("edit") == "u", "user").otherwise("assistant")
    new_text = F.when(F.col("edit").isin("U", "A"), "").otherwise(F.col("text"))
    repaired = part.select("conv_id", "block", "at", "part", new_role.alias("role"), new_text.alias("text"))
    return told.drop("parts"), repaired


_HASH_ARROW = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        key, sha, open_ = None, None, False
        for conv, line in _rows_of(batches, ("conv_id", "line")):
            if not open_ or conv != key:
                if open_:
                    yield key, sha.hexdigest()
                key, sha, open_ = conv, hashlib.sha256(line.encode()), True
            else:
                sha.update(b"\n" + line.encode())
        if open_:
            yield key, sha.hexdigest()

    return _emit(_HASH_ARROW, found())


def line_digests(lines: DataFrame, order: list[str], line: Column) -> DataFrame:
    """SHA-256 of each conversation's lines in order, joined by newlines. A task reads its conversations row by row and keeps none."""
    rows = lines.select("conv_id", *order, line.alias("line"))
    return _sorted_batches(rows, ["conv_id"], order, _hashed, "conv_id long, sha256 string")

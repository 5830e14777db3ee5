"""Personal data in whole texts: fixed shapes, and identifiers that only their context gives away.

Base shapes (leftmost, not overlapping within a kind; failing matches are dropped without another try): email addresses, IP addresses
with parts up to 255, card numbers of 13 to 19 digits that pass the Luhn test, phone numbers of 9 to 15 digits after a plus.

Bootstrapped contextual extraction adds spans that have roughly the shape of a kind but miss its rule (an address without a
dot, a number that fails the test, a phone number without the plus). Base spans are the seeds. The words before a seed are
its lexical patterns. Patterns and instances form a graph that is scored in rounds: a pattern by the share of its instances that
are believed, an unproven instance by its best pattern. What trusted patterns discover counts as seeds from then on, and the scoring starts
again until no further pattern is trusted. Spans behind a trusted pattern are added unless they overlap a base span of their kind.

The expressions below are linear in the length of a text: a match can only start where a run of its characters starts, and
separators that stand between two parts are first turned into marks of equal length, so no group repeats. Offsets count code
points, ends are exclusive. Null texts count as empty and have no spans (``mask`` keeps them null); repeated rows get equal results; an
empty table gives no rows. Other columns pass through whatever their names; columns named like the two results are replaced. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.sieve import sieved
from tiffin.llm.store import stored

KINDS = ("email", "ip", "card", "phone")
#: A pattern is trusted from this share of believed instances (one unbelieved is added to its count) and so many different seeds.
CONFIDENCE = 0.8
MIN_SEEDS = 4
#: Rounds of scoring between patterns and instances, for each extension of the seeds. More would let unproven instances vouch for themselves.
ROUNDS = 3
_DOT, _GAP, _NONE = "\x01", "\x02", "\x04"
_LOCAL = r"[A-Za-z0-9._%+\x01-]"
# Marks: a dot between two label characters is \x01, a blank or hyphen between two digits is \x02.
_BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++",
    "ip": r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)",
    "card": r"(?<![0-9\x02])[0-9][0-9\x02]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Shapes of unproven instances that no base expression finds.
_LOOSE = {
    "email": r"(?<!\S)[^\s@]++@[^\s@]++(?!\S)",
    "phone": r"(?<![+0-9A-Za-z.(-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-])",
}
_SPAN = "array<struct<kind:string,start:int,end:int,seed:boolean,value:string,left:string>>"
_BLOCK = 256


def _simple_running(numbers: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.aggregate(
        numbers, none, lambda out, x: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + x))
    )


def _running(numbers: Column) -> Column:
    """Running totals of an array, by blocks: appending to one long array would take the square of its length."""
    count = F.ceil(F.size(numbers) / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: F.slice(numbers, b * _BLOCK + 1, _BLOCK))
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x))
    before = F.zip_with(_simple_running(totals), totals, lambda end, own: end - own)
    return F.flatten(F.zip_with(blocks, before, lambda block, base: F.transform(_simple_running(block), lambda x: x + base)))


def _find(df: DataFrame, text: Column, name: str, expression: str, kind: str, proven) -> DataFrame:
    """Adds a column of the matches of an expression with their offsets, and whether they pass the rule of the kind. Values and the words before
    them are given as the text has them, without marks, so that an identifier has one value however it was found."""
    own = "" if kind == "card" else " "
    found = df.withColumns(
        {"_gap": F.split(text, expression, -1), "_hit": F.regexp_extract_all(text, F.lit(expression), F.lit(0))}
    )
    found = found.withColumn("_gap", F.slice("_gap", 1, F.size("_hit")))
    found = found.withColumn("_end", _running(F.zip_with("_gap", "_hit", lambda g, h: F.length(g) + F.length(h))))

    def span(i: Column) -> Column:
        hit, end = F.get(F.col("_hit"), i), F.get(F.col("_end"), i)
        before = F.translate(F.right(F.get(F.col("_gap"), i), F.lit(80)), _DOT + _GAP, ". ")
        words = F.slice(F.reverse(F.split(F.trim(F.regexp_replace(before, r"\s+", " ")), " ")), 1, 2)
        return F.struct(
            F.lit(kind).alias("kind"),
            (end - F.length(hit)).alias("start"),
            end.alias("end"),
            proven(hit).alias("seed"),
            F.translate(hit, _DOT + _GAP, "." + own).alias("value"),
            F.lower(F.concat_ws(" ", F.reverse(words))).alias("left"),
        )

    spans = F.when(F.size("_hit") > 0, F.transform(F.sequence(F.lit(0), F.size("_hit") - 1), span))
    return found.withColumn(name, F.coalesce(spans, F.array().cast(_SPAN))).drop("_gap", "_hit", "_end")


def _part_fits(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) <= 3) & (F.lpad(bare, 3, "0") <= "255")


def _luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the Luhn test."""
    order = F.split(F.reverse(digits), "")
    value = F.transform(order, lambda d, i: F.try_to_number(d, F.lit("9")).cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(value, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


_PROVEN = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.forall(F.split(hit, r"\."), _part_fits),
    "card": lambda hit: _luhn(F.translate(hit, _GAP, "")),
    "phone": lambda hit: F.length(F.translate(hit, " ().-+", "")).between(9, 15),
}


def candidates(df: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """Adds the spans of all kinds: those that pass their kind's rule (seed) and those that only look like it."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), "\x01\x02", _NONE * 2)
    work = df.withColumn("_t", plain).withColumns(
        {
            "_e": F.regexp_replace("_t", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT),
            "_c": F.regexp_replace("_t", r"(?<=[0-9])[ -](?=[0-9])", _GAP),
        }
    )
    source = {"email": "_e", "ip": "_t", "card": "_c", "phone": "_t"}
    for kind in KINDS:
        work = _find(work, F.col(source[kind]), f"_{kind}", _BASE[kind], kind, _PROVEN[kind])
    for kind, expression in _LOOSE.items():
        work = _find(work, F.col("_t"), f"_loose_{kind}", expression, kind, lambda hit: F.lit(False))
    parts = [f"_{k}" for k in KINDS] + [f"_loose_{k}" for k in _LOOSE]

    def outside(kind: str) -> Column:
        """Loose spans that overlap no base span of their kind: what lies in one is that identifier, not another."""
        hits = F.filter(f"_{kind}", lambda b: b["seed"])
        return F.filter(f"_loose_{kind}", lambda s: ~F.exists(hits, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    every = F.concat(*(F.col(f"_{k}") for k in KINDS), *map(outside, _LOOSE))
    # A run of digits that is too short or too long for a card is no candidate either; likewise for phone numbers.
    sized = F.filter(
        every,
        lambda s: s["seed"]
        | (s["kind"].isin("email", "ip"))
        | ((s["kind"] == "card") & F.length(F.translate(s["value"], _GAP, "")).between(13, 19))
        | ((s["kind"] == "phone") & F.length(F.translate(s["value"], " ().-+", "")).between(7, 15)),
    )
    return work.withColumn(out, sized).drop("_t", "_e", "_c", *parts)


def _patterns(span: Column) -> Column:
    """The lexical patterns of a span: its kind with the one and the two words before it."""
    last = F.regexp_extract(span["left"], r"(\S+)$", 1)
    two = F.when(F.contains(span["left"], F.lit(" ")), F.concat_ws("|", span["kind"], span["left"]))
    return F.array_compact(F.array(F.when(last != "", F.concat_ws("|", span["kind"], last)), two))


def trusted_patterns(found: DataFrame, column: str = "found") -> DataFrame:
    """(pattern): all patterns of high confidence, from all spans of all rows."""
    spans = found.select(F.explode(column).alias("s"))
    links = stored(
        spans.select(F.col("s.kind").alias("kind"), F.col("s.value").alias("value"), F.col("s.seed").alias("seed"), F.explode(_patterns(F.col("s"))).alias("pattern"))
        .groupBy("pattern", "kind", "value")
        .agg(F.max("seed").alias("seed")),
        "pii-links",
        small=True,
    )
    believed, before = links, -1
    while True:
        trusted = stored(_scored(believed), "pii-patterns", small=True)
        count = trusted.count()
        if count == before:
            return trusted
        before = count
        # What a trusted pattern discovers counts as a seed wherever it occurs, and may make further patterns.
        known = links.filter(~F.col("seed")).join(trusted, "pattern").select("kind", "value", F.lit(True).alias("known")).distinct()
        met = links.join(known, ["kind", "value"], "left")
        believed = met.select("pattern", "kind", "value", (F.col("seed") | F.coalesce("known", F.lit(False))).alias("seed"))


def _scored(links: DataFrame) -> DataFrame:
    """(pattern): those of high confidence after some rounds between patterns and instances, given the seeds."""
    belief = links.select("kind", "value", F.col("seed").cast("double").alias("belief")).distinct()
    for _ in range(ROUNDS):
        scored = stored(
            links.join(belief, ["kind", "value"])
            .groupBy("pattern")
            .agg((F.sum("belief") / (F.count("*") + 1)).alias("confidence"), F.sum(F.col("seed").cast("int")).alias("seeds")),
            "pii-scores",
            small=True,
        )
        belief = (
            links.join(scored, "pattern")
            .groupBy("kind", "value")
            .agg(F.when(F.max("seed"), 1.0).otherwise(F.max(F.when(F.col("seeds") >= MIN_SEEDS, F.col("confidence")).otherwise(0.0))).alias("belief"))
        )
    return scored.filter((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= MIN_SEEDS)).select("pattern")


def with_context(found: DataFrame, patterns: DataFrame, key: str, column: str = "found") -> DataFrame:
    """Adds base_spans and spans (all), each by kind as listed, then start; offsets only. ``key`` tells the rows of ``found`` apart."""
    unproven = F.flatten(F.transform(F.filter(column, lambda s: ~s["seed"]), _patterns))
    asked = found.select(key, F.explode(F.array_distinct(unproven)).alias("pattern"))
    known = asked.join(patterns, "pattern").groupBy(key).agg(F.collect_set("pattern").alias("_known"))
    shape = "array<struct<kind:string,start:int,end:int>>"

    def placed(spans: Column) -> Column:
        ranked = F.array_sort(
            F.transform(spans, lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        )
        return F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(shape)

    work = found.join(known, key, "left").withColumn("_base", F.filter(column, lambda s: s["seed"]))
    loose = F.filter(
        column,
        lambda s: ~s["seed"]
        & F.coalesce(F.arrays_overlap(_patterns(s), F.col("_known")), F.lit(False))
        & ~F.exists("_base", lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    work = work.withColumn("_more", loose)
    return work.withColumns({"base_spans": placed(F.col("_base")), "spans": placed(F.concat("_base", "_more"))}).drop("_base", "_more", "_known")


def _carried(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The columns of a table in one struct, where their names can't clash with those used here."""
    return df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in columns]).alias("_in"), *more)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """Each row with base_spans and spans in place of its text. The texts are read once; what is kept of them is their candidates."""
    kept = [c for c in df.columns if c not in (text, "base_spans", "spans")]
    work = candidates(_carried(df, kept, F.col(text).alias("_text")), "_text").drop("_text")
    found = stored(work.withColumn("_row", F.monotonically_increasing_id()), "pii-found", small=True)
    done = with_context(found, trusted_patterns(found), "_row")
    return done.select(*[F.col(f"_in.`{c}`").alias(c) for c in kept], "base_spans", "spans")


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; overlapping spans become one, named after the first of them."""
    # Equal texts have equal candidates, so a text's digest stands for it and the texts are searched once.
    # Stored before it is filtered: the optimizer would put the search into the filter, and again into every use of its parts.
    texts = df.select(F.col(text).alias("_plain"), F.md5(text).alias("_text"))
    every = stored(candidates(texts, "_plain").select("_text", "found"), "pii-found", small=True)
    found = every.filter(F.size("found") > 0)
    spans = with_context(found.dropDuplicates(["_text"]), trusted_patterns(found), "_text").select("_text", "spans")
    spans = stored(spans.filter(F.size("spans") > 0), "pii-spans", small=True)
    # Only texts that may have spans are moved.
    rows = sieved(_carried(df, df.columns, F.col(text).alias("_plain"), F.md5(text).alias("_text")), "_text", spans.select("_text"))
    work = rows.filter("_may").join(spans, "_text", "left").withColumn("spans", F.coalesce("spans", F.array()))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    kind = "array<struct<start:int,end:int,kind:string>>"

    def join(out: Column, s: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when(last.isNotNull() & (s["start"] < last["end"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(
            F.concat(out, F.array(s))
        )

    work = work.withColumn("_cover", F.aggregate(by_start.cast(kind), F.array().cast(kind), join))
    n = F.size("_cover")

    def piece(i: Column) -> Column:
        begin = F.when(i > 0, F.get(F.col("_cover"), i - 1)["end"]).otherwise(0)
        own = F.get(F.col("_cover"), i)
        end = F.coalesce(own["start"], F.length("_plain"))
        mark = F.coalesce(F.concat(F.lit("["), F.upper(own["kind"]), F.lit("]")), F.lit(""))
        return F.concat(F.substr(F.col("_plain"), begin + 1, end - begin), mark)

    masked = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n), piece), "")).otherwise(F.col("_plain"))
    done = work.select(*[(masked if c == text else F.col(f"_in.`{c}`")).alias(c) for c in df.columns])
    return rows.filter("not _may").select(*[F.col(f"_in.`{c}`").alias(c) for c in df.columns]).unionAll(done)

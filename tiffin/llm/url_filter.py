"""URL filters: rules on hosts and paths, carried over to aliases.

A rule (action, host, path) fits a url whose host is the rule's or a subdomain of it and whose path starts with the rule's; the longest
rule (host and path together) decides, allow before block among equally long ones.

A url that no rule fits takes the decision of its aliases: the urls connected with it by redirects and canonical links, directly
or through others. Rules are applied to every url on the way. If a rule allows one of the aliases, it is allowed; else if
a rule blocks one, it is blocked; else it is allowed.

Edges come from a table of redirects, if given, and from pages: ``<link rel="canonical" href=...>`` and ``<meta http-equiv="refresh"
content="...url=...">``. A reference without ``://`` counts as one on the same host if it begins with ``/``, else it is ignored.
For aliases a url is its host, path and query; the scheme and the fragment don't matter and an empty path is ``/``.

Null urls and urls without ``://`` have an empty host and path, fit no rule and have no alias, so they are allowed; null pages
have no edges. Every row gets its own verdict, repeated ones too. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.graph import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RANK = "struct<length:int,allow:boolean,rule:string>"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(action, host, path) rows of a list of rules."""
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("action", "host", "path")))
    rows = [F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """Host, path and query, by which aliases are told apart; null without a host."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.coalesce(query, F.lit(""))))


def judge(rows: DataFrame, rules: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """Adds rule and action, null where no rule fits. One equi-join for each depth of a rule's host; rules of a host arrive as one row."""
    own = rules.filter("host is not null and path is not null and action is not null").select(
        "action", "path", F.translate("host", _UPPER, _LOWER).alias("host")
    )
    by_host = own.groupBy("host").agg(F.collect_set(F.struct("path", "action")).alias("_fit"))
    depths = [r[0] for r in own.select(F.size(F.split("host", r"\.")).alias("d")).distinct().orderBy("d").collect()]
    out = rows.withColumn("_best", F.lit(None).cast(_RANK))
    for d in depths:
        level = by_host.filter(F.size(F.split("host", r"\.")) == d).select(F.col("host").alias("_suffix"), "_fit")
        out = out.withColumn("_suffix", F.substring_index(host, ".", -d)).join(level, "_suffix", "left")
        fitting = F.filter("_fit", lambda r: F.startswith(F.col(path), r["path"]))
        ranked = F.transform(
            fitting,
            lambda r: F.struct(
                F.length(F.concat("_suffix", r["path"])).alias("length"),
                (r["action"] == "allow").alias("allow"),
                F.concat("_suffix", r["path"]).alias("rule"),
            ),
        )
        out = out.withColumn("_best", F.greatest("_best", F.array_max(ranked))).drop("_suffix", "_fit")
    return out.withColumns(
        {
            "rule": F.col("_best.rule"),
            "action": F.when(F.col("_best").isNotNull(), F.when(F.col("_best.allow"), "allow").otherwise("block")),
        }
    ).drop("_best")


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']?([^"'>]*)""", 1)
    return F.when(value != "", F.replace(value, F.lit("&amp;"), F.lit("&")))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): alias keys of a page and of the urls that its canonical link and its refresh name."""
    link = F.regexp_extract(html, r"""(?is)(<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>)""", 1)
    fresh = F.regexp_extract(html, r"""(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>)""", 1)
    target = F.regexp_extract(fresh, r"""(?is)\burl\s*=\s*["']?([^"'>\s]*)""", 1)
    found = pages.filter(F.col(html).isNotNull()).select(
        F.col(url).alias("url"),
        F.explode(F.array(_attribute(link, "href"), F.when(target != "", F.replace(target, F.lit("&amp;"), F.lit("&"))))).alias("to"),
    )
    absolute = F.when(F.instr("to", "://") > 0, F.col("to")).when(
        F.startswith("to", F.lit("/")), F.concat(F.lit("x://"), host_of(F.col("url")), F.col("to"))
    )
    return found.select(alias_key(F.col("url")).alias("a"), alias_key(absolute).alias("b")).filter("a is not null and b is not null")


def filter_urls(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, row_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(row_id, url, host, path, rule, verdict, decided_by) of every row. ``redirects`` has (from_url, to_url)."""
    edges = page_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(alias_key(F.col("from_url")).alias("a"), alias_key(F.col("to_url")).alias("b"))
        )
    groups = components(edges)
    nodes = groups.select(
        "node", "component", F.regexp_extract("node", r"^([^/?#]*)", 1).alias("host"), F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1).alias("path")
    )
    decided = (
        judge(nodes, rules)
        .filter("action is not null")
        .groupBy("component")
        .agg(F.max(F.col("action") == "allow").alias("allowed"))
    )
    carried = groups.join(decided, "component").select(F.col("node").alias("_key"), F.when(F.col("allowed"), "allow").otherwise("block").alias("carried"))
    rows = pages.select(F.col(row_id), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = judge(rows, rules).withColumn("_key", alias_key(F.col("url"))).join(carried, "_key", "left")
    return judged.select(
        row_id,
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("action", "carried", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("carried").isNotNull(), "alias").otherwise("default").alias("decided_by"),
    )

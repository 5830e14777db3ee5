"""The registered queries of this package. Each reads its whole table."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import (
    bpe,
    chat,
    decontaminate,
    langid,
    licenses,
    merkle,
    ngram_join,
    pii,
    repair,
    simhash,
    substring_dedup,
    url_filter,
    warc,
)
from tiffin.llm.store import stored
from tiffin.sources.tables import from_rows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path()
    done = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(_table(spark, sf_dir, "documents"), n=3, percent=90)


# The rules of the url query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_REFERENCE = r"""
    SELECT url, regexp_extract(html, '(?is)(<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>)', 1) AS tag, 'href' AS kind FROM pages
    UNION ALL
    SELECT url, regexp_extract(html, '(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>)', 1), 'url' FROM pages
"""
_URL_SQL = r"""
WITH RECURSIVE
rules(action, host, path) AS (VALUES $rules),
seen AS ($reference),
aimed AS (
    SELECT url, replace(regexp_extract(tag, '(?is)(?:href|url)\s*=\s*["'']?([^"''>\s]*)', 1), '&amp;', '&') AS target FROM seen WHERE tag <> ''
),
named AS (
    SELECT url AS f, CASE WHEN contains(target, '://') THEN target
                          WHEN starts_with(target, '/') THEN 'x://' || regexp_extract(url, '^.*?://([^/?#]*)', 1) || target END AS t
    FROM aimed WHERE contains(url, '://')
),
urls AS (SELECT url AS u FROM pages UNION SELECT f FROM named UNION SELECT t FROM named WHERE t IS NOT NULL),
cut AS (
    SELECT u, CASE WHEN contains(u, '://') THEN u[strpos(u, '://') + 3:] END AS rest FROM urls
),
split AS (
    SELECT u, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1), '') AS query
    FROM cut
),
ruled AS (
    SELECT s.u, s.host, s.path, CASE WHEN s.host <> '' THEN s.host || CASE WHEN s.path = '' THEN '/' ELSE s.path END || s.query END AS node,
           (SELECT r.host || r.path FROM rules r WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
            ORDER BY length(r.host || r.path) DESC, r.action LIMIT 1) AS rule,
           (SELECT r.action FROM rules r WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
            ORDER BY length(r.host || r.path) DESC, r.action LIMIT 1) AS action
    FROM split s
),
edges AS (
    SELECT a.node AS x, b.node AS y FROM named n JOIN ruled a ON a.u = n.f JOIN ruled b ON b.u = n.t WHERE a.node IS NOT NULL AND b.node IS NOT NULL
),
ties AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach(x, y) AS (SELECT x, x FROM ties UNION SELECT r.x, t.y FROM reach r JOIN ties t ON t.x = r.y),
carried AS (SELECT r.x, min(n.action) AS action FROM reach r JOIN ruled n ON n.node = r.y WHERE n.action IS NOT NULL GROUP BY r.x)
SELECT p.page_id, coalesce(r.host, '') AS host, coalesce(r.path, '') AS path, r.rule, coalesce(r.action, c.action, 'allow') AS verdict
FROM pages p LEFT JOIN ruled r ON r.u = p.url LEFT JOIN carried c ON c.x = r.node
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)
    return _URL_SQL.replace("$rules", rules).replace("$reference", _REFERENCE)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash.compare_edits(_table(spark, sf_dir, "documents"))
    done = stored(done.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited"), "fingerprints", small=True)
    near = simhash.within_radius(done, radius=3)
    return done.join(near, "fingerprint").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return done.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(spark, manifest).select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no path, so source and language serve as their directories."""
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", "text", "source", "lang"), path).select(
        "doc_id", "license", F.round("cosine", 6).alias("cosine"), "is_file", "license_from"
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out()))
    done = langid.identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return done.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    altered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf(*fields, altered))
    done = merkle.manifest(
        docs,
        merkle.leaf(*fields, F.col("text")),
        group="lang",
        order=["doc_id"],
        keep={"doc_id": F.col("doc_id"), "tampered": tampered},
    )
    folded = done.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.proof(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_MERKLE_SQL = r"""
WITH RECURSIVE
parts AS (
    SELECT doc_id, lang, text, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
            lambda c: [CASE WHEN c = '' THEN 0 ELSE ascii(c) END::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
    FROM documents
),
hashed AS (
    SELECT doc_id, coalesce('1' || lang, '0') AS grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
    FROM parts
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM hashed
),
nodes(grp, lvl, idx, digest, n) AS (
    SELECT grp, 0, idx, leaf, n FROM leaves
    UNION ALL
    SELECT grp, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM nodes WHERE n > 1 GROUP BY grp, lvl, idx // 8
),
subroots AS (SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes(lvl, idx, digest, n) AS (
    SELECT 0, idx, digest, n FROM subroots
    UNION ALL
    SELECT lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8 FROM upper_nodes WHERE n > 1 GROUP BY lvl, idx // 8
),
steps AS (
    SELECT a.grp, a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM (SELECT * FROM nodes WHERE n > 1 UNION ALL SELECT '', * FROM upper_nodes WHERE n > 1) a
    JOIN (SELECT * FROM nodes WHERE n > 1 UNION ALL SELECT '', * FROM upper_nodes WHERE n > 1) b
      ON a.grp = b.grp AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8
    GROUP BY a.grp, a.lvl, a.idx
),
walk(doc_id, leaf, own, grp, lvl, idx, h, proof) AS (
    SELECT doc_id, leaf, grp, grp, 0, idx, coalesce(tampered, leaf), '' FROM leaves
    UNION ALL
    SELECT w.doc_id, w.leaf, w.own, CASE WHEN s.grp IS NULL THEN '' ELSE w.grp END, CASE WHEN s.grp IS NULL THEN 0 ELSE w.lvl + 1 END,
           CASE WHEN s.grp IS NULL THEN t.idx ELSE w.idx // 8 END, CASE WHEN s.grp IS NULL THEN w.h ELSE sha256(s.l || w.h || s.r) END,
           CASE WHEN s.grp IS NULL THEN w.proof ELSE w.proof || s.l || s.r END
    FROM walk w LEFT JOIN steps s ON s.grp = w.grp AND s.lvl = w.lvl AND s.idx = w.idx LEFT JOIN subroots t ON t.grp = w.own
    WHERE s.grp IS NOT NULL OR w.grp <> ''
),
top AS (SELECT digest AS root, lvl FROM upper_nodes WHERE n = 1)
SELECT w.doc_id, w.leaf, t.digest AS subroot, top.root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = top.root AS verified
FROM walk w JOIN top ON w.grp = '' AND w.lvl = top.lvl JOIN subroots t ON t.grp = w.own
"""


# The conversation that the chat query adds.
EXTRA_CHAT = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = from_rows(spark, EXTRA_CHAT, "conv_id bigint, turn bigint, role string, text string")
    done = chat.format_chats(rows.unionByName(extra)).withColumns(
        {
            "turns": chat.read_turns(F.col("formatted")),
            "loss": F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_mask")), ""),
        }
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        merkle.digest(lines).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        merkle.digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES $extra
),
escaped AS (
    SELECT *,
           length(regexp_replace(regexp_replace(role, '\[(\\*)(/?INST\])', '[\\\1\2', 'g'), '<(\\*)(/?s>)', '<\\\1\2', 'g')) AS role_chars,
           length(regexp_replace(regexp_replace(text, '\[(\\*)(/?INST\])', '[\\\1\2', 'g'), '<(\\*)(/?s>)', '<\\\1\2', 'g')) AS text_chars,
           role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS opens
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN opens THEN 6 + role_chars + 7 + 4 ELSE 3 END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def _chat_sql() -> str:
    rows = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in EXTRA_CHAT)
    return _CHAT_SQL.replace("$extra", rows)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with every twentieth row lost, emptied, without its full stops, repeated, or turned into a user's."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fate = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
        (fate == 0).alias("lost"),
    ).filter("not lost").drop("lost")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told, turns = repair.repair(damaged(rows))
    prints = repair.line_digests(turns, ["block", "at", "part"], F.concat_ws(":", "role", "text"))
    every = rows.select("conv_id").distinct()
    done = every.join(told.withColumnRenamed("conv_id", "_told"), F.col("conv_id").eqNullSafe(F.col("_told")), "left")
    done = done.join(prints.withColumnRenamed("conv_id", "_print"), F.col("conv_id").eqNullSafe(F.col("_print")), "left")
    none = F.lit(hashlib.sha256().hexdigest())
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return done.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", none).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_ngram_join": op3_ngram_join,
    "op4_url_filter": op4_url_filter,
    "op5_fingerprints": op5_fingerprints,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_licenses": op8_licenses,
    "op9_decontaminate": op9_decontaminate,
    "op10_langid": op10_langid,
    "op11_merkle": op11_merkle,
    "op12_chat": op12_chat,
    "op13_repair": op13_repair,
}
SQL: dict[str, str] = {"op4_url_filter": _url_sql(), "op11_merkle": _MERKLE_SQL, "op12_chat": _chat_sql()}

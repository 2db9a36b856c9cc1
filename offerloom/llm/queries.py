"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import (
    decontamination,
    divergence,
    importance,
    language,
    language_model,
    neighbours,
    packing,
    quality,
    secrets,
    simhash,
    token_counts,
    toxicity,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` and the SQL that must agree with it."""

    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans_sql(kind: str, ordinal: int) -> str:
    """DuckDB rows (doc, spans of one kind): gaps and matches alternate."""
    pattern = secrets.PATTERNS[kind].replace("'", "''")
    value = f"regexp_extract(hit, '{pattern}', 2)" if kind == "assign" else "hit"
    return f"""
    SELECT rid, owner, repo, {ordinal} AS ord, '{kind}' AS kind, start, start + len(hit) AS stop, hit, {value} AS value
    FROM (
        SELECT rid, owner, repo, hits[i] AS hit,
               list_sum(list_transform(gaps[1:i], lambda x: len(x)))::BIGINT
               + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0)::BIGINT AS start
        FROM (
            SELECT rid, owner, repo, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
            FROM (
                SELECT rid, owner, repo, regexp_extract_all(text, '{pattern}') AS hits,
                       regexp_split_to_array(text, '{pattern}') AS gaps
                FROM docs
            )
        )
    ) WHERE {f"len(value) >= {secrets.VALUE}" if kind == "assign" else "true"}"""


OP6 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source AS owner,
           concat_ws('/', source, lang) AS repo
    FROM documents
), spans AS ({" UNION ALL ".join(_spans_sql(k, i) for i, k in enumerate(secrets.PATTERNS))}
), hashed AS (
    SELECT *, sha256(value) AS hash,
           len(list_distinct(string_split(value, ''))) >= {secrets.DISTINCT_CHARS} AS varied
    FROM spans
), shared AS (SELECT hash, count(DISTINCT owner) AS owners FROM hashed GROUP BY hash
), judged AS (
    SELECT rid, ord, kind || ':' || start || ':' || stop AS span, start, stop, owners >= {secrets.EXAMPLE_OWNERS} AS example,
           varied AND owners < {secrets.EXAMPLE_OWNERS} AS live
    FROM hashed JOIN shared USING (hash)
), per AS (
    SELECT rid,
           count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
           coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (ord < 3), '') AS base,
           string_agg(span, ',' ORDER BY start, ord) AS spans, count(*) FILTER (live) AS n_live,
           count(*) FILTER (example) AS n_example,
           coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (live), '') AS live_spans
    FROM judged GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example,
       coalesce(live_spans, '') AS live_spans
FROM docs LEFT JOIN per USING (rid)
"""


@query("op1_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(table(spark, sf_dir, "documents"))


# The rules, and the labels of hosts whose pages the list names.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_HOST = rf"(^|\.)({'|'.join(LISTED_LABELS)})(\.|$)"


def _rule_sql(what: int) -> str:
    cases = ""
    for rule in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])):
        v, h, p = rule
        out = h + p if what else v
        cases += f" WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{out}'"
    return f"CASE{cases} END"


OP2 = f"""
WITH p AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), q AS (SELECT *, regexp_matches(host, '{LISTED_HOST}') AS listed, {_rule_sql(1)} AS rule, {_rule_sql(0)} AS fixed FROM p)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM q
"""


@query("op2_url_filter", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    listed = pages.where(host.rlike(LISTED_HOST)).select(F.concat(host, path).alias("key"))
    return urls.judge_urls(pages, URL_RULES, listed)


@query("op3_language_model")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def document_edits() -> Column:
    """Four edits per document, drawn from its id and text: a cut, a repeat of its start, a new start, a new end."""
    size = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    place = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    edits = [
        (F.pmod(place, size + 1), F.lit(25), F.lit("")),
        (F.pmod(place * 31, size + 1), F.lit(0), F.substring(F.coalesce("text", F.lit("")), 1, 40)),
        (F.lit(0), F.lit(3), F.lit("Edited: ")),
        (size * 2, F.lit(0), F.lit(" the end")),
    ]
    return F.array(*[
        F.struct(a.cast("long").alias("start"), b.cast("long").alias("remove"), c.alias("insert")) for a, b, c in edits
    ])


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").withColumn("edits", document_edits()))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def owner_columns() -> dict:
    """Who owns a document: its source, whose languages are taken for repositories."""
    return {"owner": F.col("source"), "repo": F.concat_ws("/", "source", "lang")}


@query("op6_secrets", OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"), **owner_columns())


OP7 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '{decontamination.WORD}') AS words
    FROM documents
), items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '{decontamination.WORD}') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, words[i:i + {decontamination.WINDOW - 1}] AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {decontamination.WINDOW - 2}, 2))) AS i
          FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT len(w) AS n FROM windows
), grams AS (
    SELECT rid, n, i, words[i:i + n - 1] AS w
    FROM (SELECT rid, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes)
), hits AS (SELECT rid, i, n, item_id FROM grams JOIN windows USING (w)
), covered AS (
    SELECT rid, count(DISTINCT p) AS n_hit
    FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid
), listed AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""


@query("op7_decontamination", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op9_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, bits=2)


@query("op11_importance")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), w AS (SELECT rid, lang, source, unnest(words) AS term FROM d
), kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.DOCUMENTS}
), v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), n AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
), g AS (
    SELECT lang, source, coalesce(total, 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source) USING (lang, source)
), p AS (
    SELECT lang, source, term, coalesce(n.n, 0) AS n, 1 + ({divergence.UNIT}::HUGEINT * (coalesce(n.n, 0) + {divergence.SMOOTHING})) // (g.total + {divergence.SMOOTHING} * v.v) AS p,
           1 + ({divergence.UNIT}::HUGEINT * (kept.n + {divergence.SMOOTHING})) // (v.total + {divergence.SMOOTHING} * v.v) AS q
    FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b USING (lang) LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source WHERE a.source <> b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


@query("op12_divergence", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

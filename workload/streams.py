"""Stream jobs, hooks and whole jobs."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from offerloom import plans, streaming
from offerloom.operators import profiles as pf
from offerloom.session import scratch_dir
from workload.registry import query
from workload.views import (
    AVAILABILITY_SNAKE,
    BAD_GTIN,
    CARD_URL,
    CURRENCY,
    DOMAIN,
    EVENT_URL,
    GTIN,
    HAS_OFFER,
    HOME_ORIGIN,
    RANKED_SQL,
    TLD,
    URL,
    cards,
    home_pages,
    numbered_lines,
    parts,
    product_pages,
    table,
)

# Extractor functions of this module reach workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def c(name):
    return F.col(name)


_MINOR = "CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)"
_OFFER_SQL = f"""
    SELECT p_partkey AS page_id, {URL} AS url, p_name AS name, {_MINOR} AS price, {CURRENCY} AS currency,
           CASE WHEN NOT ({BAD_GTIN}) THEN {GTIN} END AS gtin, {AVAILABILITY_SNAKE} AS availability
    FROM part WHERE {HAS_OFFER}"""


def _captured(spark, sf_dir):
    return product_pages(spark, sf_dir).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


@query("str1_stream_offers", _OFFER_SQL)
def stream_offers(spark, sf_dir):
    root = scratch_dir(spark, "str1")
    pages = _captured(spark, sf_dir)
    pages.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(pages.schema).parquet(f"{root}/in")
    streaming.stream_offers(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "page_id", "url", "name", "price", "currency", "gtin", "availability"
    )


@query("str2_stream_frontier", f"SELECT DISTINCT {EVENT_URL} AS unique_key FROM events")
def stream_frontier(spark, sf_dir):
    """Two batches: the later half of the events first, so that the second one is late."""
    root = scratch_dir(spark, "str2")
    events = table(spark, sf_dir, "events").select(F.expr(EVENT_URL).alias("unique_key"), c("ts").cast("timestamp").alias("seen_at"))
    middle = events.agg(F.expr("timestamp_micros(bigint(avg(unix_micros(seen_at))))")).first()[0]
    for part in (c("seen_at") > F.lit(middle), ~F.coalesce(c("seen_at") > F.lit(middle), F.lit(False))):
        events.where(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        (
            streaming.stream_frontier(stream)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/cp")
            .trigger(availableNow=True)
            .start(f"{root}/out")
            .awaitTermination()
        )
    return spark.read.parquet(f"{root}/out").select("unique_key")


@query(
    "str3_publish_batches",
    """SELECT l_suppkey AS job_id, kind, count(*) AS n_rows FROM lineitem, (SELECT unnest(['listings', 'popularity', 'table']) AS kind)
       WHERE kind = 'table' OR l_suppkey % 4 <> 0 GROUP BY ALL""",
)
def publish_batches(spark, sf_dir):
    root = scratch_dir(spark, "str3")
    rows = numbered_lines(spark, sf_dir).selectExpr(
        "l_suppkey AS job_id", f"{CARD_URL} AS url", "l_orderkey AS popularity_index", "l_suppkey % 4 = 0 AS skip_publishing"
    )
    rows.write.parquet(f"{root}/in")

    def publish(messages, kind, batch_id):
        messages.write.mode("overwrite").parquet(f"{root}/sent/kind={kind}/batch_id={batch_id}")

    streaming.publish_batches(
        spark.readStream.schema(rows.schema).parquet(f"{root}/in"), f"{root}/cp", f"{root}/table", publish
    ).awaitTermination()
    sent = spark.read.parquet(f"{root}/sent").select("job_id", "kind", "n_rows")
    stored = spark.read.parquet(f"{root}/table").select("job_id", F.lit("table").alias("kind"), F.lit(1).alias("n_rows"))
    return sent.unionByName(stored).groupBy("job_id", "kind").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "str4_stream_popularity",
    f"SELECT run, url, CAST(popularity_index AS BIGINT) AS popularity_index FROM ({RANKED_SQL})",
)
def stream_popularity(spark, sf_dir):
    """Two batches, later pages in the second one."""
    root = scratch_dir(spark, "str4")
    rows = cards(spark, sf_dir)
    split = rows.agg(F.max("page_number")).first()[0] // 2
    for later in (False, True):
        half = rows.where((c("page_number") > split) == later)
        half.repartition(4, "run", "page_number").write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    streaming.stream_popularity(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    return spark.read.parquet(f"{root}/out/ranks").select("run", "url", "popularity_index")


# -- hooks ----------------------------------------------------------------------------


@query(
    "udx1_register_profile",
    f"""SELECT p_partkey, CASE WHEN {TLD} = 'se' THEN 'SEK' END AS currency, CASE WHEN {TLD} = 'se' THEN 24 END AS page_size,
        CASE WHEN {TLD} = 'se' AND p_partkey % 7 < 3 THEN 'schema-json' ELSE '' END AS disabled FROM part""",
)
def register_profile(spark, sf_dir):
    registry = pf.Registry()
    for k in range(7):
        off = ("schema-json",) if k < 3 else ()
        registry.register_profile(pf.Profile(f"shop{k}.se", "SEK", 24, disabled_strategies=off))
    domain = c("domain")
    disabled = F.lit("")
    for name, strategies in registry.disabled().items():
        disabled = F.when(domain == name, F.lit(",".join(strategies))).otherwise(disabled)
    return parts(spark, sf_dir).select(
        "p_partkey",
        registry.lookup(domain, "currency").alias("currency"),
        registry.lookup(domain, "page_size").alias("page_size"),
        disabled.alias("disabled"),
    )


@query(
    "udx2_register_hooks",
    f"""SELECT p_partkey, CASE WHEN {DOMAIN} = 'shop0.se' THEN {URL} || '#canon' ELSE {URL} END AS url,
        CASE WHEN {DOMAIN} = 'shop0.se' THEN p_type END AS variant_group_url FROM part""",
)
def register_hooks(spark, sf_dir):
    registry = pf.Registry()
    registry.register_canonical("shop0.se", lambda u: F.concat(u, F.lit("#canon")))
    registry.register_finisher("shop0.se", lambda df: {"variant_group_url": c("p_type")})
    rows = parts(spark, sf_dir).withColumn("url", registry.apply_canonical(c("url"), c("domain")))
    return registry.apply_finishers(rows, "domain").select("p_partkey", "url", "variant_group_url")


@query(
    "udx3_register_rule",
    f"""SELECT p_partkey, CASE WHEN {DOMAIN} <> 'shop0.se' THEN NULL WHEN p_size % 3 = 0 THEN 'front' WHEN p_size % 2 = 0 THEN 'first'
        WHEN p_size > 25 THEN 'last' END AS error FROM part""",
)
def register_rule(spark, sf_dir):
    from offerloom.operators.outcomes import classify_pages

    registry = pf.Registry()
    registry.register_rule("shop0.se", lambda: c("p_size") % 2 == 0, "first")
    registry.register_rule("shop0.se", lambda: c("p_size") > 25, "last")
    registry.register_rule("shop0.se", lambda: c("p_size") % 3 == 0, "front", first=True)
    rows = parts(spark, sf_dir).withColumn("status", F.lit(200))
    return classify_pages(rows, registry.outcome_rules).select("p_partkey", "error")


def _headings(frames):
    for frame in frames:
        heading = frame["html"].str.extract(r"<h1>([^<]*)</h1>", expand=False)
        yield pd.DataFrame({"page_id": frame["page_id"], "heading": heading})


@query(
    "udx4_register_extractor",
    f"SELECT p_partkey AS page_id, p_name AS heading FROM part WHERE {DOMAIN} IN ('shop0.se', 'shop1.dk')",
)
def register_extractor(spark, sf_dir):
    from offerloom.functions import domain_of

    registry = pf.Registry()
    for domain in ("shop0.se", "shop1.dk"):
        registry.register_extractor(domain, _headings, "page_id bigint, heading string")
    pages = product_pages(spark, sf_dir).withColumn("domain", domain_of(c("url")))
    first, *rest = registry.extract_custom(pages).values()
    for other in rest:
        first = first.unionByName(other)
    return first


# -- whole jobs -----------------------------------------------------------------------------


def _job_a(spark, sf_dir, store=None):
    """Requests for all parts; pages for nine of ten, some of them gone."""
    pages = product_pages(spark, sf_dir).where("page_id % 10 <> 0").select(
        c("url").alias("request_url"),
        "url",
        "html",
        F.when(c("page_id") % 10 == 1, 404).otherwise(200).alias("status"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
    )
    requests = parts(spark, sf_dir).select(
        c("url").alias("request_url"), c("p_partkey").alias("popularity_index"), c("p_brand").alias("brand")
    )
    return plans.scrape_details(requests, pages, store=store)


@query(
    "job_scrape_details",
    f"""SELECT {URL} AS url, p_name AS name, p_brand AS brand, {_MINOR} AS price, p_partkey AS popularity_index
        FROM part WHERE {HAS_OFFER} AND p_partkey % 10 > 1""",
)
def scrape_details(spark, sf_dir):
    return _job_a(spark, sf_dir).offers.select("url", "name", "brand", "price", "popularity_index")


@query(
    "job_scrape_details_rejected",
    f"""SELECT {URL} AS request_url, CASE WHEN p_partkey % 10 = 1 THEN 'PageNotFoundError' ELSE 'PriceLiteUnavailableError' END AS reject_reason
        FROM part WHERE p_partkey % 10 = 1 OR (p_partkey % 10 > 1 AND NOT ({HAS_OFFER}))""",
)
def scrape_details_rejected(spark, sf_dir):
    return _job_a(spark, sf_dir).rejected.select("request_url", "reject_reason")


@query(
    "job_scrape_details_stored",
    f"""SELECT 'offer' AS kind, count(*) AS n FROM part WHERE {HAS_OFFER} AND p_partkey % 10 > 1
        UNION ALL SELECT 'rejected', count(*) FROM part WHERE p_partkey % 10 = 1 OR (p_partkey % 10 > 1 AND NOT ({HAS_OFFER}))
        UNION ALL SELECT 'asked', count(*) FROM part""",
)
def scrape_details_stored(spark, sf_dir):
    """Offers, rejected rows and coverage from one extraction, whose rows are stored."""
    job = _job_a(spark, sf_dir, scratch_dir(spark, "details"))
    kinds = job.offers.select(F.lit("offer").alias("kind")).unionByName(job.rejected.select(F.lit("rejected").alias("kind")))
    counts = kinds.groupBy("kind").agg(F.count("*").alias("n"))
    asked = job.coverage.agg(F.sum("n_urls").alias("n"))
    return counts.unionByName(asked.select(F.lit("asked").alias("kind"), "n"))


_SHOP = "CASE p_size % 4 WHEN 0 THEN 'norliving.dk' WHEN 1 THEN 'k-rauta.se' WHEN 2 THEN 'own.example' ELSE 'unknown.se' END"
_ASKED = f"'https://www.' || {_SHOP} || '/p/' || CAST(p_partkey AS STRING)"
# some requests of a ruled shop end at another shop
_ENDED = f"CASE WHEN p_size % 8 = 4 THEN 'https://elsewhere.example/p/' || CAST(p_partkey AS STRING) ELSE {_ASKED} END"


def _read_own(frames):
    """Extraction code of one shop: ``<b>name|price</b>``."""
    for frame in frames:
        found = frame["html"].str.extract(r"<b>(.*)[|](.*)</b>")
        yield frame[["request_url", "url", "fetched_at"]].assign(
            name=found[0], price=found[1].astype(float), currency="EUR"
        )


@query(
    "job_scrape_details_profiles",
    f"""SELECT p_partkey, {_ENDED} AS url, p_name AS name, {_MINOR} AS price,
        CASE p_size % 4 WHEN 0 THEN 'DKK' WHEN 2 THEN 'EUR' ELSE 'SEK' END AS currency FROM part""",
)
def scrape_details_profiles(spark, sf_dir):
    """Two shops with rules, one with an extractor, one unknown; every request is posted twice."""
    amount = "CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS STRING)"
    html = f"""CASE p_size % 4
        WHEN 0 THEN '<div class="product"><h1 class="product-info__title">' || p_name || '</h1><sale-price>' || replace({amount}, '.', ',') || ' kr.</sale-price></div>'
        WHEN 1 THEN '<div class="product-page__top-info"><h1 class="product-heading__product-name">' || p_name ||
            '</h1><i class="price-view__sale-price-container">' || replace({amount}, '.', ',') || ' kr/ st</i></div>'
        WHEN 2 THEN '<b>' || p_name || '|' || {amount} || '</b>'
        ELSE '<script type="application/ld+json">{{"@type":"Product","name":"' || p_name || '","offers":{{"price":"' || {amount} || '","priceCurrency":"SEK"}}}}</script>' END"""
    rows = parts(spark, sf_dir)
    captured = rows.selectExpr(
        f"{_ASKED} AS request_url", f"{_ENDED} AS url", f"{html} AS html", "200 AS status", "timestamp'2024-01-01' AS fetched_at"
    )
    requests = rows.selectExpr(f"{_ASKED} AS request_url", "p_partkey", "map('n', p_size) AS user_data")
    registry = pf.default_registry()
    registry.register_extractor(
        "own.example", _read_own, "request_url string, url string, fetched_at timestamp, name string, price double, currency string"
    )
    found = plans.scrape_details(requests.union(requests), captured, registry)
    return found.offers.select("p_partkey", "url", "name", "price", "currency")


@query(
    "job_explore_category",
    f"""SELECT run AS run, url, 'shop.example.se' AS retailer_domain, CAST(popularity_index AS BIGINT) AS popularity_index FROM ({RANKED_SQL})""",
)
def explore_category(spark, sf_dir):
    return plans.explore_category(cards(spark, sf_dir)).select("run", "url", "retailer_domain", "popularity_index")


@query(
    "job_extract_categories",
    f"SELECT {URL} AS url FROM part WHERE p_size % 3 = 0 AND p_partkey % 2 = 0",
)
def extract_categories(spark, sf_dir):
    """Pages of sizes 0 mod 3 list themselves; odd parts are known."""
    html = "'<a href=\"' || CASE WHEN p_size % 3 = 0 THEN url ELSE '/deeper' END || '\">x</a><a href=\"/y\">y</a>'"
    rows = parts(spark, sf_dir).selectExpr("p_partkey AS page_id", "url", f"{html} AS html")
    known = parts(spark, sf_dir).where("p_partkey % 2 = 1").select("url")
    return plans.extract_categories(rows, known)


@query(
    "job_explore_homepage",
    f"""SELECT DISTINCT l_orderkey, l_suppkey, l_partkey, l_linenumber, CAST(i AS BIGINT) AS pos,
        {HOME_ORIGIN} || '/p/' || CAST(l_partkey AS STRING) AS url
        FROM lineitem, (SELECT unnest([0, 3]) AS k), (SELECT unnest([0, 3, 4, 5]) AS i)
        WHERE l_partkey % 4 = 0 AND ((k = 0 AND i = 0) OR (k = 3 AND i = l_linenumber % 3 + 3))""",
)
def explore_homepage(spark, sf_dir):
    columns = ["l_orderkey", "l_suppkey", "l_partkey", "l_linenumber"]
    pages = home_pages(spark, sf_dir, distinct=True).withColumn("page_id", F.struct(*columns))
    known = numbered_lines(spark, sf_dir).where("l_partkey % 4 = 0").selectExpr(
        f"{HOME_ORIGIN} || '/p/' || CAST(l_partkey AS STRING) AS url"
    )
    out = plans.explore_homepage(pages.select("page_id", "url", "html"), known)
    return out.select("page_id.*", c("pos").cast("bigint").alias("pos"), "url")

"""Reports, messages and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom import sinks, sources
from offerloom.operators import listings as ls, reports as rp
from offerloom.session import scratch_dir
from workload.links import category_dim
from workload.registry import query
from workload.views import (
    CARD_URL,
    CURRENCY,
    DOMAIN,
    EVENT_STATUS,
    EVENT_URL,
    RANKED_SQL,
    URL,
    cards,
    outcomes_view,
    parts,
    table,
)


def c(name):
    return F.col(name)


# -- reports ------------------------------------------------------------------------


def _requests(spark, sf_dir):
    return parts(spark, sf_dir).select("url")


def _offers(spark, sf_dir):
    """Offers of two thirds of the parts; some came from a variant page."""
    return parts(spark, sf_dir).where("p_partkey % 3 <> 0").selectExpr(
        "CASE WHEN p_size % 2 = 0 THEN url ELSE url || '#v' END AS url",
        "CASE WHEN p_size % 4 = 1 THEN url END AS variant_group_url",
    )


_MISSED = "(p_partkey % 3 = 0 OR p_size % 4 = 3)"


@query(
    "rpt1_coverage",
    f"""SELECT domain, count(*) AS n_urls, CAST(sum(CASE WHEN p_partkey % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_products_found,
        CAST(sum(CASE WHEN {_MISSED} THEN 1 ELSE 0 END) AS BIGINT) AS n_products_not_found
        FROM (SELECT *, {DOMAIN} AS domain FROM part) GROUP BY domain""",
)
def coverage(spark, sf_dir):
    return rp.coverage(_requests(spark, sf_dir), _offers(spark, sf_dir))


@query("rpt1_uncovered", f"SELECT {DOMAIN} AS domain, {URL} AS url FROM part WHERE {_MISSED}")
def uncovered(spark, sf_dir):
    return rp.uncovered(_requests(spark, sf_dir), _offers(spark, sf_dir)).select("domain", "url")


@query(
    "rpt2_shortfall",
    """SELECT '/c/' || CAST(l_suppkey AS STRING) AS category_url, count(*) AS expected,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS BIGINT) AS actual,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM lineitem GROUP BY 1
       HAVING sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 0""",
)
def shortfall(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("'/c/' || l_suppkey AS category_url", "l_returnflag")
    return rp.shortfall(rows, rows.where("l_returnflag <> 'R'"))


def _searches(spark, sf_dir):
    """Search results of SKUs: a product page, a list that mentions the SKU,
    one that does not, or none."""
    return parts(spark, sf_dir).where("p_partkey % 5 <> 0").selectExpr(
        "CAST(p_partkey AS STRING) AS sku",
        "CASE WHEN p_size % 3 = 0 THEN 'https://s.se/' || replace(p_name, ' ', '-') || '-p' || p_partkey"
        " ELSE 'https://s.se/search?q=' || p_partkey END AS final_url",
        """CASE WHEN p_size % 3 = 1 THEN '{"sku_id":"' || p_partkey || '","uri":"\\\\/m\\\\/' || p_partkey || '"}'
           ELSE '{"sku_id":"0","uri":"\\\\/m\\\\/1"}' END AS html""",
    )


_HIT = """CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 'https://s.se/' || replace(p_name, ' ', '-') || '-p' || CAST(p_partkey AS STRING)
          WHEN p_size % 3 = 1 THEN 'https://s.se/m/' || CAST(p_partkey AS STRING) END"""


def _found_missing(spark, sf_dir):
    skus = parts(spark, sf_dir).selectExpr("CAST(p_partkey AS STRING) AS sku")
    return rp.found_missing(skus, _searches(spark, sf_dir), "https://s.se")


@query("rpt3_found_missing", f"SELECT CAST(p_partkey AS STRING) AS sku, {_HIT} AS url FROM part")
def found_missing(spark, sf_dir):
    return _found_missing(spark, sf_dir)


@query(
    "rpt4_url_overlap",
    """SELECT in_sitemap, in_known, in_stored, count(*) AS n_urls FROM (
         SELECT l_partkey, bool_or(l_returnflag = 'R') AS in_sitemap, bool_or(l_returnflag = 'A') AS in_known,
                bool_or(l_linestatus = 'O' AND l_linenumber = 1) AS in_stored FROM lineitem GROUP BY l_partkey)
       WHERE in_sitemap OR in_known OR in_stored GROUP BY ALL""",
)
def url_overlap(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        f"{CARD_URL} AS url", "l_returnflag", "l_linestatus", "l_linenumber"
    )
    return rp.url_overlap(
        {
            "sitemap": rows.where("l_returnflag = 'R'"),
            "known": rows.where("l_returnflag = 'A'"),
            "stored": rows.where("l_linestatus = 'O' AND l_linenumber = 1"),
        }
    )


@query(
    "rpt5_outcomes",
    f"""SELECT event_id, {EVENT_URL} || '?e=' || CAST(event_id AS STRING) AS request_url, CAST({EVENT_STATUS} AS INTEGER) AS status,
        CASE WHEN event_type <> 'error' THEN {EVENT_URL} END AS product_url FROM events""",
)
def outcomes(spark, sf_dir):
    seen = outcomes_view(spark, sf_dir).withColumn(
        "request_url", F.concat("request_url", F.lit("?e="), c("event_id").cast("string"))
    )
    found = seen.where("event_type <> 'error'").select("request_url", "url")
    return rp.outcomes(seen, found).select("event_id", "request_url", "status", "product_url")


@query(
    "rpt6_repeat_views",
    f"SELECT url, count(*) AS n_views FROM (SELECT {EVENT_URL} AS url FROM events) GROUP BY url HAVING count(*) > 1",
)
def repeat_views(spark, sf_dir):
    return rp.repeat_views(outcomes_view(spark, sf_dir))


@query(
    "rpt7_job_totals",
    """SELECT CAST(l_suppkey % 10 AS BIGINT) AS job_id, count(DISTINCT l_orderkey % 100) AS n_categories, count(*) AS n_products_found,
       CAST(sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_new_categories FROM lineitem GROUP BY 1""",
)
def job_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey % 10 AS job_id", "'/c/' || (l_orderkey % 100) AS category_url", "l_linenumber"
    )
    return rp.job_totals(rows, rows.where("l_linenumber = 1"))


@query("rpt8_image_counts", f"SELECT {URL} AS url, CAST(p_size % 5 AS INTEGER) AS n_images FROM part")
def image_counts(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "url", "slice(array('a', 'b', 'c', 'd'), 1, p_size % 5) AS images"
    )
    return rp.image_counts(rows)


# -- messages -----------------------------------------------------------------------------


def _ranked(spark, sf_dir):
    ranked = ls.popularity_rank(cards(spark, sf_dir))
    return ranked.select(c("run").alias("job_id"), "url", "popularity_index")


_PAYLOAD = (
    "struct<productListings: array<struct<url: string, popularity_index: bigint>>,"
    " jobContext: struct<jobId: bigint>, part: bigint, nParts: bigint>"
)


def _read_back(messages, field="productListings", payload=_PAYLOAD):
    """What a subscriber reads: counts, first and last record of a payload."""
    parsed = messages.withColumn("p", F.from_json("payload", payload))
    items = c("p")[field]
    return parsed.select(
        "job_id",
        "part",
        c("p.jobContext.jobId").alias("context_job"),
        c("p.part").alias("own_part"),
        c("p.nParts").alias("n_parts"),
        F.size(items).alias("n_rows"),
        F.get(items, 0)["url"].alias("first_url"),
        F.element_at(items, -1)["url"].alias("last_url"),
        F.element_at(items, -1)["popularity_index"].alias("last_rank"),
    )


def _messages_sql(size):
    return f"""
        SELECT run AS job_id, CAST((popularity_index - 1) // {size} AS BIGINT) AS part, run AS context_job,
               CAST((popularity_index - 1) // {size} AS BIGINT) AS own_part, CAST(ceil(n / {size}) AS BIGINT) AS n_parts, CAST(count(*) AS INTEGER) AS n_rows,
               arg_min(url, popularity_index) AS first_url, arg_max(url, popularity_index) AS last_url,
               CAST(max(popularity_index) AS BIGINT) AS last_rank FROM (SELECT *, count(*) OVER (PARTITION BY run) AS n FROM ({RANKED_SQL})) GROUP BY ALL"""


@query("snk2_to_messages", _messages_sql(100))
def to_messages(spark, sf_dir):
    return _read_back(
        sinks.to_messages(_ranked(spark, sf_dir), "popularity_index", ["url"], 100, ranked=True)
    )


@query("snk3_popularity_message", _messages_sql(10_000))
def popularity_message(spark, sf_dir):
    return _read_back(sinks.popularity_message(_ranked(spark, sf_dir), 10_000, ranked=True))


# A third of the rows has no order value, and one job holds most of them.
_LOOSE = "CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey * 8 + l_linenumber END"
_LOOSE_JOB = "CASE WHEN l_suppkey % 4 = 0 THEN l_suppkey ELSE 1 END"


@query(
    "snk2_rows_without_order",
    f"""SELECT job_id, CAST(part AS BIGINT) AS part, CAST(ceil(max(n) / 500) AS BIGINT) AS n_parts, CAST(count(*) AS INTEGER) AS n_rows,
        count(popularity_index) AS n_known FROM (SELECT *, (place - 1) // 500 AS part FROM (
          SELECT {_LOOSE_JOB} AS job_id, {_LOOSE} AS popularity_index, count(*) OVER (PARTITION BY {_LOOSE_JOB}) AS n,
                 row_number() OVER (PARTITION BY {_LOOSE_JOB} ORDER BY {_LOOSE} NULLS LAST) AS place FROM lineitem)) GROUP BY job_id, part""",
)
def rows_without_order(spark, sf_dir):
    """Payloads of at most 500 rows, also of the rows that have no order value."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        f"{_LOOSE_JOB} AS job_id", f"{_LOOSE} AS popularity_index", "l_orderkey || '-' || l_linenumber || '-' || l_partkey AS url"
    )
    items = F.from_json("payload", "struct<productListings: array<struct<popularity_index: bigint>>>")["productListings"]
    known = F.size(F.filter(items, lambda x: x["popularity_index"].isNotNull())).cast("bigint")
    return sinks.to_messages(rows, "popularity_index", ["url"], 500).select("job_id", "part", "n_parts", "n_rows", known.alias("n_known"))

@query(
    "snk4_update_message",
    f"""SELECT job_id, CAST(0 AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS n_rows, arg_min(url, p_partkey) AS first_url FROM
        (SELECT p_partkey, {URL} AS url, p_size % 5 AS job_id FROM part WHERE p_size % 3 <> 0) GROUP BY job_id""",
)
def update_message(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "p_size % 5 AS job_id", "url", "p_partkey", "CASE p_size % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'match' END AS matching_type"
    )
    out = sinks.update_message(rows, "p_partkey", ["url"], 10_000)
    payload = "struct<productDetails: array<struct<url: string>>>"
    return out.select(
        "job_id", "part", "n_rows",
        F.get(F.from_json("payload", payload)["productDetails"], 0)["url"].alias("first_url"),
    )


_SCHEDULE = """{"job_id":' || CAST(n_nationkey AS STRING) || ',"category_urls":["/c/1","/c/' || CAST(n_regionkey + 2 AS STRING) || '","/c/9"]}"""


@query("snk5_schedule_message", f"SELECT n_nationkey AS job_id, '{_SCHEDULE}' AS payload FROM nation")
def schedule_message(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS job_id",
        "array('/c/1', '/c/' || (n_regionkey + 2)) AS category_urls",
        "array('/seed') AS intermediate_categories",
        "array('/c/1', '/c/9', '/c/9') AS new_categories",
    )
    return sinks.schedule_message(rows)


@query("snk10_publishable", "SELECT p_partkey FROM part WHERE p_size % 3 <> 0")
def publishable(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr("p_partkey", "CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS skip_publishing")
    return sinks.publishable(rows).select("p_partkey")


# -- file round trips -----------------------------------------------------------------------


@query("src1_read_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def read_pages(spark, sf_dir):
    rows = sources.read_pages(
        spark, f"{sf_dir}/pages.parquet", schema="page_id BIGINT, url STRING, html STRING"
    )
    return rows.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query(
    "src2_read_request_batches",
    f"""SELECT {URL} AS url, p_name AS name, CAST(p_partkey AS BIGINT) AS popularity_index,
        'job_' || CAST(p_partkey // 100 AS STRING) AS job_id, p_partkey // 100 % 2 = 0 AS skip_publishing FROM part""",
)
def read_request_batches(spark, sf_dir):
    path = scratch_dir(spark, "batches")
    parts(spark, sf_dir).selectExpr(
        "p_partkey div 100 AS batch",
        "named_struct('url', url, 'userData', named_struct('name', p_name, 'popularityIndex', p_partkey)) AS r",
    ).groupBy("batch").agg(F.collect_list("r").alias("productDetails")).select(
        "productDetails",
        F.expr("named_struct('jobId', 'job_' || batch, 'env', 'test', 'skipPublishing', batch % 2 = 0)").alias("jobContext"),
    ).write.json(path)
    rows = sources.read_request_batches(spark, path)
    return rows.select(
        "url",
        "user_data.name",
        c("user_data.popularityIndex").alias("popularity_index"),
        c("job_context.jobId").alias("job_id"),
        c("job_context.skipPublishing").alias("skip_publishing"),
    )


@query(
    "src3_read_requests",
    f"""SELECT {URL} AS target, 'LIST' AS label, 'job_1' AS job_id FROM part
        UNION ALL SELECT p_name, 'SEARCH', 'job_1' FROM part
        UNION ALL SELECT '/seed/' || CAST(p_partkey AS STRING) || '/' || CAST(i AS STRING), 'INTERMEDIATE_CATEGORY', 'job_1'
        FROM part, (SELECT unnest([1, 2]) AS i)""",
)
def read_requests(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("jobContext", F.expr("named_struct('jobId', 'job_1', 'env', 'test')"))
    bodies = {
        "category": rows.selectExpr("url", "domain AS retailerDomain", "tld AS country", "jobContext"),
        "search": rows.selectExpr("p_name AS query", "domain AS retailer", "jobContext"),
        "leaf_category": rows.selectExpr(
            "array('/seed/' || p_partkey || '/1', '/seed/' || p_partkey || '/2') AS intermediate_categories",
            "array('/c') AS known_category_urls",
            "jobContext",
        ),
    }
    out = None
    for kind, body in bodies.items():
        path = scratch_dir(spark, kind)
        body.write.json(path)
        target = "query" if kind == "search" else "url"
        part = sources.read_requests(spark, path, kind).select(
            c(target).alias("target"), "label", c("jobContext.jobId").alias("job_id")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "src4_read_schedules",
    """SELECT s_suppkey AS schedule, '/c/' || CAST(s_suppkey AS STRING) AS known, 2 AS n_seeds, s_name AS owner FROM supplier""",
)
def read_schedules(spark, sf_dir):
    path = scratch_dir(spark, "schedules")
    table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS owner", "array('/c/' || s_suppkey) AS category_urls", "array('/a', '/b') AS intermediate_categories"
    ).write.json(path)
    rows = sources.read_schedules(spark, path)
    return rows.select(
        F.try_variant_get("rest", "$.id", "bigint").alias("schedule"),
        F.get("category_urls", 0).alias("known"),
        F.size("intermediate_categories").alias("n_seeds"),
        F.try_variant_get("rest", "$.owner", "string").alias("owner"),
    )


@query("src5_import_catalog", "SELECT CAST(p_partkey AS INTEGER) AS article, p_name AS name, p_retailprice AS price FROM part")
def import_catalog(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    parts(spark, sf_dir).selectExpr("p_partkey AS article", "p_name AS name", "p_retailprice AS price").write.option(
        "header", True
    ).csv(path)
    return sources.import_catalog(spark, path)


def _dump_rows(spark, sf_dir):
    return parts(spark, sf_dir).selectExpr(
        "url", "p_name AS name", "CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price", "currency",
        "p_size % 2 = 0 AS isDiscounted", "array('/i.jpg') AS images",
        "array(named_struct('key', 'Size', 'value', '' || p_size)) AS specifications",
        "'job_' || (p_size % 5) AS jobId", "p_partkey",
    )


_DUMP_SQL = f"""
    SELECT {URL} AS url, p_name AS name, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price, {CURRENCY} AS currency,
           CAST(p_size AS STRING) AS size FROM part"""


def _dump_fields(rows):
    return rows.select("url", "name", "price", "currency", F.get("specifications", 0)["value"].alias("size"))


@query("src6_read_offer_dump", _DUMP_SQL)
def read_offer_dump(spark, sf_dir):
    """One JSON array per file, as a dump holds it."""
    path = scratch_dir(spark, "dump")
    _dump_rows(spark, sf_dir).groupBy((c("p_partkey") % 8).alias("file"), (F.floor(c("p_partkey") / 1000)).alias("block")).agg(
        F.to_json(F.collect_list(F.struct("url", "name", "price", "currency", "specifications"))).alias("value")
    ).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _dump_fields(sources.read_offer_dump(spark, path))


@query("snk6_write_offer_dump", _DUMP_SQL)
def write_offer_dump(spark, sf_dir):
    path = scratch_dir(spark, "dump")
    sinks.write_offer_dump(_dump_rows(spark, sf_dir), path)
    return _dump_fields(sources.read_offer_dump(spark, path, lines=True))


@query(
    "src7_read_category_dim",
    "SELECT 'https://b.se/c/' || CAST(n_nationkey AS STRING) AS url, r_name || '|' || n_name AS names FROM nation JOIN region ON r_regionkey = n_regionkey",
)
def read_category_dim(spark, sf_dir):
    path = scratch_dir(spark, "dim")
    category_dim(spark, sf_dir).write.json(path)
    return sources.read_category_dim(spark, path).select("url", F.array_join("category_tree.name", "|").alias("names"))


@query(
    "snk1_write_offers",
    f"""SELECT {URL} AS url, p_name AS name, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price,
        p_size % 2 = 0 AS is_discounted, '{{"key":"Size","value":"' || CAST(p_size AS STRING) || '"}}' AS specification, 'job_1' AS job_id FROM part""",
)
def write_offers(spark, sf_dir):
    path = scratch_dir(spark, "offers")
    sinks.write_offers(_dump_rows(spark, sf_dir).drop("jobId"), path, "job_1")
    stored = spark.read.parquet(path)
    return stored.select(
        "url", "name", "price", "is_discounted", F.get("specifications", 0).alias("specification"), "job_id"
    )


@query(
    "snk7_load_dump",
    "SELECT 'job_' || CAST(p_size % 5 AS STRING) AS job_id, count(*) AS n_rows, true AS files_are_small FROM part GROUP BY 1",
)
def load_dump(spark, sf_dir):
    path = scratch_dir(spark, "loaded")
    sinks.load_dump(_dump_rows(spark, sf_dir), path, 500)
    per_file = spark.read.parquet(path).groupBy("job_id", F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.groupBy("job_id").agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= 500).alias("files_are_small")
    )


@query(
    "snk8_write_found_missing",
    f"""SELECT sku, url, url IS NOT NULL AS found FROM (SELECT CAST(p_partkey AS STRING) AS sku, {_HIT} AS url FROM part)""",
)
def write_found_missing(spark, sf_dir):
    path = scratch_dir(spark, "skus")
    sinks.write_found_missing(_found_missing(spark, sf_dir), path)
    found = spark.read.schema("sku STRING, url STRING").csv(f"{path}/found").withColumn("found", F.lit(True))
    missing = spark.read.schema("sku STRING").csv(f"{path}/not_found").selectExpr(
        "sku", "CAST(NULL AS STRING) AS url", "false AS found"
    )
    return found.unionByName(missing)

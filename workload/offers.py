"""Offers, variants, outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from offerloom import schemas
from offerloom.functions import screenshot_key
from offerloom.operators import offers as of, outcomes as oc, variants as va
from offerloom.operators.cascade import auto_extract
from offerloom.operators.elements import page_dom  # noqa: F401
from workload.registry import query
from workload.views import (
    AVAILABILITY_SNAKE,
    BAD_GTIN,
    BROKEN,
    CENTS,
    CURRENCY,
    DOMAIN,
    EVENT_STATUS,
    EVENT_URL,
    GTIN,
    HAS_OFFER,
    NO_PRICE,
    URL,
    outcomes_view,
    parts,
    product_pages,
    table,
)


def c(name):
    return F.col(name)


# -- the flagship: pages to clean offers -----------------------------------------------

_GOOD_GTIN = f"CASE WHEN NOT ({BAD_GTIN}) THEN {GTIN} END"
_MINOR = "CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT)"


@query(
    "flagship_offers",
    f"""SELECT p_partkey AS page_id, {URL} AS url, p_name AS name, {_MINOR} AS price, {CURRENCY} AS currency,
        {_GOOD_GTIN} AS gtin, 'M' || CAST(p_size AS STRING) || '-' || CAST(p_partkey AS STRING) AS mpn,
        {AVAILABILITY_SNAKE} AS availability, {DOMAIN} AS retailer_domain FROM part WHERE {HAS_OFFER}""",
)
def flagship(spark, sf_dir):
    found = of.stamp_offer(auto_extract(product_pages(spark, sf_dir)), F.lit(None).cast("timestamp"))
    cleaned = of.clean_offer(found).where(c("reject_reason").isNull())
    return cleaned.select(
        "page_id", "url", "name", "price", "currency", "gtin", "mpn", "availability", "retailer_domain"
    )


# -- merge -------------------------------------------------------------------------------


def _page_rows(spark, sf_dir):
    return parts(spark, sf_dir).selectExpr(
        "url",
        "p_partkey",
        "CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS name",
        "CASE WHEN p_size % 4 = 0 THEN 0D ELSE p_retailprice END AS price",
        "p_size % 2 = 0 AS is_discounted",
        "array() AS images",
    )


def _listing_rows(spark, sf_dir):
    return parts(spark, sf_dir).where("p_partkey % 2 = 0").selectExpr(
        "url",
        "'L ' || p_name AS name",
        "1D AS price",
        "true AS is_discounted",
        "array('a.jpg') AS images",
        "p_brand AS brand",
    )


@query(
    "dtl1_merge_offer",
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_name WHEN p_partkey % 2 = 0 THEN 'L ' || p_name ELSE '' END AS name,
       CASE WHEN p_size % 4 <> 0 THEN p_retailprice WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS price,
       p_size % 2 = 0 OR p_partkey % 2 = 0 AS is_discounted, 0 AS n_images,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part""",
)
def merge_offer(spark, sf_dir):
    merged = of.merge_offer(_page_rows(spark, sf_dir), _listing_rows(spark, sf_dir), "url")
    return merged.select(
        "p_partkey", "name", "price", "is_discounted", F.size("images").alias("n_images"), "brand"
    )


@query(
    "dtl2_merge_override",
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_name ELSE '' END AS name,
       CASE WHEN p_size % 4 <> 0 THEN p_retailprice ELSE 0 END AS price,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part""",
)
def merge_override(spark, sf_dir):
    merged = of.merge_override(_listing_rows(spark, sf_dir), _page_rows(spark, sf_dir), "url")
    return merged.select("p_partkey", "name", "price", "brand")


# -- checks and clean-up ---------------------------------------------------------------------


def _raw(spark, sf_dir):
    """Offers with the faults the checks look for."""
    return parts(spark, sf_dir).selectExpr(
        "p_partkey",
        "url",
        "CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS name",
        "CASE WHEN p_partkey % 6 = 0 THEN 'kr' WHEN p_partkey % 6 = 1 THEN 'unknown' ELSE lower(currency) END AS currency",
        "p_retailprice AS price",
        "CASE WHEN p_size % 2 = 0 THEN p_retailprice * 1.5 END AS original_price",
        "CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS brand",
        "'/brand/' || p_size AS brand_url",
        "'' AS description",
        "CASE WHEN p_size % 3 = 0 THEN '12A' WHEN p_size % 3 = 1 THEN '1234567' ELSE gtin END AS gtin",
        "array('/i/' || p_partkey || '.jpg', '', NULL, 'https://i.se/b.jpg') AS images",
        "'/c/' || p_type AS category_url",
        "array(named_struct('name', p_type, 'url', '/t'), named_struct('name', 'x', 'url', 'https://y.se/z')) AS category_tree",
    )


_NO_NAME = "(p_size % 5 = 0 OR p_size % 7 = 0)"
_BAD_CURRENCY = "p_partkey % 6 = 0"


@query(
    "dtl3_validate_offer",
    f"""SELECT p_partkey, CASE WHEN {_NO_NAME} THEN 'No product name found in the final result'
        WHEN {_BAD_CURRENCY} THEN 'Unknown currency ''KR''' END AS reject_reason,
        NOT ({_NO_NAME} OR {_BAD_CURRENCY}) AS is_good FROM part""",
)
def validate_offer(spark, sf_dir):
    good, bad = of.validate_offer(_raw(spark, sf_dir))
    kept = good.select("p_partkey", F.lit(None).cast("string").alias("reject_reason"), F.lit(True).alias("is_good"))
    return kept.union(bad.select("p_partkey", "reject_reason", F.lit(False).alias("is_good")))


@query(
    "dtl4_blank_to_null",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 1 THEN p_brand END AS brand, NULL::STRING AS description,
       '/brand/' || CAST(p_size AS STRING) AS brand_url FROM part""",
)
def blank_to_null(spark, sf_dir):
    return of.blank_fields_to_null(_raw(spark, sf_dir)).select("p_partkey", "brand", "description", "brand_url")


@query(
    "dtl5_clean_images",
    f"""SELECT p_partkey, 'https://www.' || {DOMAIN} || '/i/' || CAST(p_partkey AS STRING) || '.jpg|https://i.se/b.jpg' AS images,
        0 AS n_of_null FROM part""",
)
def clean_images(spark, sf_dir):
    none = F.lit(None).cast("array<string>")
    return _raw(spark, sf_dir).select(
        "p_partkey",
        F.array_join(of.clean_images(c("images"), c("url")), "|").alias("images"),
        F.size(of.clean_images(none, c("url"))).alias("n_of_null"),
    )


@query(
    "dtl6_absolutise",
    f"""SELECT p_partkey, 'https://www.' || {DOMAIN} || '/brand/' || CAST(p_size AS STRING) AS brand_url,
        'https://www.' || {DOMAIN} || '/c/' || p_type AS category_url,
        'https://www.' || {DOMAIN} || '/t|https://y.se/z' AS tree FROM part""",
)
def absolutise(spark, sf_dir):
    return of.absolutise(_raw(spark, sf_dir)).select(
        "p_partkey", "brand_url", "category_url", F.array_join("category_tree.url", "|").alias("tree")
    )


@query("dtl7_clean_gtin", f"SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN {GTIN} END AS gtin FROM part")
def clean_gtin(spark, sf_dir):
    from offerloom.functions import clean_gtin as gtin

    return _raw(spark, sf_dir).select("p_partkey", gtin(c("gtin")).alias("gtin"))


@query(
    "dtl8_to_minor_units",
    f"""SELECT p_partkey, {_MINOR} AS price,
        CASE WHEN p_size % 2 = 0 THEN CAST(floor(p_retailprice * 1.5::DOUBLE * 100 + 0.5) AS BIGINT) END AS original_price,
        CASE p_partkey % 6 WHEN 0 THEN 'KR' WHEN 1 THEN 'UNKNOWN' ELSE {CURRENCY} END AS currency FROM part""",
)
def to_minor_units(spark, sf_dir):
    return of.prices_to_minor_units(
        _raw(spark, sf_dir).withColumn("original_price", F.expr("CASE WHEN p_partkey >= 0 THEN original_price END"))
    ).select("p_partkey", "price", "original_price", "currency")


@query(
    "dtl9_canonical_url",
    """SELECT p_partkey, CASE WHEN p_size % 6 = 5 THEN 'https://www.baldai1.lt/p' || p_partkey WHEN p_size % 3 = 2 THEN 'https://x.se/p' ELSE
       CASE WHEN p_size % 3 = 0 THEN 'https://www.amazon.de/-/en/dp/B' || CAST(p_partkey AS STRING) END END AS url,
       p_size % 3 = 1 AS rejected FROM part""",
)
def canonical_url(spark, sf_dir):
    from offerloom.functions import domain_of
    from offerloom.operators.profiles import default_registry

    raw = F.expr(
        "CASE p_size % 3 WHEN 0 THEN 'https://www.amazon.de/a-b/dp/B' || p_partkey || '/ref=x?k=1'"
        " WHEN 1 THEN 'https://www.amazon.de/s?k=1' ELSE"
        " CASE WHEN p_size % 6 = 5 THEN 'https://www.baldai1.lt/p' || p_partkey || '/?redirect=301' ELSE 'https://x.se/p' END END"
    )
    url = default_registry().apply_canonical(c("raw"), domain_of(c("raw")))
    return parts(spark, sf_dir).select("p_partkey", raw.alias("raw")).select(
        "p_partkey", url.alias("url"), url.isNull().alias("rejected")
    )


@query(
    "dtl10_variant_group_url",
    """SELECT p_partkey, 'https://s.se/x/p-' || CAST(p_partkey AS STRING) AS group_url FROM part""",
)
def variant_group_url(spark, sf_dir):
    url = F.expr(
        "'https://s.se/x/p-' || p_partkey || CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN '-' || p_size ELSE '-' || p_size || '/' END"
    )
    return parts(spark, sf_dir).select("p_partkey", of.variant_group_url(url).alias("group_url"))


@query(
    "dtl11_stamp_offer",
    """SELECT event_id, epoch_us(ts) AS fetched_us, 'shop' || CAST(user_id % 9 AS STRING) || '.se' AS retailer_domain FROM events""",
)
def stamp_offer(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "ts", f"{EVENT_URL} AS url")
    return of.stamp_offer(rows, c("ts").cast("timestamp")).select(
        "event_id", F.unix_micros("fetched_at").alias("fetched_us"), "retailer_domain"
    )


@query("dtl12_stamp_job", "SELECT p_partkey, 'job_1' AS job_id, 'job_' || CAST(p_size AS STRING) AS own_job FROM part")
def stamp_job(spark, sf_dir):
    rows = of.stamp_job(parts(spark, sf_dir), F.expr("'job_' || p_size")).withColumnRenamed("job_id", "own_job")
    return of.stamp_job(rows, "job_1").select("p_partkey", "job_id", "own_job")


@query(
    "dtl13_to_warehouse_row",
    """SELECT p_partkey, p_retailprice AS price, p_size % 2 = 0 AS is_discounted,
       '{"key":"Size","value":"' || CAST(p_size AS STRING) || '"}' AS specifications,
       CASE WHEN p_size % 2 = 0 THEN '{"review_count":' || CAST(p_size AS STRING) || '}' END AS product_reviews,
       'a|' || p_brand AS images FROM part""",
)
def to_warehouse_row(spark, sf_dir):
    rows = parts(spark, sf_dir).selectExpr(
        "p_partkey",
        "p_retailprice AS price",
        "p_size % 2 = 0 AS isDiscounted",
        "array(named_struct('key', 'Size', 'value', '' || p_size, 'note', NULL)) AS specifications",
        "CASE WHEN p_size % 2 = 0 THEN named_struct('review_count', p_size) END AS productReviews",
        "array('a', p_brand) AS images",
    )
    out = of.to_warehouse_row(rows)
    return out.withColumn("specifications", F.array_join("specifications", "|")).withColumn(
        "images", F.array_join("images", "|")
    )


@query(
    "dtl14_project_to",
    "SELECT p_name AS name, p_retailprice AS price, NULL::STRING AS gtin2 FROM part",
)
def project_to(spark, sf_dir):
    target = T.StructType.fromDDL("name STRING, price DOUBLE, gtin2 STRING")
    rows = parts(spark, sf_dir).select(c("p_name").alias("name"), c("p_retailprice").alias("price"), "p_brand")
    return of.project_to(rows, target)


@query("dtl15_existing", "SELECT p_partkey FROM part WHERE p_size % 3 <> 0")
def existing(spark, sf_dir):
    kind = F.expr("CASE p_size % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'match' END")
    return of.existing(parts(spark, sf_dir).withColumn("matching_type", kind)).select("p_partkey")


@query(
    "snk9_screenshot_key",
    "SELECT page_id, 'screenshots/' || md5(url) || '.jpg' AS object_key FROM pages",
)
def snk9(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", screenshot_key(c("url")).alias("object_key"))


# -- variants -------------------------------------------------------------------------------------


def _options(spark, sf_dir):
    """Option counts of a product: colours, then sizes (sometimes none)."""
    return parts(spark, sf_dir).selectExpr(
        "p_partkey",
        "url",
        "CASE WHEN p_partkey % 5 = 0 THEN array() ELSE array(CAST(1 + p_partkey % 3 AS INT), CAST(p_size % 4 AS INT), 2) END AS option_counts",
        # in every fourth product the first colour has no second size
        "CASE WHEN p_partkey % 4 = 0 THEN array(array(0, 1)) END AS bad",
    )


_GRID = """
    SELECT p_partkey, a, b, d FROM part, (SELECT unnest(range(3)) AS a), (SELECT unnest(range(-1, 3)) AS b),
           (SELECT unnest(range(-1, 2)) AS d)
    WHERE p_partkey % 5 <> 0 AND a < 1 + p_partkey % 3
      AND (CASE WHEN p_size % 4 = 0 THEN b = -1 AND d = -1 ELSE b >= 0 AND b < p_size % 4 AND d >= 0 END)"""
_OPTIONS = "CAST(a AS STRING) || CASE WHEN b >= 0 THEN ',' || CAST(b AS STRING) || ',' || CAST(d AS STRING) ELSE '' END"
_NUMBER = "CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY a, b, d) - 1 AS INTEGER)"


def _grid(rows):
    return rows.select("p_partkey", "variant", F.array_join(F.transform("options", lambda o: o.cast("string")), ",").alias("options"))


@query(
    "var1_variant_grid",
    f"""SELECT p_partkey, {_NUMBER} AS variant, {_OPTIONS} AS options FROM ({_GRID})
        UNION ALL SELECT p_partkey, 0, '' FROM part WHERE p_partkey % 5 = 0""",
)
def variant_grid(spark, sf_dir):
    return _grid(va.variant_grid(_options(spark, sf_dir)))


@query(
    "var2_drop_invalid",
    f"""SELECT p_partkey, {_OPTIONS} AS options FROM ({_GRID}) WHERE NOT (p_partkey % 4 = 0 AND a = 0 AND b = 1)
        UNION ALL SELECT p_partkey, '' FROM part WHERE p_partkey % 5 = 0""",
)
def drop_invalid(spark, sf_dir):
    rows = _options(spark, sf_dir)
    bad = rows.where("bad IS NOT NULL").select("p_partkey", F.explode("bad").alias("prefix"))
    return _grid(va.drop_invalid(va.variant_grid(rows), bad, "p_partkey")).drop("variant")


@query(
    "var3_number_variants",
    f"""SELECT * FROM (SELECT p_partkey, {_NUMBER} AS variant, {_OPTIONS} AS options FROM ({_GRID})
        WHERE NOT (p_partkey % 4 = 0 AND a = 0 AND b = 1)) WHERE variant < 4
        UNION ALL SELECT p_partkey, 0, '' FROM part WHERE p_partkey % 5 = 0""",
)
def number_variants(spark, sf_dir):
    return _grid(va.variant_grid(_options(spark, sf_dir), invalid="bad", limit=4))


@query(
    "var4_stamp_group",
    f"""SELECT event_id, user_id, first(url) OVER (PARTITION BY user_id ORDER BY event_id) AS variant_group_url FROM
        (SELECT event_id, user_id, {EVENT_URL} || '?v=' || CAST(event_id AS STRING) AS url FROM events)""",
)
def stamp_group(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", f"{EVENT_URL} || '?v=' || event_id AS url"
    )
    return va.stamp_group(rows, "user_id", "event_id").select("event_id", "user_id", "variant_group_url")


@query(
    "var5_variant_urls",
    f"""SELECT p_partkey AS page_id, CAST(i AS INTEGER) AS variant,
        CASE i WHEN 0 THEN {URL} || '-blue' ELSE {URL} END AS variant_url
        FROM part, (SELECT unnest([0, 1]) AS i) WHERE p_partkey % 3 = 1 AND NOT ({BROKEN})""",
)
def variant_urls(spark, sf_dir):
    return va.variant_urls(product_pages(spark, sf_dir), va.jsonld_variant_urls(c("html"))).select(
        "page_id", "variant", "variant_url"
    )


@query(
    "var6_variant_url",
    f"""SELECT p_partkey, 'https://www.' || {DOMAIN} || '/S1' AS segment, {URL} || '?sku=S1' AS by_query,
        {URL} || '?a=1#S1' AS fragment, {URL} || '?a=1#sku=S1' AS fragment_sku FROM part""",
)
def variant_url(spark, sf_dir):
    url, sku = F.concat("url", F.lit("?a=1#x")), F.lit("S1")
    return parts(spark, sf_dir).select(
        "p_partkey",
        va.variant_url(c("url"), sku, "segment").alias("segment"),
        va.variant_url(url, sku, "query").alias("by_query"),
        va.variant_url(url, sku, "fragment").alias("fragment"),
        va.variant_url(url, sku, "fragment_sku").alias("fragment_sku"),
    )


@query("var7_base_url", "SELECT page_id, split_part(url, '#', 1) AS base FROM pages")
def base_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", va.base_url(c("url")).alias("base"))


# -- outcomes -----------------------------------------------------------------------------------------


def _visits(spark, sf_dir):
    """Captured pages of shops with rules of their own."""
    return outcomes_view(spark, sf_dir).selectExpr(
        "event_id",
        "CASE event_id % 6 WHEN 0 THEN 'https://www.wayfair.de/x/pdp/' || user_id"
        " WHEN 1 THEN 'https://www.wayfair.de/blocked.php?u=' || user_id"
        " WHEN 2 THEN 'https://www.wayfair.de/' WHEN 3 THEN 'https://www.trademax.se/stol-p' || user_id"
        " WHEN 4 THEN 'https://www.trademax.se/stolar' ELSE 'https://ebuy24.dk/shop/' || user_id END AS url",
        "status",
        "CASE WHEN user_id % 2 = 0 THEN '<article class=\"a m-notfound-article\">' ELSE '<p>' END AS html",
    )


_ERROR = f"""
    CASE WHEN status = 404 THEN 'PageNotFoundError'
         WHEN event_id % 6 = 1 THEN 'GotBlockedError'
         WHEN event_id % 6 < 3 AND status = 429 THEN 'CaptchaEncounteredError'
         WHEN event_id % 6 = 2 OR event_id % 6 = 4 THEN 'PageNotFoundError'
         WHEN event_id % 6 = 5 AND user_id % 2 = 0 THEN 'PageNotFoundError' END"""
_VISITS = f"SELECT event_id, user_id, event_type, {EVENT_STATUS} AS status FROM events"


@query("err1_classify_pages", f"SELECT event_id, {_ERROR} AS error FROM ({_VISITS})")
def classify_pages(spark, sf_dir):
    return oc.classify_pages(_visits(spark, sf_dir)).select("event_id", "error")


@query(
    "err2_is_retryable",
    f"""SELECT event_id, error NOT IN ('PageNotFoundError', 'IllFormattedPageError') AS retryable
        FROM (SELECT event_id, {_ERROR} AS error FROM ({_VISITS}))""",
)
def is_retryable(spark, sf_dir):
    return oc.classify_pages(_visits(spark, sf_dir)).select(
        "event_id", oc.is_retryable(c("error")).alias("retryable")
    )


@query(
    "err3_apply_rules",
    f"""SELECT event_id, CASE WHEN status >= 500 THEN 'retry' WHEN status >= 400 THEN 'drop' ELSE 'pass' END AS action
        FROM ({_VISITS})""",
)
def apply_rules(spark, sf_dir):
    rules = [(lambda: c("status") >= 500, "retry"), (lambda: c("status") >= 400, "drop")]
    return oc.apply_rules(_visits(spark, sf_dir), rules, "action", F.lit("pass")).select("event_id", "action")


@query(
    "err4_not_found_marker",
    f"SELECT event_id, user_id % 2 = 0 AS not_found FROM ({_VISITS}) WHERE event_id % 6 = 5 AND status <> 404",
)
def not_found_marker(spark, sf_dir):
    rows = oc.classify_pages(_visits(spark, sf_dir)).where("event_id % 6 = 5 AND status <> 404")
    return rows.select("event_id", F.coalesce(c("error") == "PageNotFoundError", F.lit(False)).alias("not_found"))


@query(
    "err5_is_empty_listing",
    f"SELECT p_partkey, p_size % 3 <> 2 AND p_partkey % 2 = 0 AS is_empty FROM part",
)
def is_empty_listing(spark, sf_dir):
    domain = F.expr("CASE p_size % 3 WHEN 0 THEN 'amazon.de' WHEN 1 THEN 'royaldesign.se' ELSE 'x.se' END")
    html = F.expr(
        "CASE WHEN p_partkey % 2 = 0 THEN '<p>No results</p><div class=\"c\">0 produkter</div>' ELSE '<p>10 produkter</p>' END"
    )
    return parts(spark, sf_dir).select("p_partkey", oc.is_empty_listing(domain, html).alias("is_empty"))


@query(
    "err6_still_exists",
    f"""SELECT event_id, CASE WHEN status <> 404 THEN url END AS by_status,
        CASE WHEN status < 300 AND event_id % 2 = 0 THEN url END AS by_pattern, status < 300 AS checked FROM (
          SELECT event_id, status, 'https://www.bygghemma.se/' || CASE WHEN event_id % 2 = 0 THEN 'p-' ELSE 'kategori-' END
                 || CAST(user_id AS STRING) AS url FROM ({_VISITS}))""",
)
def still_exists(spark, sf_dir):
    rows = outcomes_view(spark, sf_dir).selectExpr(
        "event_id",
        "status",
        "'https://www.bygghemma.se/' || CASE WHEN event_id % 2 = 0 THEN 'p-' ELSE 'kategori-' END || user_id AS final_url",
    )
    by_status = oc.still_exists(rows).withColumnRenamed("found_url", "by_status").drop("checked")
    return oc.still_exists(by_status, "pattern").select(
        "event_id", "by_status", c("found_url").alias("by_pattern"), "checked"
    )

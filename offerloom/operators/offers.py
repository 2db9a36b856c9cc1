"""Merging, validating and shaping offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from offerloom.functions.availability import snake_name
from offerloom.functions.identifiers import clean_gtin
from offerloom.functions.missing import blank_to_null, falsy_to_null
from offerloom.functions.prices import to_minor_units as minor_units
from offerloom.functions.text import simple
from offerloom.functions.urls import absolute_if_rooted, domain_of


def merge_offer(pages: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Page fields over request or listing fields of the same key. A page
    value wins unless it is missing (also "", 0 or false) and the listing
    value is not. Rows follow the pages; ``listing`` holds one row per key."""
    left, right = pages.alias("p"), listing.alias("l")
    columns = [F.col(f"p.{key}").alias(key)]
    for f in pages.schema.fields:
        if f.name == key:
            continue
        p = F.col(f"p.{f.name}")
        if f.name in listing.columns:
            l = F.col(f"l.{f.name}")
            l_type = listing.schema[f.name].dataType
            p = F.coalesce(falsy_to_null(p, f.dataType), falsy_to_null(l, l_type), p)
        columns.append(p.alias(f.name))
    extra = [c for c in listing.columns if c not in pages.columns]
    columns += [F.col(f"l.{c}") for c in extra]
    return left.join(right, key, "left").select(*columns)


def merge_override(listing: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Page columns always win, even when NULL; listing columns fill in only
    where the page has no such column."""
    extra = [c for c in listing.columns if c == key or c not in pages.columns]
    return pages.join(listing.select(*extra), key, "left")


def with_reject_reason(offers: DataFrame) -> DataFrame:
    """``reject_reason`` of rows that must not be stored: no name, a currency
    that is neither three letters nor UNKNOWN, or a URL the domain rule cannot
    read. An earlier reason is kept."""
    reason = F.when(
        blank_to_null(F.col("name")).isNull(),
        F.lit("No product name found in the final result"),
    )
    if "currency" in offers.columns:
        bad = (F.length("currency") != 3) & (F.upper("currency") != "UNKNOWN") & (
            F.col("currency") != ""
        )
        reason = F.coalesce(
            reason, F.when(bad, F.concat(F.lit("Unknown currency '"), F.upper("currency"), F.lit("'")))
        )
    if "url" in offers.columns:
        reason = F.coalesce(
            reason, F.when(F.col("url").isNull(), F.lit("Cannot derive the product URL"))
        )
    if "reject_reason" in offers.columns:
        reason = F.coalesce(F.col("reject_reason"), reason)
    return offers.withColumn("reject_reason", reason)


def validate_offer(offers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: together they are the input; bad rows carry the reason."""
    judged = with_reject_reason(offers)
    good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, judged.where(F.col("reject_reason").isNotNull())


def _with(offers: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return offers.withColumns({k: v for k, v in changes.items() if k in offers.columns})


def blank_fields_to_null(offers: DataFrame) -> DataFrame:
    names = ("description", "brand", "brand_url")
    return _with(offers, {n: blank_to_null(F.col(n)) for n in names})


def clean_images(images: Column, page_url: Column) -> Column:
    """Empty entries dropped, root-relative ones made absolute; NULL -> []."""
    kept = F.filter(images, lambda u: u.isNotNull() & (u != ""))
    return F.coalesce(
        F.transform(kept, lambda u: absolute_if_rooted(u, page_url)),
        F.array().cast("array<string>"),
    )


def absolutise(offers: DataFrame) -> DataFrame:
    """Root-relative brand, category and path URLs made absolute."""
    page = F.col("url")
    return _with(
        offers,
        {
            "brand_url": absolute_if_rooted(F.col("brand_url"), page),
            "category_url": absolute_if_rooted(F.col("category_url"), page),
            "category_tree": F.transform(
                "category_tree",
                lambda c: F.struct(
                    c["name"].alias("name"), absolute_if_rooted(c["url"], page).alias("url")
                ),
            ),
        },
    )


def prices_to_minor_units(offers: DataFrame) -> DataFrame:
    """Currency in capitals, prices in minor units."""
    return _with(
        offers,
        {
            "currency": F.upper("currency"),
            "price": minor_units(F.col("price")),
            "original_price": minor_units(F.col("original_price")),
        },
    )


def clean_offer(offers: DataFrame, registry=None) -> DataFrame:
    """All clean-up steps in order; rows that fail carry ``reject_reason``."""
    out = blank_fields_to_null(offers)
    if "images" in out.columns:
        out = out.withColumn("images", clean_images(F.col("images"), F.col("url")))
    out = absolutise(out)
    if "gtin" in out.columns:
        out = out.withColumn("gtin", clean_gtin(F.col("gtin")))
    if registry is not None:
        out = out.withColumn(
            "url", registry.apply_canonical(F.col("url"), domain_of(F.col("url")))
        )
    out = prices_to_minor_units(with_reject_reason(out))
    return out if registry is None else registry.apply_finishers(out)


def variant_group_url(url: Column) -> Column:
    """``.../p-<product>-<variant>[/]`` -> ``.../p-<product>``."""
    cut = F.regexp_replace(F.regexp_replace(url, r"-\d+\z", ""), r"-\d+/\z", "")
    return F.when(url.rlike(r"p-\d+-\d+"), cut).otherwise(url)


def stamp_offer(offers: DataFrame, captured: Column | None = None) -> DataFrame:
    """Capture time of the page and retailer domain of its URL."""
    return offers.withColumns(
        {
            "fetched_at": F.current_timestamp() if captured is None else captured,
            "retailer_domain": domain_of(F.col("url")),
        }
    )


def stamp_job(offers: DataFrame, job_id: str | Column) -> DataFrame:
    return offers.withColumn("job_id", F.lit(job_id) if isinstance(job_id, str) else job_id)


def to_warehouse_row(offers: DataFrame) -> DataFrame:
    """snake_case names; scalars stay, structs become JSON, lists keep scalar
    items or hold JSON items."""
    return offers.select(
        *[
            simple(F.col(f"`{f.name}`"), f.dataType).alias(snake_name(f.name))
            for f in offers.schema.fields
        ]
    )


def project_to(offers: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Columns of the target table only; absent ones are NULL."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return offers.select(
        *[
            (F.col(f.name) if f.name in offers.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def existing(offers: DataFrame) -> DataFrame:
    """Offers of known products; a missing matching type counts as known."""
    return offers.where(~F.col("matching_type").eqNullSafe("new"))

"""Field rules: category paths, specifications, images, reviews, prices,
availability, names and descriptions. All are column functions over values
found in one page, so they never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.missing import blank_to_null
from offerloom.functions.identifiers import sku_of
from offerloom.functions.prices import first_number, parse_price_as, parse_price_safe
from offerloom.functions.text import leading_number, squash, trim_text
from offerloom.functions.urls import clean_image, let, strip_query
from offerloom.operators.elements import attr, has_class, text_of
from offerloom.operators.selectors import PATH, place, select

SPECS = "array<struct<key: string, value: string>>"
CRUMBS = "array<struct<name: string, url: string>>"
REVIEWS = (
    "struct<review_count: bigint, average_review: double,"
    " recent_reviews: array<struct<score: double, content: string>>>"
)


# -- rule-driven fields -------------------------------------------------------

RULE_TYPE = (
    f"struct<field: string, rank: int, path: {PATH}, take: string, cleanup: string, required: boolean>"
)
RECORD_TYPE = f"struct<record: string, path: {PATH}, skip: int, rules: array<{RULE_TYPE}>>"
CLEANUPS = {
    "trim": trim_text,
    "squash": squash,
    "cut_query": strip_query,
    "after_colon": lambda c: trim_text(F.try_element_at(F.split(c, ":"), F.lit(2))),
    "first_line": lambda c: trim_text(F.substring_index(trim_text(c), "\n", 1)),
    "last_segment": lambda c: F.substring_index(c, "/", -1),
}


def _cleaned(value: Column, how: Column) -> Column:
    out = value
    for name, fn in CLEANUPS.items():
        out = F.when(how == name, fn(value)).otherwise(out)
    return out


def rule_fields(dom: Column, rules: Column, start: Column | None = None) -> Column:
    """``map<field, value>`` of a page, or of what lies below ``start``.

    ``rules`` is ``array<RULE_TYPE>`` of the page's domain. Per field the rules
    are tried by ``rank``; the first that yields non-empty text wins.
    """

    def value_of(r: Column) -> Column:
        node = F.get(select(dom, r["path"], start), 0)

        def take(n: Column) -> Column:
            raw = F.when(r["take"].isNull(), text_of(dom, n)).otherwise(
                F.try_element_at(n["attrs"], F.coalesce(r["take"], F.lit("")))
            )
            return let(raw, lambda v: blank_to_null(_cleaned(v, r["cleanup"])))

        return let(node, take)

    hits = F.transform(
        rules,
        lambda r: F.struct(
            r["field"].alias("field"), r["rank"].alias("rank"), value_of(r).alias("value")
        ),
    )

    def first_hits(h: Column) -> Column:
        ordered = F.array_sort(F.filter(h, lambda x: x["value"].isNotNull()))
        names = F.array_distinct(F.transform(ordered, lambda x: x["field"]))
        return F.map_from_arrays(
            names,
            F.transform(
                names, lambda f: F.get(F.filter(ordered, lambda x: x["field"] == f), 0)["value"]
            ),
        )

    return let(hits, first_hits)


def missing_required(fields: Column, rules: Column) -> Column:
    """Required fields of the domain without a value."""
    required = F.array_distinct(
        F.transform(F.filter(rules, lambda r: r["required"]), lambda r: r["field"])
    )
    return F.filter(required, lambda f: ~F.map_contains_key(fields, f))


def rule_records(dom: Column, records: Column) -> Column:
    """``array<struct<record, rows>>``: nested rules, in the order of ``records``.

    ``records`` is ``array<RECORD_TYPE>``. A record's selector opens scopes, of
    which the first ``skip`` are passed over; its rules read within a scope and
    yield one ``map<field, value>``. Scopes that lack a required field give no row.
    """

    def row_of(n: Column, r: Column) -> Column:
        fields = rule_fields(dom, r["rules"], place(n))
        return let(fields, lambda f: F.when(F.size(missing_required(f, r["rules"])) == 0, f))

    def rows(r: Column) -> Column:
        scopes = F.filter(select(dom, r["path"]), lambda n, i: i >= r["skip"])
        return F.filter(F.transform(scopes, lambda n: row_of(n, r)), lambda m: m.isNotNull())

    return F.transform(
        records, lambda r: F.struct(r["record"].alias("record"), rows(r).alias("rows"))
    )


def record_rows(records: Column, name: str) -> Column:
    """Rows of the first record of that name that found any; NULL without one."""
    return F.get(F.filter(records, lambda r: (r["record"] == name) & (F.size(r["rows"]) > 0)), 0)["rows"]


def _row_value(row: Column, field: str) -> Column:
    return F.try_element_at(row, F.lit(field))


def record_crumbs(records: Column, name: str = "crumbs") -> Column:
    """Category path from a record's ``name`` and ``url``; NULL without one."""
    rows = record_rows(records, name)
    found = F.transform(rows, lambda m: F.struct(_row_value(m, "name").alias("name"), _row_value(m, "url").alias("url")))
    return F.when(rows.isNotNull(), category_tree(found))


def record_specs(records: Column, name: str = "specs") -> Column:
    """Specifications from a record's ``key`` and ``value``; NULL without one."""
    return F.transform(
        record_rows(records, name),
        lambda m: F.struct(
            F.coalesce(_row_value(m, "key"), F.lit("")).alias("key"),
            F.coalesce(_row_value(m, "value"), F.lit("")).alias("value"),
        ),
    )


def record_values(records: Column, name: str, field: str) -> Column:
    """One field of a record's rows, each value once, in order; NULL without one."""
    values = F.transform(record_rows(records, name), lambda m: _row_value(m, field))
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull()))


def record_reviews(records: Column, name: str = "reviews") -> Column:
    """Reviews from a record's ``score_text`` and ``content``; NULL without one."""
    return F.transform(
        record_rows(records, name),
        lambda m: F.struct(
            leading_number(_row_value(m, "score_text")).cast("double").alias("score"),
            _row_value(m, "content").alias("content"),
        ),
    )


# -- category paths -----------------------------------------------------------


def crumbs_where(dom: Column, test) -> Column:
    """Breadcrumb links of a page as ``array<struct<name, url>>``."""
    return F.transform(
        F.filter(dom["nodes"], test),
        lambda n: F.struct(text_of(dom, n).alias("name"), attr(n, "href").alias("url")),
    )


def category_tree(crumbs: Column, start: int = 0, drop_last: bool = False) -> Column:
    """Category path: first ``start`` crumbs skipped, names trimmed, one
    trailing slash cut, crumbs without name or URL dropped."""
    cleaned = F.transform(
        F.slice(crumbs, F.lit(start + 1), F.greatest(F.size(crumbs), F.lit(1))),
        lambda c: F.struct(
            trim_text(c["name"]).alias("name"),
            F.regexp_replace(c["url"], r"/\z", "").alias("url"),
        ),
    )
    kept = F.filter(cleaned, lambda c: (c["name"] != "") & (c["url"] != ""))
    if not drop_last:
        return kept
    return let(
        kept, lambda k: F.slice(k, F.lit(1), F.greatest(F.size(k) - 1, F.lit(0)))
    )


def category_tree_of_listing(
    crumbs: Column,
    current_name: Column,
    page_url: Column,
    start: int = 0,
    first_page_url: Column | None = None,
) -> Column:
    """Category path of a category page, with the page itself appended; NULL
    when the page has no name."""
    url = strip_query(page_url)
    if first_page_url is not None:
        url = F.coalesce(blank_to_null(first_page_url), url)
    name = blank_to_null(trim_text(current_name))
    here = F.array(F.struct(name.alias("name"), url.alias("url")))
    return F.when(name.isNotNull(), F.concat(category_tree(crumbs, start), here))


# -- specifications -----------------------------------------------------------


def spec_table(keys: Column, values: Column, strict: bool = False) -> Column:
    """Keys and values zipped. Unequal counts give an empty list, or NULL (a
    reject) in strict profiles."""
    zipped = F.zip_with(
        keys,
        values,
        lambda k, v: F.struct(trim_text(k).alias("key"), trim_text(v).alias("value")),
    )
    mismatch = F.lit(None).cast(SPECS) if strict else F.array().cast(SPECS)
    return F.when(F.size(keys) == F.size(values), zipped).otherwise(mismatch)


def spec_lines(text: Column, keep: str = "drop") -> Column:
    """``key: value`` lines. Lines without a colon are dropped (``drop``),
    become a key with an empty value (``key``), or every non-empty line is a
    value with an empty key (``value``)."""
    lines = F.split(text, "\n")

    def part(line: Column, i: int) -> Column:
        return trim_text(F.get(F.split(line, ":"), i))

    def pair(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"))

    if keep == "drop":
        return F.transform(
            F.filter(lines, lambda x: F.contains(x, F.lit(":"))),
            lambda x: pair(part(x, 0), part(x, 1)),
        )
    if keep == "key":
        return F.transform(
            lines,
            lambda x: pair(
                F.coalesce(blank_to_null(part(x, 0)), trim_text(x)),
                F.coalesce(part(x, 1), F.lit("")),
            ),
        )
    if keep == "value":
        return F.transform(
            F.filter(F.transform(lines, trim_text), lambda x: x != ""),
            lambda x: pair(F.lit(""), x),
        )
    raise ValueError(f"unknown keep {keep!r}")


def cut_key_colon(specs: Column) -> Column:
    return F.transform(
        specs,
        lambda s: F.struct(
            F.regexp_replace(s["key"], r":\z", "").alias("key"), s["value"].alias("value")
        ),
    )


def spec_value(specs: Column, key: str, mode: str = "exact") -> Column:
    """Value of the first specification whose key matches."""
    tests = {
        "exact": lambda s: s["key"] == key,
        "ignore_case": lambda s: F.lower(s["key"]) == key.lower(),
        "contains": lambda s: F.contains(s["key"], F.lit(key)),
    }
    return F.get(F.filter(specs, tests[mode]), 0)["value"]


def transpose_specs(keys: Column, values: Column, n: Column) -> Column:
    """Specifications of ``n`` variants laid out row by row, as one list per
    variant; NULL when the counts do not fit."""

    def of_variant(v: Column) -> Column:
        return F.transform(
            keys,
            lambda k, i: F.struct(
                trim_text(k).alias("key"), trim_text(F.get(values, i * n + v)).alias("value")
            ),
        )

    return F.when(
        (F.size(keys) * n == F.size(values)) & (n > 0),
        F.transform(F.sequence(F.lit(0), n - 1), of_variant),
    )


# -- images ---------------------------------------------------------------------


def srcset_image(srcset: Column, which: str = "first") -> Column:
    """URL of the first or last entry of a ``srcset``."""
    if which == "first":
        entry = F.substring_index(srcset, ",", 1)
    else:
        entry = F.substring_index(srcset, ", ", -1)
    return F.substring_index(entry, " ", 1)


def images(urls: Column, fallback: Column | None = None, cleanup: str | None = "scheme") -> Column:
    """Ordered image list without repeats and empty entries; an empty list is
    replaced by the fallback list."""
    kept = F.filter(urls, lambda u: u.isNotNull() & (u != ""))
    if cleanup is not None:
        kept = F.transform(kept, lambda u: clean_image(u, cleanup))
    unique = F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))
    if fallback is None:
        return unique
    return let(unique, lambda u: F.when(F.size(u) > 0, u).otherwise(fallback))


# -- reviews --------------------------------------------------------------------


def reviews(count: Column, average: Column, recent: Column | None = None) -> Column:
    """Review summary; NULL unless both count and average are present."""
    items = F.array() if recent is None else recent
    built = F.struct(
        count.cast("bigint").alias("review_count"),
        average.cast("double").alias("average_review"),
        items.cast("array<struct<score: double, content: string>>").alias("recent_reviews"),
    )
    return F.when((count.cast("bigint") != 0) & (average.cast("double") != 0), built)


def star_average(full: Column, half: Column) -> Column:
    return (full + half / 2).cast("double")


def review_average(text: Column) -> Column:
    """``4,5 av 5`` style and ``4.5/5`` style averages."""
    return leading_number(
        F.substring_index(F.regexp_replace(text, r"[^0-9/.]", ""), "/", 1)
    )


def review_count(text: Column) -> Column:
    """Number in a text such as ``(1,234 ratings)``: separators are ignored."""
    return first_number(F.regexp_replace(text, "[,.]", ""))


# -- prices -----------------------------------------------------------------------

_DISCOUNT = ("price", "original_price", "is_discounted", "reject_reason")


def _discount(price: Column, original: Column, flag: Column, reject: Column | None = None) -> Column:
    return F.struct(
        price.cast("double").alias("price"),
        original.cast("double").alias("original_price"),
        flag.alias("is_discounted"),
        (F.lit(None).cast("string") if reject is None else reject).alias("reject_reason"),
    )


def discount_from_original(price: Column, original: Column) -> Column:
    """A stated original price means the product is discounted."""
    return _discount(price, original, original.isNotNull())


def discount_from_list(prices: Column) -> Column:
    """One price: no discount. Two: the lower one is asked, the higher one was.
    None or more than two: rejected."""
    return (
        F.when(
            F.size(prices) == 1, _discount(F.get(prices, 0), F.lit(None), F.lit(False))
        )
        .when(
            F.size(prices) == 2,
            _discount(F.array_min(prices), F.array_max(prices), F.lit(True)),
        )
        .otherwise(
            _discount(
                F.lit(None),
                F.lit(None),
                F.lit(None).cast("boolean"),
                F.lit("Cannot extract price"),
            )
        )
    )


def discount_from_texts(price_text: Column, original_text: Column, parse) -> Column:
    """Equal price texts mean no discount."""
    differs = F.coalesce(
        (original_text != "") & (original_text != price_text), F.lit(False)
    )
    return _discount(
        parse(price_text), F.when(differs, parse(original_text)), differs
    )


def discount_from_choice(regular: Column, reduced: Column, original: Column) -> Column:
    """A regular price wins; else a reduced price needs its original price;
    else rejected."""
    return (
        F.when(regular.isNotNull(), _discount(regular, F.lit(None), F.lit(False)))
        .when(
            reduced.isNotNull() & original.isNotNull(),
            _discount(reduced, original, F.lit(True)),
        )
        .otherwise(
            _discount(
                F.lit(None),
                F.lit(None),
                F.lit(None).cast("boolean"),
                F.lit("Cannot extract price"),
            )
        )
    )


def discount_with_sale_text(
    price: Column, original: Column, sale_text: Column, marker: str
) -> Column:
    """A sale text alone also means discounted."""
    on_sale = F.coalesce(F.contains(sale_text, F.lit(marker)), F.lit(False))
    return _discount(price, original, original.isNotNull() | on_sale)


def price_or_default(
    price: Column,
    availability: Column,
    rule: str,
    text: Column | None = None,
    sold_out: str = "Slutsåld!",
) -> Column:
    """Struct of price and reject reason when a page may lack a price.

    ``zero``: an out-of-stock product costs 0, else a missing price rejects.
    ``null``: a missing price, or a text with the sold-out mark, is NULL.
    """
    none = F.lit(None).cast("string")
    if rule == "zero":
        out = availability == "out_of_stock"
        return F.struct(
            F.coalesce(price, F.when(out, F.lit(0.0))).alias("price"),
            F.when(
                price.isNull() & ~F.coalesce(out, F.lit(False)), F.lit("Cannot extract price")
            ).alias("reject_reason"),
        )
    if rule == "null":
        gone = F.lit(False)
        if text is not None:
            gone = F.coalesce(F.contains(text, F.lit(sold_out)), F.lit(True))
        return F.struct(F.when(~gone, price).alias("price"), none.alias("reject_reason"))
    raise ValueError(f"unknown rule {rule!r}")


# -- availability -------------------------------------------------------------------

# Class colours of a stock label.
COLOUR_AVAILABILITY = {
    "green": "in_stock",
    "red": "out_of_stock",
    "yellow": "back_order",
}


def availability_rule(
    rule: str,
    text: Column,
    button: Column | None = None,
    tag: str = "Disponible",
    gone: tuple[str, ...] = ("unavailable", "out of stock"),
) -> Column:
    """Availability of a page by one of the shops' rules.

    ``in_stock_mark``: text contains ``InStock``. ``in_stock_default``: as
    before, but a missing text means in stock. ``not_available``: in stock
    unless the text says it is not. ``text_and_button``: no text, a negative
    text or no cart button means out of stock. ``tags``: a tag list holds the
    given tag. ``colour``: colour in a class attribute. ``if_present`` and
    ``unless_present``: whether anything is there at all.
    """
    yes, no = F.lit("in_stock"), F.lit("out_of_stock")
    if rule == "in_stock_mark":
        return F.when(F.contains(text, F.lit("InStock")), yes).otherwise(no)
    if rule == "in_stock_default":
        stated = blank_to_null(trim_text(text))
        return F.when(stated.isNull() | F.contains(stated, F.lit("InStock")), yes).otherwise(no)
    if rule == "not_available":
        return F.when(F.contains(F.lower(text), F.lit("ej tillgänglig")), no).otherwise(yes)
    if rule == "text_and_button":
        negative = F.lower(text).rlike("|".join(gone))
        fine = (text != "") & ~negative & (button != "")
        return F.when(F.coalesce(fine, F.lit(False)), yes).otherwise(no)
    if rule == "tags":
        trimmed = F.transform(text, trim_text)
        return F.when(F.array_contains(trimmed, tag), yes).otherwise(no)
    if rule in ("if_present", "unless_present"):
        there = F.coalesce(trim_text(text) != "", F.lit(False))
        return F.when(there if rule == "if_present" else ~there, yes).otherwise(no)
    if rule == "colour":
        out = F.lit(None).cast("string")
        for colour, label in reversed(COLOUR_AVAILABILITY.items()):
            out = F.when(F.contains(text, F.lit(colour)), F.lit(label)).otherwise(out)
        return out
    raise ValueError(f"unknown rule {rule!r}")


# -- records, names and descriptions ---------------------------------------------------


def pick_by_sku(records: Column, sku: Column, or_first: bool = True) -> Column:
    """Record with the given SKU, else the first one (or none)."""
    hit = F.get(F.filter(records, lambda r: r["sku"] == sku), 0)
    return F.coalesce(hit, F.get(records, 0)) if or_first else hit


def product_name(parts: Column, mode: str = "join") -> Column:
    """``join``: non-empty parts joined by a blank. ``first_line``: first line
    of the first part."""
    if mode == "join":
        trimmed = F.transform(parts, trim_text)
        return F.array_join(F.filter(trimmed, lambda p: p != ""), " ")
    if mode == "first_line":
        return F.substring_index(F.get(parts, 0), "\n", 1)
    raise ValueError(f"unknown mode {mode!r}")


def description(texts: Column, mode: str = "join", marker: str = "Specifikationer:") -> Column:
    """``join``: paragraphs joined by line breaks. ``unique``: repeated texts
    once, joined by blank lines. ``cut``: first text up to a marker.
    ``without``: paragraphs that mention the marker left out, joined by a
    blank."""
    if mode == "join":
        return trim_text(F.array_join(texts, "\n"))
    if mode == "unique":
        return F.array_join(F.array_distinct(texts), "\n\n")
    if mode == "cut":
        return F.substring_index(trim_text(F.get(texts, 0)), marker, 1)
    if mode == "without":
        return F.array_join(
            F.filter(texts, lambda t: ~F.contains(t, F.lit(marker))), " "
        )
    raise ValueError(f"unknown mode {mode!r}")


def section_text(dom: Column, heading_tag: str, heading: str, content_class: str) -> Column:
    """Text of the first content element after the heading with a given text."""
    head = F.get(
        F.filter(
            dom["nodes"],
            lambda n: (n["tag"] == heading_tag) & (trim_text(text_of(dom, n)) == heading),
        ),
        0,
    )

    def after(h: Column) -> Column:
        body = F.get(
            F.filter(
                dom["nodes"], lambda n: (n["pos"] > h["pos"]) & has_class(n, content_class)
            ),
            0,
        )
        return let(body, lambda b: trim_text(text_of(dom, b)))

    return let(head, after)


def rule_extract(pages: DataFrame, rules: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Rule-driven values of every page of a domain with rules: ``fields`` map,
    ``missing`` list and ``records``.

    ``rules`` holds one row per domain with its rules and records, see
    :meth:`offerloom.operators.profiles.Registry.rules_frame`.
    """
    from offerloom.functions.urls import domain_of
    from offerloom.operators.elements import page_dom

    keep = [c for c in pages.columns if c != html]
    return (
        pages.withColumn("domain", domain_of(F.col(url)))
        .join(rules, "domain")
        .select(*keep, "domain", "rules", F.col("records").alias("_records"), page_dom(F.col(html)).alias("_dom"))
        .withColumn("fields", rule_fields(F.col("_dom"), F.col("rules")))
        .withColumn("missing", missing_required(F.col("fields"), F.col("rules")))
        .withColumn("records", rule_records(F.col("_dom"), F.col("_records")))
        .drop("_dom", "rules", "_records")
    )


def offer_columns(registry, domain: Column, fields: Column, records: Column) -> dict[str, Column]:
    """Offer fields from what a domain's rules found, in the styles its profile
    names; without a price style the generic price reading is used."""

    def text(name: str) -> Column:
        return F.try_element_at(fields, F.lit(name))

    def price(name: str) -> Column:
        styled = registry.by_style(domain, "price_style", lambda s: parse_price_as(text(name), s))
        known = registry.lookup(domain, "price_style").isNotNull()
        return F.when(known, styled).otherwise(parse_price_safe(text(name)))

    sku = registry.by_style(domain, "sku_style", lambda s: sku_of(text("sku_text"), s))
    stock = registry.by_style(
        domain, "availability_rule", lambda r: availability_rule(r, text("availability_text"))
    )
    return {
        "name": text("name"),
        "brand": text("brand"),
        "brand_url": text("brand_url"),
        "description": text("description"),
        "price": price("price_text"),
        "original_price": price("original_price_text"),
        "currency": registry.lookup(domain, "currency").cast("string"),
        "sku": F.coalesce(sku, text("sku_text")).cast("string"),
        "gtin": text("gtin"),
        "mpn": text("mpn"),
        "availability": stock.cast("string"),
        "category_tree": record_crumbs(records),
        "specifications": record_specs(records),
        "images": record_values(records, "images", "url"),
        "review_count": leading_number(F.regexp_extract(text("review_count_text"), r"([0-9][0-9., ]*)", 1)).cast("bigint"),
        "average_review": first_number(text("review_score_text")).cast("double"),
        "reviews": record_reviews(records),
        "variant_urls": record_values(records, "variants", "url"),
    }


def rule_offers(pages: DataFrame, registry, html: str = "html", url: str = "url") -> DataFrame:
    """Offers of the pages whose domain has rules, by the rules alone. Pages that
    lack a required field carry ``reject_reason``."""
    rows = rule_extract(pages, registry.rules_frame(pages.sparkSession), html, url)
    keep = [c for c in rows.columns if c not in ("fields", "missing", "records")]
    found = offer_columns(registry, F.col("domain"), F.col("fields"), F.col("records"))
    return rows.select(
        *keep, *[c.alias(n) for n, c in found.items()], missing_reason(F.col("missing")).alias("reject_reason")
    ).withColumn("is_discounted", F.col("original_price").isNotNull())


def missing_reason(missing: Column) -> Column:
    """Reject reason that names the missing fields; NULL if there are none."""
    return F.when(F.size(missing) > 0, F.concat(F.lit("Cannot extract "), F.array_join(missing, ", ")))

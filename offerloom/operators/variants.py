"""Product variants: option grids, numbering, group URLs and variant URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from offerloom.functions.urls import let, normalise_url
from offerloom.operators.structured import get, products_of


# Variants that one row generates at a time.
_CHUNK = 4096


def _used(sizes: Column) -> Column:
    """The option counts before the first parameter without options."""
    stop = F.array_position(F.transform(sizes, lambda s: s <= 0), F.lit(True))
    return F.when(stop > 0, F.slice(sizes, F.lit(1), stop.cast("int") - 1)).otherwise(sizes)


# A number of combinations beyond this is only known to be larger.
_MANY = 2**61


def _times(a: Column, b: Column) -> Column:
    """Product of two counts, at most ``_MANY``."""
    over = a > F.floor(F.lit(_MANY) / F.greatest(b, F.lit(1)))
    return F.when(b == 0, F.lit(0).cast("bigint")).when(over, F.lit(_MANY)).otherwise(a * b)


def _product(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(1).cast("bigint"), lambda a, x: _times(a, x.cast("bigint")))


def _rest(sizes: Column, i: Column) -> Column:
    """Combinations of the parameters behind the first ``i``."""
    return _product(F.slice(sizes, i + 1, F.greatest(F.size(sizes) - i, F.lit(0))))


def _valid_ranges(sizes: Column, invalid: Column | None, limit: int | None) -> Column:
    """Combination numbers without an invalid prefix, as ascending ranges
    ``struct<from, number, count>``; ``number`` counts those before. A prefix is
    one range of numbers, so nothing is enumerated."""
    piece = "array<struct<from:bigint,number:bigint,count:bigint>>"

    def prefix_range(p: Column) -> Column:
        start = F.aggregate(
            F.transform(p, lambda x, i: _times(_rest(sizes, i + 1), x.cast("bigint"))),
            F.lit(0).cast("bigint"),
            lambda a, x: F.least(a + x, F.lit(_MANY)),
        )
        end = F.least(start + _rest(sizes, F.size(p)), F.lit(_MANY))
        return F.struct(start.alias("start"), end.alias("end"))

    def fits(p: Column) -> Column:
        inside = F.zip_with(p, F.slice(sizes, F.lit(1), F.size(p)), lambda x, n: (x >= 0) & (x < n))
        return (F.size(p) <= F.size(sizes)) & F.forall(inside, lambda ok: F.coalesce(ok, F.lit(False)))

    def add(acc: Column, start: Column, end: Column) -> Column:
        gap = F.greatest(start - acc["at"], F.lit(0))
        new = F.array(F.struct(acc["at"].alias("from"), acc["n"].alias("number"), gap.alias("count"))).cast(piece)
        return F.struct(
            F.greatest(acc["at"], end).alias("at"),
            (acc["n"] + gap).alias("n"),
            F.when(gap > 0, F.concat(acc["out"], new)).otherwise(acc["out"]).alias("out"),
        )

    zero = F.lit(0).cast("bigint")
    first = F.struct(zero.alias("at"), zero.alias("n"), F.array().cast(piece).alias("out"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    bad = none if invalid is None else F.array_sort(F.transform(F.filter(invalid, fits), prefix_range))
    total = _product(sizes)
    ranges = F.aggregate(
        bad, first, lambda acc, r: add(acc, r["start"], r["end"]), lambda acc: add(acc, total, total)["out"]
    )
    # beyond _MANY combinations have no number: nothing that is asked for may lie there
    found = F.aggregate(ranges, F.lit(0).cast("bigint"), lambda a, r: a + r["count"])
    short = total >= _MANY if not limit else (total >= _MANY) & (found < limit)
    error = F.raise_error(F.lit("more option combinations than can be numbered")).cast(piece)
    ranges = F.when(short, error).otherwise(ranges)
    if limit:
        ranges = F.transform(
            F.filter(ranges, lambda r: r["number"] < limit),
            lambda r: F.struct(
                r["from"].alias("from"),
                r["number"].alias("number"),
                F.least(r["count"], F.lit(limit) - r["number"]).alias("count"),
            ),
        )
    return ranges


def variant_grid(
    products: DataFrame,
    sizes: str = "option_counts",
    invalid: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per variant: ``variant`` 0,1,2,... in grid order and its
    ``options``. A product without parameters has one variant 0 without
    options; a product whose combinations are all invalid has none. Nothing is
    shuffled, and no row holds a grid: ranges of combination numbers become
    chunks, chunks become rows, and ``limit`` cuts the ranges. A product of 2^61
    combinations or more needs a ``limit`` that it can fill before the invalid
    ones reach that far; else the job fails."""
    used = _used(F.col(sizes))
    bad = None
    if invalid is not None:
        bad = F.coalesce(F.col(invalid), F.array().cast("array<array<int>>"))
    plain = F.size(used) == 0
    one = F.lit(1).cast("bigint")
    single = F.array(F.struct((one - 1).alias("from"), (one - 1).alias("number"), one.alias("count")))
    ranges = F.when(plain, single).otherwise(_valid_ranges(used, bad, limit))
    keep = products.columns
    pieces = products.select(*keep, F.explode(ranges).alias("_r"))
    chunks = pieces.select(
        *keep, "_r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_r.count") - 1) / _CHUNK))).alias("_k")
    )
    last = F.least((F.col("_k") + 1) * _CHUNK, F.col("_r.count")) - 1
    rows = chunks.select(*keep, "_r", F.explode(F.sequence(F.col("_k") * _CHUNK, last)).alias("_i"))
    number = F.col("_r.from") + F.col("_i")
    options = F.transform(used, lambda x, i: F.pmod(F.floor(number / _rest(used, i + 1)), x).cast("int"))
    return rows.select(
        *keep,
        (F.col("_r.number") + F.col("_i")).cast("int").alias("variant"),
        F.when(plain, F.array().cast("array<int>")).otherwise(options).alias("options"),
    )


def drop_invalid(grid: DataFrame, invalid: DataFrame, product: str, options: str = "options") -> DataFrame:
    """Remove combinations that start with an invalid prefix given as a table
    ``(product, prefix)``. Prefixes are grouped per product first."""
    prefixes = invalid.groupBy(product).agg(F.collect_set("prefix").alias("_bad"))
    return (
        grid.join(prefixes, product, "left")
        .where(
            ~F.coalesce(
                F.exists(
                    "_bad", lambda p: F.slice(F.col(options), F.lit(1), F.size(p)) == p
                ),
                F.lit(False),
            )
        )
        .drop("_bad")
    )


def stamp_group(
    pages: DataFrame, group: str, seen: str, url: str = "url", inherit: tuple[str, ...] = ()
) -> DataFrame:
    """Every page of a group gets the URL (and the inherited columns) of the
    group's first page. The first page is found by partial aggregation."""
    first = pages.groupBy(group).agg(
        F.min(F.struct(seen, url, *inherit)).alias("_first")
    )
    out = pages.join(first, group, "left").withColumn("variant_group_url", F.col(f"_first.{url}"))
    for name in inherit:
        out = out.withColumn(name, F.col(f"_first.{name}"))
    return out.drop("_first")


def jsonld_variant_urls(html: Column) -> Column:
    """Offer URLs of the page's first product block."""
    product = F.get(products_of(html), 0)
    offers = F.try_variant_get(product, "$.offers", "array<variant>")
    return F.filter(F.transform(offers, lambda o: get(o, "$.url")), lambda u: u.isNotNull())


def variant_urls(
    pages: DataFrame, urls: Column, html: str = "html", url: str = "url"
) -> DataFrame:
    """One row per variant URL of a page, absolute."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(urls).alias("variant", "_u")).select(
        *keep, "variant", normalise_url(F.col("_u"), F.col(url)).alias("variant_url")
    )


def variant_url(url: Column, sku: Column, mode: str) -> Column:
    """Variant URL from the product URL and the SKU.

    ``segment``: last path segment replaced. ``query``: ``?sku=`` in place of
    the query. ``fragment``: ``#<sku>``. ``fragment_sku``: ``#sku=<sku>``.
    """
    base = base_url(url)
    if mode == "segment":
        return F.concat(F.regexp_replace(url, r"[^/]*\z", ""), sku)
    if mode == "query":
        return F.concat(F.substring_index(url, "?", 1), F.lit("?sku="), sku)
    if mode == "fragment":
        return F.concat(base, F.lit("#"), sku)
    if mode == "fragment_sku":
        return F.concat(base, F.lit("#sku="), sku)
    raise ValueError(f"unknown mode {mode!r}")


def base_url(url: Column) -> Column:
    return F.substring_index(url, "#", 1)

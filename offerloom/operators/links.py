"""Links of captured pages and the frontier of URLs to visit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from offerloom.functions.urls import domain_of, normalise_url, strip_query
from offerloom.operators.anchors import page_anchors, without_repeats
from offerloom.operators.elements import attr, page_dom, text_of
from offerloom.operators.ranking import first_per_key

def links(
    pages: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    html: str = "html",
    drop_repeats: bool = False,
) -> DataFrame:
    """One row per anchor: page columns without the HTML, ``pos``, ``href``
    and, with rules ``(pattern, label)``, the label of the first pattern that
    matches; anchors without a label are left out. ``drop_repeats`` leaves out
    an anchor with the target of the one right before it, within the page's row."""
    found = _exploded(pages, html, None, None, drop_repeats)
    if rules is None:
        return found
    label = F.coalesce(*[F.when(F.col("href").rlike(p), F.lit(n)) for p, n in rules])
    return found.withColumn("label", label).where(F.col("label").isNotNull())


def homepage_links(pages: DataFrame, html: str = "html", drop_repeats: bool = False) -> DataFrame:
    """Anchors outside header, nav and footer; anchors to a place on the page
    itself are left out, before ``drop_repeats`` looks at neighbours."""
    return _exploded(
        pages, html, lambda a: ~a["section"], lambda a: ~F.startswith(a["href"], F.lit("#")), drop_repeats
    )


def _exploded(pages: DataFrame, html: str, counted, kept, drop_repeats: bool) -> DataFrame:
    """One row per anchor: numbered among the ``counted`` ones, if it is ``kept``.
    All of it happens inside the page's row, before it becomes many."""
    keep = [c for c in pages.columns if c != html]
    anchors = F.col("_anchors")
    body = anchors if counted is None else F.filter(anchors, counted)
    numbered = F.transform(body, lambda a, i: F.struct(i.alias("pos"), a["href"].alias("href")))
    wanted = numbered if kept is None else F.filter(numbered, kept)
    rows = pages.select(*keep, page_anchors(F.col(html)).alias("_anchors")).select(*keep, wanted.alias("_anchors"))
    if drop_repeats:
        rows = rows.select(*keep, without_repeats(F.col("_anchors")).alias("_anchors"))
    return rows.select(*keep, F.inline_outer("_anchors")).where(F.col("href").isNotNull())


def drop_consecutive_dups(
    found: DataFrame, page: list[str], pos: str = "pos", href: str = "href"
) -> DataFrame:
    """A link equal to the one right before it on the page goes away; later
    mentions stay. For links that are rows already; :func:`links` does the same
    within the page's row, without a shuffle. The window holds one document."""
    before = F.lag(href).over(Window.partitionBy(*page).orderBy(pos))
    return (
        found.withColumn("_before", before)
        .where(~F.col(href).eqNullSafe(F.col("_before")))
        .drop("_before")
    )


def resolve_url(url: Column, base: Column) -> Column:
    return normalise_url(url, base)


def known_urls(found: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Found links that are known product URLs."""
    return found.join(known.select(F.col(url)).distinct(), url, "left_semi")


def expand_pages(
    categories: DataFrame,
    n_pages: Column | None = None,
    n_products: Column | None = None,
    page_size: int | Column = 1,
    first: int = 1,
    url: str = "url",
) -> DataFrame:
    """One row per listing page of a category: ``page_url`` and
    ``page_number``. The count of pages is given, or follows from the count of
    products. URLs that carry a page number already are not expanded."""
    if n_pages is None:
        n_pages = F.ceil(n_products / page_size)
    last = n_pages.cast("int")
    numbers = F.when(
        (last >= first) & ~F.contains(F.col(url), F.lit("?page=")),
        F.sequence(F.lit(first), last),
    )
    return categories.withColumn("page_number", F.explode(numbers)).withColumn(
        "page_url",
        F.concat(strip_query(F.col(url)), F.lit("?page="), F.col("page_number").cast("string")),
    )


def dedupe_frontier(
    new: DataFrame, known: DataFrame, key: str = "unique_key", order: tuple[str, ...] = ("pos",)
) -> DataFrame:
    """First request per key that is in no known set."""
    fresh = first_per_key(new, [key], list(order))
    return fresh.join(known.select(key).distinct(), key, "left_anti")


def split_by_label(requests: DataFrame, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(set aside, go on)``: requests with a listed label, and the others
    (requests without a label go on)."""
    listed = F.coalesce(F.col("label").isin(labels), F.lit(False))
    return requests.where(listed), requests.where(~listed)


def search_links(found: DataFrame, k: int, page: list[str], pos: str = "pos") -> DataFrame:
    """First ``k`` result links of every search page."""
    rank = F.row_number().over(Window.partitionBy(*page).orderBy(pos))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def search_url(query: Column, domain: Column, templates: dict[str, str]) -> Column:
    """Search URL by the domain's template; NULL where search is unknown."""
    out = F.lit(None).cast("string")
    for name, template in templates.items():
        head, tail = template.split("%s")
        out = F.when(domain == name, F.concat(F.lit(head), query, F.lit(tail))).otherwise(out)
    return out


def classify_categories(
    pages: DataFrame, sub_links: DataFrame, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """``LIST`` for leaf categories, else ``INTERMEDIATE_CATEGORY``.

    A category page is a leaf when it lists itself among its sub-categories
    (absolute URLs in ``sub_links.link``) or lists none.
    """
    own = pages.select(key, F.col(url).alias("_own"))
    facts = (
        own.join(sub_links.select(key, "link"), key, "left")
        .groupBy(key)
        .agg(
            F.count("link").alias("n_sub"),
            F.bool_or(F.col("link") == F.col("_own")).alias("lists_itself"),
            F.first("_own").alias("_own"),
        )
    )
    leaf = (F.col("n_sub") == 0) | F.coalesce(F.col("lists_itself"), F.lit(False))
    return facts.select(
        key,
        F.col("_own").alias(url),
        "n_sub",
        F.when(leaf, F.lit("LIST")).otherwise(F.lit("INTERMEDIATE_CATEGORY")).alias("label"),
    )


# Root paths one shop's menu is cut down to, and the mark of
# campaign links.
CATEGORY_ROOTS = (
    "/servering",
    "/inredning",
    "/belysning",
    "/mobler",
    "/koket",
    "/textil-och-mattor",
    "/utemobler",
)
CAMPAIGN_MARK = "?kampanj"


def filter_category_links(
    found: DataFrame,
    roots: tuple[str, ...] = CATEGORY_ROOTS,
    campaign: str | None = CAMPAIGN_MARK,
    href: str = "href",
) -> DataFrame:
    """Links below one of the root paths that are no campaign links."""
    kept = F.col(href).rlike("^(" + "|".join(roots) + ")")
    if campaign is not None:
        kept = kept & ~F.contains(F.col(href), F.lit(campaign))
    return found.where(kept)


def new_categories(extracted: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Extracted category URLs that are not known yet."""
    return (
        extracted.select(url).distinct().join(known.select(url).distinct(), url, "left_anti")
    )


def all_categories(extracted: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    return known.select(url).union(extracted.select(url)).distinct()


def menu_categories(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Second-level menu links with their two-level category path.

    Level 1 is a link directly in a menu item, level 2 a link in an item of the
    list inside that menu item. The last menu list of a page is no category
    menu and is left out.
    """
    keep = [c for c in pages.columns if c != html]
    dom = F.col("_dom")
    nodes = F.col("_dom.nodes")

    def node(i: Column) -> Column:
        return F.get(nodes, i)

    def ancestor(n: Column, back: int) -> Column:
        """Position of the ``back``-th ancestor (1 = parent), NULL if none."""
        return F.try_element_at(n["up"], F.lit(-back))

    def is_menu(n: Column) -> Column:
        return (n["tag"] == "ul") & F.contains(attr(n, "class"), F.lit("mega-menu__list"))

    menus = F.transform(F.filter(nodes, is_menu), lambda n: n["pos"])
    # a > li > ul(menu)
    tops = F.filter(
        nodes,
        lambda n: (n["tag"] == "a")
        & (node(ancestor(n, 1))["tag"] == "li")
        & F.array_contains(F.col("_menus"), ancestor(n, 2)),
    )
    # a > li > ul > li(menu item)
    subs = F.filter(
        nodes,
        lambda n: (n["tag"] == "a")
        & (node(ancestor(n, 1))["tag"] == "li")
        & (node(ancestor(n, 2))["tag"] == "ul")
        & (node(ancestor(n, 3))["tag"] == "li")
        & F.array_contains(F.col("_menus"), ancestor(n, 4)),
    )

    def crumb(n: Column) -> Column:
        return F.struct(
            F.trim(text_of(dom, n)).alias("name"),
            normalise_url(attr(n, "href"), F.col(url)).alias("url"),
        )

    return (
        pages.select(*keep, page_dom(F.col(html)).alias("_dom"))
        .withColumn("_menus", menus)
        .withColumn("_menus", F.slice("_menus", F.lit(1), F.greatest(F.size("_menus") - 1, F.lit(0))))
        .withColumn(
            "_tops",
            F.transform(tops, lambda n: F.struct(ancestor(n, 1).alias("item"), crumb(n).alias("c"))),
        )
        .withColumn(
            "_subs",
            F.transform(subs, lambda n: F.struct(ancestor(n, 3).alias("item"), crumb(n).alias("c"))),
        )
        .select(*keep, "_tops", F.posexplode("_subs").alias("pos", "_s"))
        .select(
            *keep,
            "pos",
            F.col("_s.c.url").alias("category_url"),
            F.array(
                F.get(F.filter("_tops", lambda t: t["item"] == F.col("_s.item")), 0)["c"],
                F.col("_s.c"),
            ).alias("category_tree"),
        )
    )


def by_domain(requests: DataFrame, url: str = "url", rows: int = 100_000) -> DataFrame:
    """Requests laid out by domain. Domains are counted first, and one with more
    than ``rows`` requests is dealt by its URLs over as many parts as it needs, so
    a dominant domain has as many as it has work. Requests without a domain are
    dealt like one."""
    named = requests.withColumn("domain", domain_of(F.col(url)))
    key = F.struct("domain")  # never NULL, although the domain may be
    counts = named.groupBy(key.alias("_d")).agg(F.ceil(F.count("*") / F.lit(rows)).alias("_parts"))
    dealt = named.withColumn("_d", key).join(counts, "_d")
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(F.col(url)), F.col("_parts")))
    return dealt.repartition("domain", "_part").drop("_d", "_parts", "_part")

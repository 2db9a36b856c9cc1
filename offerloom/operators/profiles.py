"""Retailer profiles: one row of settings and rules per domain, plus hooks.

A new retailer is a new profile, not new code. Profiles live in a registry on
the driver; what a job needs of them becomes literals or a small DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from offerloom.functions.identifiers import product_id
from offerloom.functions.urls import PRODUCT_URL_PATTERNS, origin_of
from offerloom.operators.fields import RECORD_TYPE, RULE_TYPE
from offerloom.operators.selectors import compile_selector


@dataclass(frozen=True)
class Rule:
    """Where one field stands: a selector, or its parts one by one. ``take``
    names an attribute; without it the text is taken. Lower ``rank`` is tried
    first."""

    field: str
    at: str | None = None
    tag: str | None = None
    cls: str | None = None
    attr: str | None = None
    attr_value: str | None = None
    under_class: str | None = None
    take: str | None = None
    cleanup: str | None = "trim"
    required: bool = False
    rank: int = 0

    def path(self) -> list[tuple]:
        if self.at is not None:
            return compile_selector(self.at)
        tests = [("tag", None, self.tag, False)] if self.tag else []
        tests += [("class", None, self.cls, False)] if self.cls else []
        if self.attr:
            tests.append(("has" if self.attr_value is None else "is", self.attr, self.attr_value, False))
        under = [(" ", [("class", None, self.under_class, False)], [])] if self.under_class else []
        return [*under, (" ", tests, [])]

    def row(self) -> tuple:
        return (self.field, self.rank, self.path(), self.take, self.cleanup, self.required)


@dataclass(frozen=True)
class Record:
    """A list on a page: the selector of its items and the rules within one.
    The first ``skip`` items are passed over."""

    name: str
    at: str
    rules: tuple[Rule, ...]
    skip: int = 0

    def row(self) -> tuple:
        return (self.name, compile_selector(self.at), self.skip, [r.row() for r in self.rules])


@dataclass(frozen=True)
class Profile:
    domain: str
    currency: str | None = None
    page_size: int | None = None
    product_url: str | None = None
    search_url: str | None = None
    search_limit: int | None = None
    price_style: str | None = None
    sku_style: str | None = None
    availability_rule: str | None = None
    disabled_strategies: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    records: tuple[Record, ...] = ()
    card_rules: tuple[Rule, ...] = ()
    card_records: tuple[Record, ...] = ()


@dataclass
class Registry:
    """Profiles and hooks known to a job."""

    profiles: dict[str, Profile] = field(default_factory=dict)
    canonical: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    finishers: dict[str, Callable[[DataFrame], dict[str, Column]]] = field(default_factory=dict)
    outcome_rules: dict[str, list[tuple[Callable, str]]] = field(default_factory=dict)
    extractors: dict[str, tuple[Callable, str]] = field(default_factory=dict)

    # -- registration -----------------------------------------------------------

    def register_profile(self, profile: Profile) -> None:
        self.profiles[profile.domain] = profile

    def register_canonical(self, domain: str, fn: Callable[[Column], Column]) -> None:
        """Hook: URL -> canonical URL. NULL rejects the row."""
        self.canonical[domain] = fn

    def register_finisher(self, domain: str, fn: Callable[[DataFrame], dict[str, Column]]) -> None:
        """Hook: columns to set on the finished offers of a domain."""
        self.finishers[domain] = fn

    def register_rule(self, domain: str, predicate: Callable, label: str, first: bool = False) -> None:
        """Outcome rule of a domain, behind or in front of its other rules."""
        rules = self.outcome_rules.setdefault(domain, [])
        rules.insert(0 if first else len(rules), (predicate, label))

    def register_extractor(self, domain: str, fn: Callable, schema: str) -> None:
        """Custom extraction code: an iterator of pandas frames to another."""
        self.extractors[domain] = (fn, schema)

    # -- what jobs read ------------------------------------------------------------

    def lookup(self, domain: Column, attribute: str) -> Column:
        """Profile attribute of a domain as a column."""
        pairs = [
            F.lit(x)
            for p in self.profiles.values()
            if getattr(p, attribute) is not None
            for x in (p.domain, getattr(p, attribute))
        ]
        if not pairs:
            return F.lit(None)
        return F.try_element_at(F.create_map(*pairs), domain)

    def by_style(self, domain: Column, attribute: str, apply: Callable[[str], Column]) -> Column:
        """A column that depends on a style named in the domain's profile;
        NULL for domains without one."""
        domains: dict[str, list[str]] = {}
        for p in self.profiles.values():
            if getattr(p, attribute) is not None:
                domains.setdefault(getattr(p, attribute), []).append(p.domain)
        if not domains:
            return F.lit(None)
        return F.coalesce(
            *[F.when(domain.isin(names), apply(style)) for style, names in domains.items()]
        )

    def disabled(self) -> dict[str, tuple[str, ...]]:
        return {
            p.domain: p.disabled_strategies
            for p in self.profiles.values()
            if p.disabled_strategies
        }

    def rule_rows(self, cards: bool = False) -> dict[str, tuple[list[tuple], list[tuple]]]:
        """Rows of the rules and of the records of product pages, or of category
        pages, per domain that has any."""
        found = {}
        for p in self.profiles.values():
            rules, records = (p.card_rules, p.card_records) if cards else (p.rules, p.records)
            if rules or records:
                found[p.domain] = [r.row() for r in rules], [r.row() for r in records]
        return found

    def rules_frame(self, spark: SparkSession, cards: bool = False) -> DataFrame:
        """``(domain, rules, records)`` of product pages, or of category pages,
        with one row per domain that has any; of the size of the profiles held here."""
        rows = [(domain, *both) for domain, both in self.rule_rows(cards).items()]
        schema = f"domain: string, rules: array<{RULE_TYPE}>, records: array<{RECORD_TYPE}>"
        # as large as the Python code that states it, whatever the pages
        return F.broadcast(spark.createDataFrame(rows, schema))

    def apply_canonical(self, url: Column, domain: Column) -> Column:
        out = url
        for name, fn in self.canonical.items():
            out = F.when(domain == name, fn(url)).otherwise(out)
        return out

    def apply_finishers(self, offers: DataFrame, domain: str = "retailer_domain") -> DataFrame:
        for name, fn in self.finishers.items():
            for column, value in fn(offers).items():
                old = F.col(column) if column in offers.columns else F.lit(None)
                offers = offers.withColumn(
                    column, F.when(F.col(domain) == name, value).otherwise(old)
                )
        return offers

    def extract_custom(self, pages: DataFrame, domain: str = "domain") -> dict[str, DataFrame]:
        """Run every registered extractor over the pages of its domain."""
        return {
            name: pages.where(F.col(domain) == name).mapInPandas(fn, schema)
            for name, (fn, schema) in self.extractors.items()
        }

    def extract_all_custom(self, pages: DataFrame, domain: str = "domain") -> DataFrame:
        """Rows of all registered extractors in one pass over the pages.

        Each page goes to the extractor of its domain, pages of other domains to
        none. The columns are those of all extractors; a column that an
        extractor does not have is NULL in its rows, and two that state a column
        with different types are refused.
        """
        types: dict[str, T.DataType] = {}
        for name, (_, schema) in self.extractors.items():
            for f in T.StructType.fromDDL(schema).fields:
                if types.setdefault(f.name, f.dataType) != f.dataType:
                    raise ValueError(f"column {f.name!r} of {name!r} differs in type from another extractor's")
        schema = T.StructType([T.StructField(n, t) for n, t in types.items()])
        extractors = {name: fn for name, (fn, _) in self.extractors.items()}
        own = pages.where(F.col(domain).isin(*extractors))
        return own.mapInPandas(lambda frames: _routed(frames, extractors, domain, list(types)), schema)


def _routed(frames, extractors: dict[str, Callable], domain: str, columns: list[str]):
    """Each frame cut by domain and handed to that domain's extractor."""
    for frame in frames:
        for name, part in frame.groupby(domain, sort=False):
            for found in extractors[name](iter([part.reset_index(drop=True)])):
                yield found.reindex(columns=columns)


def _without_redirect_mark(url: Column) -> Column:
    """The first ``/?redirect=301`` of a URL is dropped."""
    return F.regexp_replace(url, r"^(.*?)/\?redirect=301", "$1")


def _canonical_asin(url: Column) -> Column:
    return F.concat(origin_of(url), F.lit("/-/en/dp/"), product_id(url, "asin"))


def _group_url(url: Column) -> Column:
    from offerloom.operators.offers import variant_group_url

    return variant_group_url(url)


# Settings of the known retailers.
CURRENCIES = {
    "amazon.de": "EUR",
    "bernomobler.se": "SEK",
    "bygghemma.se": "SEK",
    "chilli.se": "SEK",
    "connox.dk": "DKK",
    "ellos.se": "SEK",
    "baldai1.lt": "EUR",
    "furniturebox.se": "SEK",
    "gardenstore.se": "SEK",
    "gigameubel.nl": "EUR",
    "homeroom.se": "SEK",
    "jardindeco.com": "EUR",
    "jensen-company.dk": "DKK",
    "k-rauta.se": "SEK",
    "nordiskarum.se": "SEK",
    "nordlyliving.dk": "DKK",
    "norliving.dk": "DKK",
    "royaldesign.se": "SEK",
    "trademax.se": "SEK",
    "trendrum.se": "SEK",
    "unoliving.com": "DKK",
    "venturedesign.se": "SEK",
}
NO_FIXED_CURRENCY = (
    "andlight.dk",
    "ebuy24.dk",
    "finnishdesignshop.fi",
    "finnishdesignshop.com",
    "hm.com",
    "louispoulsen.com",
    "macys.com",
    "wayfair.de",
    "flos.com",
    "levellight.se",
    "nordiskagalleriet.se",
    "nordiskagalleriet.fi",
    "nordiskagalleriet.no",
    "nordiskagalleriet.dk",
    "lannamobler.se",
    "lanna.no",
    "lanna.fi",
)
PAGE_SIZES = {"homeroom.se": 58, "nordiskarum.se": 12, "trademax.se": 36}
SEARCH_URLS = {
    "amazon.de": "https://www.amazon.de/s?k=%s",
    "trademax.se": "https://www.trademax.se/search?q=%s",
}
SEARCH_LIMITS = {"amazon.de": 8}
# How a shop writes prices, SKUs and stock texts.
PRICE_STYLES = {
    "baldai1.lt": "euro_blank",
    "bernomobler.se": "blank_thousands_whole",
    "bygghemma.se": "digits",
    "connox.dk": "listed_price",
    "ebuy24.dk": "dot_thousands_whole",
    "ellos.se": "blank_thousands_whole",
    "gardenstore.se": "blank_thousands_whole",
    "gigameubel.nl": "dot_thousands",
    "homeroom.se": "blank_thousands_whole",
    "jensen-company.dk": "dot_thousands",
    "k-rauta.se": "single_number",
    "nordiskarum.se": "blank_thousands_whole",
    "trendrum.se": "digits",
    "wayfair.de": "amount_and_symbol",
}
SKU_STYLES = {"ebuy24.dk": "after_first_dash", "nordiskarum.se": "drop_label"}
AVAILABILITY_RULES = {
    "ebuy24.dk": "in_stock_mark",
    "k-rauta.se": "not_available",
    "nordiskarum.se": "in_stock_default",
    "amazon.de": "if_present",
    "andlight.dk": "in_stock_mark",
    "chilli.se": "if_present",
    "finnishdesignshop.com": "if_present",
    "finnishdesignshop.fi": "if_present",
    "furniturebox.se": "if_present",
    "gardenstore.se": "unless_present",
    "homeroom.se": "if_present",
    "jardindeco.com": "if_present",
    "nordlyliving.dk": "colour",
    "trademax.se": "if_present",
    "wayfair.de": "unless_present",
}
def default_registry() -> Registry:
    """Profiles, hooks and outcome rules of the known retailers."""
    from offerloom.operators.cascade import DISABLED_STRATEGIES
    from offerloom.operators.outcomes import DOMAIN_OUTCOMES
    from offerloom.operators.retailers import CARD_RECORDS, CARD_RULES, RECORDS, RULES

    registry = Registry()
    for domain in sorted({*CURRENCIES, *NO_FIXED_CURRENCY, *DISABLED_STRATEGIES}):
        registry.register_profile(
            Profile(
                domain,
                currency=CURRENCIES.get(domain),
                page_size=PAGE_SIZES.get(domain),
                product_url=PRODUCT_URL_PATTERNS.get(domain),
                search_url=SEARCH_URLS.get(domain),
                search_limit=SEARCH_LIMITS.get(domain),
                price_style=PRICE_STYLES.get(domain),
                sku_style=SKU_STYLES.get(domain),
                availability_rule=AVAILABILITY_RULES.get(domain),
                disabled_strategies=DISABLED_STRATEGIES.get(domain, ()),
                rules=RULES.get(domain, ()),
                records=RECORDS.get(domain, ()),
                card_rules=CARD_RULES.get(domain, ()),
                card_records=CARD_RECORDS.get(domain, ()),
            )
        )
    registry.register_canonical("amazon.de", _canonical_asin)
    registry.register_canonical("baldai1.lt", _without_redirect_mark)
    registry.register_finisher(
        "bygghemma.se", lambda df: {"variant_group_url": _group_url(F.col("url"))}
    )
    for domain, rules in DOMAIN_OUTCOMES.items():
        for predicate, label in rules:
            registry.register_rule(domain, predicate, label)
    return registry

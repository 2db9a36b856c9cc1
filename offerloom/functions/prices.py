"""Price and currency text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from offerloom.functions.text import WS, leading_integer, leading_number, trim_text

# Currency symbols and the default currency of a country.
SYMBOL_TO_CURRENCY = {"€": "EUR", "$": "USD", "£": "GBP"}
COUNTRY_TO_CURRENCY = {
    "se": "SEK",
    "dk": "DKK",
    "no": "NOK",
    "ch": "CHF",
    "fr": "EUR",
    "it": "EUR",
    "de": "EUR",
    "nl": "EUR",
    "be": "EUR",
}


def _lit(s: str) -> Column:
    return F.lit(s)


def _drop(c: Column, *parts: str) -> Column:
    for p in parts:
        c = F.replace(c, _lit(p), _lit(""))
    return c


def _count(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(_drop(c, ch))


def parse_price(c: Column) -> Column:
    """Price text -> DOUBLE, guessing which separator is the decimal one.

    Several equal separators are thousands marks. With one dot and one comma
    the later one is decimal. A lone separator followed by exactly three
    digits is a thousands mark, otherwise it is decimal.
    """
    # "kr." carries a dot that is no separator; only its first mention is cut.
    no_currency = F.regexp_replace(c, r"(?s)^(.*?)kr\.", "$1")
    digits = F.regexp_replace(no_currency, "[^0-9.,]", "")
    commas, dots = _count(digits, ","), _count(digits, ".")
    no_commas, no_dots = _drop(digits, ","), _drop(digits, ".")
    comma_is_point = F.translate(digits, ",", ".")
    grouped = F.length(F.regexp_extract(digits, "[.,](.*)$", 1)) == 3
    number = (
        F.when(commas > 1, no_commas)
        .when(dots > 1, F.translate(no_dots, ",", "."))
        .when(
            (commas == 1) & (dots == 1),
            F.when(
                F.instr(digits, ".") < F.instr(digits, ","),
                F.translate(no_dots, ",", "."),
            ).otherwise(no_commas),
        )
        .when((commas + dots == 1) & grouped, F.translate(digits, ".,", ""))
        .otherwise(comma_is_point)
    )
    return leading_number(number)


def parse_price_safe(c: Column) -> Column:
    """Machine-written price: a plain decimal is read as is."""
    return F.when(c.rlike(r"^[0-9]*\.?[0-9]+\z"), c.try_cast("double")).otherwise(
        parse_price(c)
    )


def _first_token(c: Column) -> Column:
    return F.element_at(F.split(trim_text(c), WS), 1)


def _point(c: Column) -> Column:
    return F.translate(c, ",", ".")


def _blankless(c: Column) -> Column:
    return F.regexp_replace(c, WS, "")


def _single_number(c: Column) -> Column:
    text = _drop(_point(c), " ")
    hits = F.regexp_extract_all(text, F.lit(r"([+-]?\d+(?:\.\d+)?)"), F.lit(1))
    return F.when(F.size(hits) == 1, F.element_at(hits, 1).try_cast("double"))


# One entry per way a shop writes its prices.
PRICE_STYLES: dict[str, Callable[[Column], Column]] = {
    # "1.295,00" -> 1295
    "dot_thousands": lambda c: leading_number(_first_token(_point(_drop(c, ".")))),
    # "2.789,00 DKK", "Før 2.789,00 DKK" -> 2789 (whole units)
    "dot_thousands_whole": lambda c: leading_integer(
        _first_token(_drop(_drop(c, "Før"), "."))
    ),
    # "49,95 kr/ par" -> 49.95; more than one number is no price
    "single_number": _single_number,
    # "1 643 kr" -> 1643
    "blank_thousands_kr": lambda c: leading_number(_drop(_blankless(c), "kr")),
    # "fr.1 455 kr", "1 455 SEK" -> 1455 (whole units)
    "blank_thousands_whole": lambda c: leading_integer(
        _drop(F.lower(_blankless(c)), "fr.", "kr", "sek")
    ),
    # "1 299,90 €" -> 1299.9
    "euro_blank": lambda c: leading_number(_point(_drop(_blankless(c), "€"))),
    # "UVP 2.729,50 DKK" -> 2729.5
    "listed_price": lambda c: leading_number(
        _point(_drop(_blankless(c), "DKK", "UVP", "."))
    ),
    # "1 295 kr inkl." -> 1295 (every digit counts)
    "digits": lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("double"),
    # "1.295,00" -> 1295 (decimals cut)
    "before_comma": lambda c: leading_number(
        _drop(trim_text(F.substring_index(c, ",", 1)), ".")
    ),
    # "1.519,99 €" -> 1519.99
    "amount_and_symbol": lambda c: leading_number(
        _first_token(_point(_drop(c, ".")))
    ),
}


def parse_price_as(c: Column, style: str) -> Column:
    return PRICE_STYLES[style](c)


def first_number(c: Column) -> Column:
    """First run of digits after blanks are removed, as BIGINT."""
    return F.regexp_extract(_drop(c, " "), r"\d+", 0).try_cast("bigint")


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def currency_iso(symbol: Column, country: Column | None = None) -> Column:
    """Symbol -> ISO code, else the currency of the country, else NULL."""
    by_symbol = _lookup(SYMBOL_TO_CURRENCY, symbol)
    if country is None:
        return by_symbol
    return F.coalesce(by_symbol, _lookup(COUNTRY_TO_CURRENCY, country))


def currency_token(c: Column, mode: str = "rest") -> Column:
    """Currency written inside a price text.

    ``rest``: what remains without digits, separators and blanks.
    ``first_word``: first run of letters or symbols, symbols as ISO code.
    ``capitals``: capitals and symbols only, symbols as ISO code.
    """
    if mode == "rest":
        return F.regexp_replace(c, "[0-9., ]", "")
    if mode == "first_word":
        word = F.nullif(F.regexp_extract(c, "[A-Za-z€$£]+", 0), F.lit(""))
        return F.coalesce(_lookup(SYMBOL_TO_CURRENCY, word), word)
    if mode == "capitals":
        kept = F.regexp_replace(c, "[^A-Z€£]", "")
        return F.replace(F.replace(kept, _lit("€"), _lit("EUR")), _lit("£"), _lit("GBP"))
    raise ValueError(f"unknown mode {mode!r}")


def currency_or(token: Column, fallback: Column) -> Column:
    """A token that is no three-letter code (nor UNKNOWN) yields the fallback."""
    usable = (F.length(token) == 3) | (token == "UNKNOWN")
    return F.when(usable, token).otherwise(fallback)


def to_minor_units(price: Column) -> Column:
    """Price -> minor units as BIGINT, halves up; zero and NULL stay."""
    return F.floor(price * 100 + 0.5).cast("bigint")

import pytest
from pyspark.sql import functions as F, types as T

from offerloom import functions as fn
from offerloom.functions import urls

c = F.col


def rendered(amount, thousands, decimals, unit):
    """An amount as a shop might write it."""
    whole, cents = f"{amount:,.2f}".split(".")
    return unit.format(whole.replace(",", thousands) + (decimals + cents if decimals else ""))


@pytest.mark.parametrize("unit", ["{}", "EUR {}", "{} kr.", "  {}\u00a0€ "])
@pytest.mark.parametrize("thousands, decimals", [(",", "."), (".", ","), (" ", ",")])
@pytest.mark.parametrize("amount", [0.35, 7.5, 918.25, 41_807.6, 3_650_912.4])
def test_parse_price_reads_what_shops_write(value, amount, thousands, decimals, unit):
    assert value(fn.parse_price(c("s")), s=rendered(amount, thousands, decimals, unit)) == amount


@pytest.mark.parametrize("amount", [8_000.0, 61_300.0, 7_004_009.0])
@pytest.mark.parametrize("thousands", [",", ".", " "])
def test_parse_price_reads_whole_amounts(value, amount, thousands):
    assert value(fn.parse_price(c("s")), s=rendered(amount, thousands, "", "{}")) == amount


def test_parse_price_without_number(value):
    for text in ("", "ask us", "-"):
        assert value(fn.parse_price(c("s")), s=text) is None


@pytest.mark.parametrize(
    "text, expected", [("2.456", 2.456), ("12", 12.0), (".5", 0.5), ("2.456 kr", 2456.0)]
)
def test_parse_price_safe(value, text, expected):
    assert value(fn.parse_price_safe(c("s")), s=text) == expected


@pytest.mark.parametrize(
    "style, text, expected",
    [
        ("dot_thousands", "1.295,00", 1295.0),
        ("dot_thousands", "160,20", 160.2),
        ("dot_thousands", "4.525,00 kr.", 4525.0),
        ("dot_thousands_whole", "2.789,00 DKK", 2789.0),
        ("dot_thousands_whole", "Før 2.789,00 DKK", 2789.0),
        ("single_number", "49,95 kr/ par", 49.95),
        ("single_number", "2 för 50", None),
        ("blank_thousands_kr", "1 643 kr", 1643.0),
        ("blank_thousands_whole", "fr.1 455 kr", 1455.0),
        ("blank_thousands_whole", "1 455 SEK", 1455.0),
        ("euro_blank", "1 299,90 €", 1299.9),
        ("listed_price", "UVP 2.729,50 DKK", 2729.5),
        ("digits", "kr 1 295,-", 1295.0),
        ("before_comma", "1.295,00", 1295.0),
        ("amount_and_symbol", "1.519,99 €", 1519.99),
    ],
)
def test_price_styles(value, style, text, expected):
    assert value(fn.parse_price_as(c("s"), style), s=text) == expected


@pytest.mark.parametrize("before", ["", "/-/en", "/Blue-Lamp-12"])
@pytest.mark.parametrize("after", ["", "/", "?th=1", "/ref=abc?x=1&y=2"])
def test_asin_is_what_follows_dp(value, before, after):
    assert value(fn.product_id(c("s"), "asin"), s=f"https://www.amazon.fr{before}/dp/B0TESTID42{after}") == "B0TESTID42"


def test_asin_needs_a_product_page(value):
    assert value(fn.product_id(c("s"), "asin"), s="https://www.amazon.fr/stores/lamps") is None


def test_product_ids(value):
    assert value(fn.product_id(c("s"), "productpage"), s="https://www2.hm.com/de_de/productpage.1219517001.html") == "1219517001"
    assert value(fn.product_id(c("s"), "piid"), s="https://x.de/pdp/a-d1.html?a=1&piid=1033586268%2C1033586259") == "1033586268,1033586259"
    assert value(fn.product_id(c("s"), "query_suffix"), s="https://x.com/p?v-9001&x=1") == "9001"


@pytest.mark.parametrize(
    "style, text, expected",
    [
        ("after_article_label", "Fin stol\nArtikelnummer: 165-01 \nmer", "165-01"),
        ("after_article_label", "Fin stol", None),
        ("after_colon", "Artikelnummer: 1705327-01-24", "1705327-01-24"),
        ("after_colon", "1705327", None),
        ("after_first_dash", " 11-GR2-3 ", "GR2-3"),
        ("after_first_dash", "GR", None),
        ("cut_country", "0123USA", "0123"),
        ("drop_label", "Artikelnummer: 12 ", "12"),
    ],
)
def test_sku(value, style, text, expected):
    assert value(fn.sku_of(c("s"), style), s=text) == expected


@pytest.mark.parametrize(
    "style, text, expected",
    [
        ("drop_vd", "VD115009-092", "115009-092"),
        ("drop_vd", "VD51074-320-340x240-cm", "51074-320"),
        ("drop_vd", "X1", None),
        ("drop_m_prefix", "M131-GR456", "GR456"),
        ("drop_two", "AB123", "123"),
        ("same", "A", "A"),
    ],
)
def test_mpn(value, style, text, expected):
    assert value(fn.mpn_of(c("s"), style), s=text) == expected


@pytest.mark.parametrize("brand", ["Nordal Form", "Acme"])
@pytest.mark.parametrize("shape", ["{} eget lager", "{} - eget lager", "Eget lager - {}", "EGET LAGER - {}"])
def test_brand_loses_the_stock_note(value, brand, shape):
    assert value(fn.clean_brand(c("s")), s=shape.format(brand)) == brand


@pytest.mark.parametrize(
    "url, base, expected",
    [
        ("/a/b", "https://Shop.SE/x/y?q=1#f", "https://shop.se/a/b"),
        ("b", "https://shop.se/x/y?q=1", "https://shop.se/x/b"),
        ("b", "https://shop.se", "https://shop.se/b"),
        ("../b", "https://shop.se/x/y/z", "https://shop.se/x/b"),
        ("./", "https://shop.se/x/y/z", "https://shop.se/x/y/"),
        ("../../../b", "https://shop.se/x/y", "https://shop.se/b"),
        ("?p=2", "https://shop.se/x?q=1", "https://shop.se/x?p=2"),
        ("#t", "https://shop.se/x?q=1#a", "https://shop.se/x?q=1#t"),
        ("//cdn.se/i.jpg", "https://shop.se/x", "https://cdn.se/i.jpg"),
        ("HTTPS://A.se:443", None, "https://a.se/"),
        ("http://a.se:443/x", None, "http://a.se:443/x"),
        ("https://a.se/möbler/stol 1?f=blå", None, "https://a.se/m%C3%B6bler/stol%201?f=bl%C3%A5"),
        ("https://a.se/m%C3%B6b+ler", None, "https://a.se/m%C3%B6b+ler"),
        ("mailto:x@y.se", "https://shop.se/", "mailto:x@y.se"),
        ("/a", "nonsense", None),
    ],
)
def test_normalise(value, url, base, expected):
    got = value(fn.normalise_url(c("u"), None if base is None else c("b")), u=url, b=base)
    assert got == expected


def test_comparable(value):
    assert value(fn.comparable_url(c("u")), u="https://a.se/m%C3%B6+b//") == "https://a.se/mö+b"
    assert value(fn.comparable_url(c("u")), u="https://a.se/%zz/") == "https://a.se/%zz/"


@pytest.mark.parametrize(
    "cur, test, expected",
    [
        ("https://a.se/x?b=2&a=1", "https://a.se/x", True),
        ("https://a.se/x?b=2&a=1", "https://a.se/x?a=1", True),
        ("https://a.se/x?b=2&a=1", "/x?a=1&b=2", True),
        ("https://a.se/x?b=2&a=1", "/x?a=2", False),
        ("https://a.se/x?b=2", "https://a.se/y", False),
        ("https://a.se/x?b=2", "https://a.se/x?c=1", False),
    ],
)
def test_url_included(value, cur, test, expected):
    assert value(fn.url_included(c("a"), c("b")), a=cur, b=test) is expected


def test_currency(value):
    assert value(fn.currency_iso(c("s")), s="€") == "EUR"
    assert value(fn.currency_iso(c("s"), F.lit("se")), s="kr") == "SEK"
    assert value(fn.currency_iso(c("s"), F.lit("xx")), s="kr") is None
    assert value(fn.currency_token(c("s")), s="1 299.00 SEK") == "SEK"
    assert value(fn.currency_token(c("s"), "first_word"), s="12 € st") == "EUR"
    assert value(fn.currency_token(c("s"), "capitals"), s="ab 12 £") == "GBP"
    assert value(fn.currency_or(c("s"), F.lit("SEK")), s="kr") == "SEK"
    assert value(fn.currency_or(c("s"), F.lit("SEK")), s="UNKNOWN") == "UNKNOWN"


def test_small_helpers(value):
    assert value(fn.first_number(c("s")), s="EAN code : 73501 33233787") == 7350133233787
    assert value(fn.first_number(c("s")), s="none") is None
    assert value(fn.squash(c("s")), s="  a \n  b ") == "a b"
    assert value(fn.stars(c("s")), s="width:80%;") == 4.0
    assert value(fn.clean_gtin(c("s")), s="1234567") is None
    assert value(fn.clean_gtin(c("s")), s="12345678") == "12345678"
    assert value(fn.country_of(c("s")), s="shop.dk") == "dk"
    assert value(fn.clean_image(c("s"), "scheme"), s="//i.se/a.jpg?w=1") == "https://i.se/a.jpg"
    assert value(fn.clean_image(c("s"), "thumbnail"), s="https://i/_thumbs/1.w60.h60.crop.jpg") == "https://i/1.jpg"
    assert value(fn.to_minor_units(c("p")), p=19.995) == 2000
    assert value(fn.is_product_url(c("u"), F.lit("bygghemma.se")), u="https://bygghemma.se/p-12") is True
    assert value(fn.is_brand_url(c("u")), u="https://x.se/brand/a") is True


def test_falsy(value):
    assert value(fn.falsy_to_null(c("s"), T.StringType()), s="") is None
    assert value(fn.falsy_to_null(c("s"), T.DoubleType()), s=0.0) is None
    assert value(fn.falsy_to_null(c("s"), T.LongType()), s=0) is None
    assert value(fn.falsy_to_null(c("s") == 1, T.BooleanType()), s=2) is None
    assert value(fn.falsy_to_null(c("s"), T.ArrayType(T.StringType())), s=[]) == []


BASE = "https://shop.example.se/a/b/c?d=1"
PLAIN_RELATIVE = {
    "//cdn.example.se/s/1": "https://cdn.example.se/s/1",
    "../p/1": "https://shop.example.se/a/p/1",
    "x.html?a=b/c": "https://shop.example.se/a/b/x.html?a=b/c",
    "p/2#top": "https://shop.example.se/a/b/p/2#top",
}


@pytest.mark.parametrize("url", PLAIN_RELATIVE)
def test_plain_relative_forms_are_resolved_without_rewriting(value, monkeypatch, url):
    monkeypatch.setattr(urls, "_rewrite", lambda u: F.lit("rewritten"))
    assert value(urls.normalise_url(F.col("u"), F.col("b")), u=url, b=BASE) == PLAIN_RELATIVE[url]


@pytest.mark.parametrize(
    "url, base, expected",
    [
        ("../p", "https://a.se/x", "https://a.se/p"),
        ("../p", "https://a.se//x/", "https://a.se//p"),
        ("../../p", BASE, "https://shop.example.se/p"),
        ("x:y", BASE, "x:y"),
        ("a.b:y", BASE, "a.b:y"),
        ("//A.se:443/x", BASE, "https://a.se/x"),
        ("x/../y", BASE, "https://shop.example.se/a/b/y"),
        ("p", "https://a.se", "https://a.se/p"),
        ("p", "https://a.se?q=/z/", "https://a.se/p"),
        ("p", "/x", None),
    ],
)
def test_other_relative_forms(value, url, base, expected):
    assert value(urls.normalise_url(F.col("u"), F.col("b")), u=url, b=base) == expected

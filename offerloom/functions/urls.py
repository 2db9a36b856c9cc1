"""URL functions built from Spark expressions, without a URL library."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Country suffixes the domain rule knows.
KNOWN_COUNTRIES = ("se", "dk", "ch", "fr", "it", "de", "no", "nl", "be")

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
# Addresses, paths and origins that are written the browser's way already.
_SAFE = r"[\x21\x23-\x3B\x3D\x3F-\x5B\x5D-\x5F\x61-\x7A\x7C\x7E]"
_CLEAN = rf"^https?://[a-z0-9.\-]+/{_SAFE}*\z"
_CLEAN_ROOTED = rf"^/(?!/){_SAFE}*\z"
_CLEAN_HOSTED = rf"^//[a-z0-9.\-]+/{_SAFE}*\z"
_CLEAN_BESIDE = rf"^[a-zA-Z0-9_~\-]+(?:\.[a-zA-Z0-9_~\-]+)*(?:[/?#]{_SAFE}*)?\z"
_CLEAN_ABOVE = rf"^\.\./[a-zA-Z0-9_~\-]+(?:/[a-zA-Z0-9_~\-]+)*\z"
_DEEP = r"^https?://[^/?#]+(?:/[^/?#]+)+/[^/?#]*(?:[?#]|\z)"
_CLEAN_ORIGIN = r"^https?://[a-z0-9.\-]+(?:[/?#]|\z)"
# Characters a browser escapes when it writes a URL out.
_UNSAFE = r"\x00-\x20\"<>`{}\x7F-\uFFFF\x{10000}-\x{10FFFF}"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def domain_of(url: Column) -> Column:
    """Lower-case host without ``www.`` and ``www2.``; NULL without a host."""
    host = F.regexp_extract(
        url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1
    )
    bare = F.regexp_replace(
        F.regexp_replace(F.lower(host), r"^www\.", ""), r"^www2\.", ""
    )
    return F.nullif(bare, F.lit(""))


def country_of(domain: Column) -> Column:
    suffix = F.substring_index(domain, ".", -1)
    return F.when(suffix.isin(*KNOWN_COUNTRIES), suffix)


def origin_of(url: Column) -> Column:
    """``scheme://host[:port]``."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def is_brand_url(url: Column) -> Column:
    return F.contains(url, F.lit("/brand"))


def _escape(url: Column) -> Column:
    """Percent-encode unsafe characters, run by run."""
    runs = F.regexp_extract_all(
        url, F.lit(f"(?s)([{_UNSAFE}]+|[^{_UNSAFE}]+)"), F.lit(1)
    )
    coded = F.transform(
        runs,
        lambda r: F.when(
            r.rlike(f"^[{_UNSAFE}]"),
            F.replace(F.url_encode(r), F.lit("+"), F.lit("%20")),
        ).otherwise(r),
    )
    return F.when(url.rlike(f"[{_UNSAFE}]"), F.array_join(coded, "")).otherwise(url)


def _fold_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments of a path that starts with ``/``."""
    parts = F.split(path, "/")
    segments = F.slice(parts, F.lit(2), F.size(parts))
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segments,
        empty,
        lambda acc, s: F.when(
            s == "..",
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
        )
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(segments, -1)
    closed = F.when(
        last.isin(".", "..") & (F.size(folded) > 0), F.lit("/")
    ).otherwise(F.lit(""))
    return F.when(
        path.rlike(r"/\.{1,2}(/|\z)"),
        F.concat(F.lit("/"), F.array_join(folded, "/"), closed),
    ).otherwise(path)


def normalise_url(url: Column, base: Column | None = None) -> Column:
    """Absolute URL as a browser writes it.

    Relative forms are resolved against ``base``; scheme and host become
    lower case, a default port goes away, dot segments are folded and unsafe
    characters are percent-encoded. URLs of other schemes stay as they are.
    NULL when neither the URL nor the base is absolute.
    """
    trimmed = F.when(
        url.rlike(r"[\x00-\x20]"),
        F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]", ""),
    ).otherwise(url)

    def absolute(u: Column) -> Column:
        if base is None:
            return F.when(u.rlike(_SCHEME), u)
        return F.when(u.rlike(_SCHEME), u).otherwise(
            let(origin_of(base), lambda origin: _joined(u, base, origin))
        )

    # most links need no work beyond a few pattern tests
    no_dots = ~F.contains(url, F.lit("/."))
    quick = F.when(no_dots & url.rlike(_CLEAN), url)
    if base is not None:
        quick = quick.when(
            no_dots & url.rlike(_CLEAN_ROOTED) & base.rlike(_CLEAN_ORIGIN),
            F.concat(F.regexp_extract(base, r"^https?://[^/?#]+", 0), url),
        )
        quick = quick.when(
            no_dots & url.rlike(_CLEAN_HOSTED) & base.rlike(_CLEAN_ORIGIN), F.concat(F.substring_index(base, "//", 1), url)
        )
        # a name, or one folder up, from a page whose path is clean and at least that deep
        clean_base = base.rlike(_CLEAN) & ~F.contains(base, F.lit("/.")) & ~F.contains(base, F.lit("//."))
        quick = quick.when(
            no_dots & url.rlike(_CLEAN_BESIDE) & clean_base,
            F.concat(F.regexp_extract(base, r"^https?://[^?#]*/(?=[^/?#]*(?:[?#]|\z))", 0), url),
        )
        quick = quick.when(
            url.rlike(_CLEAN_ABOVE) & clean_base & base.rlike(_DEEP),
            F.concat(F.regexp_extract(base, r"^(https?://[^?#]*/)[^/?#]*/[^/?#]*(?:[?#]|\z)", 1), F.substring(url, 4, 2**31 - 1)),
        )
    return quick.otherwise(let(let(trimmed, absolute), _rewrite))


def _joined(u: Column, base: Column, origin: Column) -> Column:
    """A relative URL below the page URL ``base``; NULL for a base without a
    host."""
    no_fragment = F.substring_index(base, "#", 1)
    no_query = strip_query(no_fragment)
    folder = F.coalesce(
        F.nullif(F.regexp_extract(no_query, r"^([^:/]*://[^/]+/(?:.*/)?)", 1), F.lit("")),
        F.concat(origin, F.lit("/")),
    )

    def starts(text: str) -> Column:
        return F.startswith(u, F.lit(text))

    joined = (
        F.when(starts("//"), F.concat(F.substring_index(base, ":", 1), F.lit(":"), u))
        .when(starts("/"), F.concat(origin, u))
        .when(starts("?"), F.concat(no_query, u))
        .when(starts("#") | (u == ""), F.concat(no_fragment, u))
        .otherwise(F.concat(folder, u))
    )
    return F.when(origin != "", joined)


# scheme, host[:port], path, query and fragment of a web address
_WEB = r"(?s)^(?i:(https?))://([^/?#\\]+)([^?#]*)([?#].*)?$"


def _rewrite(url: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(url, _WEB, i)

    scheme = F.lower(part(1))
    own_port = F.when(scheme == "http", F.lit(":80")).otherwise(F.lit(":443"))
    host = F.regexp_replace(F.lower(part(2)), ":$", "")
    host = F.when(
        F.endswith(host, own_port), F.substring_index(host, ":", 1)
    ).otherwise(host)
    path = F.translate(part(3), "\\", "/")
    path = F.when(path == "", F.lit("/")).otherwise(let(path, _fold_dots))
    whole = F.concat(scheme, F.lit("://"), host, path, part(4))
    return F.when(url.rlike(_WEB), let(whole, _escape)).otherwise(url)


def absolute_if_rooted(url: Column, page_url: Column) -> Column:
    """Only URLs that start with ``/`` are resolved; others stay as given."""
    return F.when(
        F.startswith(url, F.lit("/")), normalise_url(url, page_url)
    ).otherwise(url)


def comparable_url(url: Column) -> Column:
    """Percent-decoded without trailing slashes; unchanged if not decodable."""
    decoded = F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))
    broken = decoded.isNull() | (
        F.contains(decoded, F.lit("\ufffd")) & ~F.contains(url, F.lit("\ufffd"))
    )
    return F.when(broken, url).otherwise(F.regexp_replace(decoded, r"/+$", ""))


def _query_pairs(url: Column) -> Column:
    """Decoded query parameters as ``array<struct<k, v>>`` in order."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p != "")

    def pair(p: Column) -> Column:
        key = F.substring_index(p, "=", 1)
        value = F.when(
            F.contains(p, F.lit("=")), F.regexp_extract(p, "(?s)=(.*)$", 1)
        ).otherwise(F.lit(""))
        return F.struct(
            F.coalesce(F.try_url_decode(key), key).alias("k"),
            F.coalesce(F.try_url_decode(value), value).alias("v"),
        )

    return F.transform(parts, pair)


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter, decoded."""
    hits = F.filter(_query_pairs(url), lambda p: p["k"] == name)
    return F.try_element_at(hits, F.lit(1))["v"]


def url_included(current: Column, test: Column) -> Column:
    """Is ``test`` a substring of ``current``, or the same page with a subset
    of its query parameters (in any order)?"""
    full = F.when(
        F.startswith(test, F.lit("/")), F.concat(origin_of(current), test)
    ).otherwise(test)
    have = _query_pairs(current)
    covered = F.forall(
        _query_pairs(full),
        lambda p: F.coalesce(
            F.try_element_at(F.filter(have, lambda h: h["k"] == p["k"]), F.lit(-1))["v"]
            == F.nullif(p["v"], F.lit("")),
            F.lit(False),
        ),
    )
    same_page = strip_query(current) == strip_query(full)
    return F.coalesce(
        F.contains(current, test) | (same_page & covered), F.lit(False)
    )


# How a product page URL looks, per domain.
PRODUCT_URL_PATTERNS = {
    "trademax.se": r"p\d+",
    "chilli.se": r"p\d+",
    "furniturebox.se": r"p\d+",
    "bygghemma.se": r"p-\d+",
}


def is_product_url(url: Column, domain: Column, patterns: dict[str, str] | None = None) -> Column:
    """URL pattern test of the domain; NULL for domains without a pattern."""
    table = PRODUCT_URL_PATTERNS if patterns is None else patterns
    out = F.lit(None).cast("boolean")
    for name, pattern in table.items():
        out = F.when(domain == name, url.rlike(pattern)).otherwise(out)
    return out


def clean_image(url: Column, mode: str = "query") -> Column:
    """Image URL clean-up: ``query`` cuts parameters, ``scheme`` also completes
    ``//host`` URLs, ``thumbnail`` removes resize marks."""
    if mode == "thumbnail":
        c = F.replace(url, F.lit(".w60.h60.crop"), F.lit(""))
        return F.replace(c, F.lit("/_thumbs"), F.lit(""))
    cut = strip_query(url)
    if mode == "query":
        return cut
    if mode == "scheme":
        return F.when(
            F.startswith(cut, F.lit("//")), F.concat(F.lit("https:"), cut)
        ).otherwise(cut)
    raise ValueError(f"unknown mode {mode!r}")

"""URL rules and exact membership against sets."""

import random

import pytest

from offerloom.llm.queries import URL_RULES
from offerloom.llm.urls import judge_urls

URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=1", "https://www.example.org/en/2#/en/1", "http://x.net/p?://y",
    "http://sub.z.com/fr/", "http://z.com/de/", "http://z.com/de", "http://com/fr/a", "http://notcom/fr/a", "http://org",
    "no scheme", "", None, "x://", "://h/p", "http://É.Net/Ä", "http://org?/", "http://a.b.c.d.bad.net/q", "http://bad.net",
]


def brute(url, listed):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    parts = host.split(".")
    hit = bool(host) and bool({host, host + path, ".".join(parts[-2:]), ".".join(parts[-3:])} & listed)
    if fits:
        return host, path, max(fits)[1], max(fits)[2], hit
    return host, path, None, "block" if hit else "allow", hit


@pytest.mark.parametrize("keys", [10_000, 0])  # the cascade, and the join beyond its bound
def test_equals_sets(spark, keys):
    rng = random.Random(3)
    urls = URLS + [f"http://h{rng.randrange(400)}.net/{rng.randrange(9)}" for _ in range(1500)]
    listed = {"bad.net", "x.net/p", "absent.net", "z.com/de/"} | {f"h{i}.net" for i in range(0, 400, 7)}
    listed |= {f"h{i}.net/3" for i in range(0, 400, 3)}
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, "x"), (0, urls[0], "x")],
                                  "page_id long, url string, key string")
    keyed = spark.createDataFrame([(k,) for k in listed] + [(None,), ("bad.net",)], "key string")
    got = judge_urls(pages, URL_RULES, keyed, keys=keys).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert tuple(r)[1:] == brute(None if r.page_id is None else urls[r.page_id], listed)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    keys = spark.createDataFrame([], "key string")
    assert judge_urls(none, [], keys).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert tuple(judge_urls(one, [], keys).first()) == (1, "a.b", "/c", None, "allow", False)

"""Operators on small fixtures, against brute force where order or skew matters."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from offerloom import plans, sinks, streaming
from offerloom.operators import elements as el, fields as fd, links as lk, listings as ls
from offerloom.operators import offers as of, outcomes as oc, reports as rp, variants as va
from offerloom.operators.profiles import Profile, Registry, Rule, default_registry
from offerloom.operators.ranking import first_per_key, number_rows


def brute_ranks(cards):
    seen, counts = {}, {}
    for run, page, pos, url in sorted(cards):
        if (run, url) not in seen:
            counts[run] = counts.get(run, 0) + 1
            seen[run, url] = counts[run]
    return seen


def random_cards(n=3000, hot=0.6):
    rng = random.Random(7)
    return [
        (1 if rng.random() < hot else rng.randint(2, 9), rng.choice([0, 1, 255, 256, 300, 5000, 2**21, 2**30]) + rng.randint(0, 3), rng.randint(1, 30), f"u{rng.randint(0, 400)}")
        for _ in range(n)
    ]


CARDS = "run bigint, page_number bigint, position bigint, url string"


def test_popularity_rank_with_a_hot_run(spark):
    cards = random_cards()
    rows = ls.popularity_rank(spark.createDataFrame(cards, CARDS)).collect()
    assert {(r.run, r.url): r.popularity_index for r in rows} == brute_ranks(cards)


def test_rank_keeps_card_fields_of_first_sight(spark):
    cards = [(*c, f"n{i}") for i, c in enumerate(random_cards(500))]
    df = spark.createDataFrame(cards, CARDS + ", name string")
    rows = ls.popularity_rank(df).collect()
    assert {(r.run, r.url): r.popularity_index for r in rows} == brute_ranks([c[:4] for c in cards])
    first = {}
    for run, page, pos, url, name in sorted(cards):
        first.setdefault((run, url), name)
    assert {(r.run, r.url): r.name for r in rows} == first


def test_rank_range_is_checked(spark):
    df = spark.createDataFrame([(1, 2**50, 1, "a")], CARDS)
    with pytest.raises(Exception, match="out of range"):
        ls.popularity_rank(df).collect()


def test_number_rows_small_cuts(spark):
    rng = random.Random(3)
    data = [(rng.choice("aab"), rng.randint(-50, 5000), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, c bigint, t bigint")
    rows = number_rows(df, ["g"], "c", ["t"], "n", width_bits=2, block_bits=3).collect()
    want, counts = {}, {}
    for g, c, t in sorted(data):
        counts[g] = counts.get(g, 0) + 1
        want[t] = counts[g]
    assert {r.t: r.n for r in rows} == want


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], ["o"]).collect()) == [("a", 1, "y"), ("b", 5, "z")]


def test_messages_split_and_keep_order(spark):
    rows = [(j, f"u{i}", i) for j, n in ((1, 2350), (2, 1000), (3, 1)) for i in range(1, n + 1)]
    rows.append((3, "late", None))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "job_id bigint, url string, popularity_index bigint")
    got = {(r.job_id, r.part): json.loads(r.payload) for r in sinks.to_messages(df, "popularity_index", ["url"]).collect()}
    assert sorted((k, len(v["productListings"])) for k, v in got.items()) == [
        ((1, 0), 1000), ((1, 1), 1000), ((1, 2), 350), ((2, 0), 1000), ((3, 0), 2)
    ]
    for job, n in ((1, 2350), (2, 1000)):
        urls = [x["url"] for (j, _), v in sorted(got.items()) if j == job for x in v["productListings"]]
        assert urls == [f"u{i}" for i in range(1, n + 1)]
    assert [x["url"] for x in got[3, 0]["productListings"]] == ["u1", "late"]
    assert got[1, 0]["jobContext"] == {"jobId": 1}


def brute_grid(sizes):
    used = list(itertools.takewhile(lambda s: s > 0, sizes))
    return [list(x) for x in itertools.product(*map(range, used))]


@pytest.mark.parametrize("sizes", [[], [3], [2, 3], [3, 1, 2], [2, 0, 4], [0, 2]])
def test_variant_grid(spark, sizes):
    df = spark.createDataFrame([(sizes,)], "option_counts array<int>")
    rows = va.variant_grid(df).orderBy("variant").collect()
    assert [r.options for r in rows] == brute_grid(sizes)
    assert [r.variant for r in rows] == list(range(len(rows)))


def test_variant_grid_with_invalid_prefixes(spark):
    df = spark.createDataFrame([([2, 2, 2], [[0], [1, 1]])], "option_counts array<int>, bad array<array<int>>")
    rows = va.variant_grid(df, invalid="bad", limit=5).collect()
    assert [(r.variant, r.options) for r in rows] == [(0, [1, 0, 0]), (1, [1, 0, 1])]


def test_good_and_bad_are_the_input(spark):
    data = [("a", "SEK"), ("", "SEK"), (None, "EUR"), ("b", "kr"), ("c", "unknown"), ("d", None), ("e", "")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "id int, name string, currency string")
    good, bad = of.validate_offer(df)
    assert sorted(r.id for r in good.collect()) == [0, 4, 5, 6]
    assert sorted(r.id for r in bad.collect()) == [1, 2, 3]


def test_merge_prefers_present_values(spark):
    pages = spark.createDataFrame([(1, None, 1000.0, None), (2, "Group", None, "SEK"), (3, "", 0.0, "")], "k int, name string, price double, currency string")
    listing = spark.createDataFrame([(1, "Table", None), (2, "Table", 5.0), (3, "", 0.0)], "k int, name string, price double")
    rows = {r.k: (r.name, r.price, r.currency) for r in of.merge_offer(pages, listing, "k").collect()}
    assert rows == {1: ("Table", 1000.0, None), 2: ("Group", 5.0, "SEK"), 3: ("", 0.0, "")}


@pytest.mark.parametrize("article, end", [("7-8", ""), ("7-8", "/"), ("7", ""), ("1200345-99", "")])
def test_variant_group_url(value, article, end):
    """The group is the page of the first number."""
    base = "https://www.bygghemma.se/lamps/desk/p-"
    assert value(of.variant_group_url(F.col("u")), u=base + article + end) == base + article.split("-")[0]


def test_canonical_url_rejects(spark):
    registry = default_registry()
    page = "https://www.amazon.de/-/en/dp/B0TESTID77"
    raw = [(u, page) for u in ("https://www.amazon.de/dp/B0TESTID77", "https://www.amazon.de/x-y-z/dp/B0TESTID77?a=1")]
    raw += [(u, None) for u in ("https://www.amazon.de/stores/lamps", "https://www.amazon.de/")]
    raw += [("https://lamps.example/stores/lamps", "https://lamps.example/stores/lamps")]
    raw += [("https://baldai1.lt/sofa/?redirect=301", "https://baldai1.lt/sofa"), ("https://baldai1.lt/sofa/", "https://baldai1.lt/sofa/")]
    df = spark.createDataFrame([(u,) for u, _ in raw], "url string")
    from offerloom.functions import domain_of

    got = df.select(registry.apply_canonical(F.col("url"), domain_of(F.col("url")))).collect()
    assert [r[0] for r in got] == [w for _, w in raw]


def test_rules_of_a_known_shop(spark):
    html = (
        '<div class="product-page__top-info"><a class="product-heading__brand-name"> Acme </a>'
        '<h1 class="product-heading__product-name">Saw</h1></div><div class="price-view--large x">'
        '<span class="price-view__sale-price-container">49,95 kr/ st</span></div>'
    )
    df = spark.createDataFrame([("https://www.k-rauta.se/p/1", html), ("https://www.k-rauta.se/p/2", "<p>x</p>")], "url string, html string")
    rows = {r.url[-1]: r for r in fd.rule_extract(df, default_registry().rules_frame(spark)).collect()}
    assert rows["1"].fields == {"brand": "Acme", "name": "Saw", "price_text": "49,95 kr/ st"}
    assert rows["1"].missing == []
    assert sorted(rows["2"].missing) == ["name", "price_text"]


def test_rules_prefer_lower_rank_and_attributes(spark):
    registry = Registry()
    registry.register_profile(
        Profile("a.se", rules=(Rule("x", tag="b", rank=1), Rule("x", tag="i", rank=0), Rule("img", attr="data-src", take="data-src", cleanup="cut_query")))
    )
    df = spark.createDataFrame([("https://a.se/", "<b>1</b><i>2</i><img data-src='u.jpg?w=1'>")], "url string, html string")
    assert fd.rule_extract(df, registry.rules_frame(spark)).first().fields == {"img": "u.jpg", "x": "2"}


def test_homepage_links_ignore_sections(spark):
    html = "<header><a href='/h'>h</a><nav><a href='/n'>n</a></nav></header><a href='/a'></a><A HREF=\"/a\"></A><a name=x></a><a href='#'>t</a><a href='/b'></a><a href='/a'></a><footer><a href='/f'></a></footer>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = lk.drop_consecutive_dups(lk.homepage_links(df), ["page_id"])
    assert [r.href for r in found.orderBy("pos").collect()] == ["/a", "/b", "/a"]


def test_frontier(spark):
    new = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("c", 9)], "unique_key string, pos int")
    known = spark.createDataFrame([("b",), ("b",)], "unique_key string")
    assert sorted(tuple(r) for r in lk.dedupe_frontier(new, known).collect()) == [("a", 1), ("c", 9)]


def test_discount_and_reviews(value):
    d = fd.discount_from_list(F.array(F.lit(5.0), F.lit(3.0)))
    assert value(d)[:3] == (3.0, 5.0, True)
    assert value(fd.discount_from_list(F.array(F.lit(5.0))))[:3] == (5.0, None, False)
    assert value(fd.discount_from_list(F.array(*[F.lit(1.0)] * 3)))[3] == "Cannot extract price"
    assert value(fd.reviews(F.lit(0), F.lit(4.0))) is None
    assert value(fd.reviews(F.lit(3), F.lit(4.5)))[:2] == (3, 4.5)
    assert value(fd.review_count(F.lit("(1,234 ratings)"))) == 1234


def test_classify_default_and_domain_rules(spark):
    rows = [
        (1, "https://x.se/", 404, ""),
        (2, "https://x.se/", 429, ""),
        (3, "https://www.wayfair.de/pdp/a", 429, ""),
        (4, "https://www.wayfair.de/blocked.php", 200, ""),
        (5, "https://www.wayfair.de/", 200, ""),
        (6, "https://www.wayfair.de/pdp/a", 200, "<div class='px-captcha-error-container'>"),
        (7, "https://norliving.dk/a", 200, "<title> 404 Ikke fundet </title>"),
        (8, "https://www.trademax.se/a-p12", 200, None),
    ]
    df = spark.createDataFrame(rows, "id int, url string, status int, html string")
    got = {r.id: r.error for r in oc.classify_pages(df).collect()}
    assert got == {
        1: "PageNotFoundError", 2: None, 3: "CaptchaEncounteredError", 4: "GotBlockedError",
        5: "PageNotFoundError", 6: "CaptchaEncounteredError", 7: "PageNotFoundError", 8: None,
    }


def test_coverage_counts_repeated_requests(spark):
    asked = spark.createDataFrame([("https://a.se/1",), ("https://a.se/1",), ("https://a.se/2",), ("https://b.se/1",)], "url string")
    found = spark.createDataFrame([("https://a.se/2#x", "https://a.se/2"), ("https://c.se/1", None)], "url string, variant_group_url string")
    rows = {r.domain: (r.n_urls, r.n_products_found, r.n_products_not_found) for r in rp.coverage(asked, found).collect()}
    assert rows == {"a.se": (3, 1, 2), "b.se": (1, 0, 1)}


def test_dump_and_table_are_idempotent_on_empty_input(spark, tmp_path):
    df = spark.createDataFrame([], "url string, name string")
    sinks.write_offers(df, str(tmp_path / "t"), "job")
    assert spark.read.schema("url string").parquet(str(tmp_path / "t")).count() == 0


def test_stream_popularity_restarts(spark, tmp_path):
    """Ranks carry on when the stream is stopped and started again."""
    cards = sorted(random_cards(600))
    parts = [cards[:200], cards[200:400], cards[400:]]
    paths = {k: str(tmp_path / k) for k in ("in", "out", "cp")}
    for part in parts:
        spark.createDataFrame(part, CARDS).coalesce(1).write.mode("append").parquet(paths["in"])
        source = spark.readStream.schema(CARDS).parquet(paths["in"])
        streaming.stream_popularity(source, paths["out"], paths["cp"]).awaitTermination()
    rows = spark.read.parquet(paths["out"] + "/ranks").collect()
    got = {(r.run, r.url): r.popularity_index for r in rows}
    assert len(rows) == len(got)
    # arrival order is batch order; within a batch, page and position
    want, counts = {}, {}
    for part in parts:
        for run, page, pos, url in sorted(part):
            if (run, url) not in want:
                counts[run] = counts.get(run, 0) + 1
                want[run, url] = counts[run]
    assert got == want


def test_a_batch_of_the_popularity_stream_reads_only_itself(spark, tmp_path):
    """Ten batches of the same size: rows read from files do not grow from batch to batch."""
    paths = {k: str(tmp_path / k) for k in ("in", "out", "cp")}
    for b in range(10):
        rows = [(r, b, i, f"u{b}-{i}" if i % 2 else f"u{i}") for r in (1, 2) for i in range(20)] + [(None, b, 0, None)]
        spark.createDataFrame(rows, CARDS).coalesce(1).write.mode("append").parquet(paths["in"])
        source = spark.readStream.schema(CARDS).parquet(paths["in"])
        query = streaming.stream_popularity(source, paths["out"], paths["cp"])
        query.awaitTermination()
        own = [p for p in query.recentProgress if p["numInputRows"]]
        assert [p["numInputRows"] for p in own] == [41]
        state = own[0]["stateOperators"][0]
        assert "rocksdbBytesCopied" in state["customMetrics"]
        # the counts a batch starts from: one row per run, whatever came before
        assert spark.read.parquet(f"{paths['out']}/counts/batch_id={own[0]['batchId']}").count() == 3
    ranks = spark.read.parquet(f"{paths['out']}/ranks").where("run = 1").collect()
    assert sorted(r.popularity_index for r in ranks) == list(range(1, 10 * 10 + 10 + 1))
    assert spark.read.parquet(f"{paths['out']}/ranks").where("run IS NULL").count() == 1


def test_plans_keep_html_out_of_shuffles(spark):
    pages = spark.createDataFrame(
        [("https://a.se/1", "https://a.se/1", "<p></p>", 200, None)],
        "request_url string, url string, html string, status int, fetched_at timestamp",
    )
    requests = spark.createDataFrame([("https://a.se/1", 1)], "request_url string, popularity_index int")
    for frame in plans.scrape_details(requests, pages).__dict__.values():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Exchange" in line:
                assert "html" not in line


def test_rows_without_run_page_or_job_are_numbered(spark):
    cards = spark.createDataFrame(
        [(1, 1, 1, "a"), (1, None, 2, "b"), (None, 1, 2, "d"), (None, 1, 1, "c"), (1, 2, 1, "a")],
        "run int, page_number long, position long, url string",
    )
    got = sorted(((r.run or 0, r.url, r.popularity_index) for r in ls.popularity_rank(cards).collect()))
    assert got == [(0, "c", 1), (0, "d", 2), (1, "a", 1), (1, "b", 2)]
    rows = spark.createDataFrame([("j", 1, "a"), (None, 2, "b"), (None, None, "c")], "job_id string, popularity_index long, url string")
    sent = {r.job_id: r.n_rows for r in sinks.to_messages(rows, "popularity_index", ["url"], 10).collect()}
    assert sent == {"j": 1, None: 2}


def test_an_endless_page_is_cut(spark):
    cards = spark.range(20_000).selectExpr("1 AS run", "1L AS page_number", "id AS position", "concat('u', id) AS url")
    ranked = ls.popularity_rank(cards)
    assert ranked.where("popularity_index <> position + 1").count() == 0 and ranked.count() == 20_000


def test_first_per_key_carries_types_without_order(spark):
    df = spark.sql(
        "SELECT 'k' AS unique_key, 1 AS t, map('a', 1) AS user_data, parse_json('{}') AS v"
        " UNION ALL SELECT 'k', 0, map('b', 2), parse_json('1')"
    )
    assert [(r.t, r.user_data) for r in first_per_key(df, ["unique_key"], ["t"]).collect()] == [(0, {"b": 2})]


def test_details_follow_the_asked_shop_and_keep_one_request(spark):
    """A page that ends at another shop keeps the rules of the shop that was asked."""
    html = '<div class="product"><h1 class="product-info__title">Lamp</h1><sale-price>1.250,00 kr.</sale-price></div>'
    rows = [("https://norliving.dk/p/1", "https://other.example/p/1", html, 200), ("https://norliving.dk/p/2", "https://norliving.dk/p/2", None, 404)]
    captured = spark.createDataFrame(rows, "request_url string, url string, html string, status int").withColumn("fetched_at", F.current_timestamp())
    requests = spark.createDataFrame([(u,) for u, *_ in rows] * 2, "request_url string")
    out = plans.scrape_details(requests, captured)
    assert [(r.url, r.name, r.price, r.currency) for r in out.offers.collect()] == [("https://other.example/p/1", "Lamp", 125000, "DKK")]
    assert [r.reject_reason for r in out.rejected.collect()] == ["PageNotFoundError"]


def test_links_of_untidy_markup(spark):
    html = """<a data-href="/d" href="/r">r</a><A HREF='/p?a=1&amp;b=2'>p</A><a href="/o'neil">o</a><a class=x href=/z>z</a>
        <!-- <a href="/no1"> --><script>var s = '<a href="/no2">';</script><abbr href="/no3"><a name="n">n</a><a href="">e</a>
        <nav-bar><a href="/bar">b</a></nav-bar><nav class="m"><a href="/nav">n</a></nav>"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    got = [(r.page_id, r.href) for r in lk.links(df).orderBy("page_id", "pos").collect()]
    assert got == [(1, h) for h in ("/r", "/p?a=1&b=2", "/o'neil", "/z", "", "/bar", "/nav")]
    assert [r.href for r in lk.homepage_links(df).orderBy("pos").collect()] == ["/r", "/p?a=1&b=2", "/o'neil", "/z", "", "/bar"]


def test_a_large_domain_gets_as_many_parts_as_it_needs(spark):
    rows = [(f"https://big.se/{i}",) for i in range(4000)] + [(f"https://d{i}.se/",) for i in range(20)] + [(None,), ("x",)]
    out = lk.by_domain(spark.createDataFrame(rows, "url string").repartition(5), rows=100)
    assert out.columns == ["url", "domain"] and out.count() == len(rows)
    with_conf = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        laid = lk.by_domain(spark.createDataFrame(rows, "url string"), rows=100).withColumn("p", F.spark_partition_id())
        parts = laid.where("domain = 'big.se'").groupBy("p").count().collect()
        assert len(parts) >= 8 and max(r["count"] for r in parts) <= 1500
        small = laid.where("domain <> 'big.se'").groupBy("domain").agg(F.count_distinct("p").alias("n")).collect()
        assert {r.n for r in small} == {1}
    finally:
        for k, v in with_conf.items():
            spark.conf.set(k, v)


def test_grids_too_large_to_number(spark):
    """30^14 combinations, with a limit and invalid prefixes on either side of what can be numbered."""
    sizes = [30] * 14
    rows = [(1, sizes, None), (2, sizes, [[0] * 13 + [0], [0] * 13 + [2]]), (3, sizes, [[29] * 14, [5, 6, 7]])]
    df = spark.createDataFrame(rows, "id int, option_counts array<int>, bad array<array<int>>")
    got = va.variant_grid(df, invalid="bad", limit=3).orderBy("id", "variant").collect()
    assert [r.options[-1] for r in got] == [0, 1, 2, 1, 3, 4, 0, 1, 2]
    assert all(r.options[:-1] == [0] * 13 for r in got)
    for bad, limit in (([[0]], 3), (None, None)):
        one = spark.createDataFrame([(sizes, bad)], "option_counts array<int>, bad array<array<int>>")
        with pytest.raises(Exception, match="more option combinations"):
            va.variant_grid(one, invalid="bad", limit=limit).collect()


def test_messages_of_any_job_carry_their_part_and_count(spark):
    rows = [("a", i if i % 2 else None, f"u{i}") for i in range(1, 2501)] + [("b", 1, "x"), (None, None, "y")]
    df = spark.createDataFrame(rows, "job_id string, popularity_index int, url string")
    # odd places of "a" become 1..1250
    ranked = df.withColumn("popularity_index", F.expr("CASE WHEN job_id = 'a' THEN (popularity_index + 1) div 2 ELSE popularity_index END").cast("int"))
    for frame, flag in ((df, False), (ranked, True)):
        out = sinks.to_messages(frame, "popularity_index", ["url"], 100, ranked=flag).collect()
        parts = {(r.job_id, r.part): json.loads(r.payload) for r in out}
        assert sorted(p for j, p in parts if j == "a") == list(range(25)) and all(r.n_rows <= 100 for r in out)
        for (job, part), payload in parts.items():
            assert (payload["part"], payload["nParts"]) == (part, 25 if job == "a" else 1)
        urls = [x["url"] for (j, p) in sorted(k for k in parts if k[0] == "a") for x in parts[j, p]["productListings"]]
        assert len(set(urls)) == 2500 and urls[:1250] == [f"u{i}" for i in range(1, 2501, 2)]
    whole = sinks.popularity_message(df.where("job_id = 'a'"), size=10**6).collect()
    assert [(r.part, r.n_parts, r.n_rows) for r in whole] == [(0, 1, 2500)]


def test_variant_grid_never_builds_what_the_limit_cuts(spark):
    df = spark.createDataFrame([([30] * 6, [[0], [1, 2], [7, 7, 7, 7, 7, 7, 7], [99]])], "option_counts array<int>, bad array<array<int>>")
    got = va.variant_grid(df, invalid="bad", limit=3).orderBy("variant").collect()
    assert [(r.variant, r.options) for r in got] == [(i, [1, 0, 0, 0, 0, i]) for i in range(3)]
    deep = va.variant_grid(df.selectExpr("array(3, 50, 100) AS option_counts", "array(array(1)) AS bad"), invalid="bad")
    assert deep.count() == 10_000 and deep.where("variant = 5000").first().options == [2, 0, 0]

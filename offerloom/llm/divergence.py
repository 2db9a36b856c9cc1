"""Source divergence audit: how the sources of a language differ in their terms.

Counting is single-pass in-memory indexing. A task builds the postings of a
block, term -> (source, occurrences, documents), until they fill the memory it
is given, then spills them, sorted by term and cut by a hash of the term into
shards, as a run of chunks in shared storage. A shard's chunks come back in the
order of their first terms; a heap merges them into whole posting lists, opening
a chunk only when the merge reaches it. With many runs, groups of them are first
merged into longer ones.

A pair's divergence is not summed over all terms: two sources that lack a term
differ there by a constant. A pair starts from that constant for every term;
terms that one source has correct it, through the source's histogram of shares;
terms that both have correct it once more, streamed from the posting lists into
sums per pair.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby, islice
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import short_batches, stored

DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP = 50
#: Postings that a task holds before it spills, postings of a chunk, runs that one merge reads.
BLOCK = 300_000
CHUNK = 2048
FAN = 512
#: A document in a block's counts, which hold occurrences below it.
DOCUMENT = 1 << 40
#: Pair sums that a task holds, and pairs that it adds up at once.
PAIRS = 1_000_000
STEP = 1_000_000
#: Bytes of a text that are split at once.
PIECE = 4_000_000

#: A-Z become a-z, a-z and bytes from 0x80 stay, all others delimit.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RUN = "shard int, run long, lang string, term binary, terms array<binary>, sources array<string>, n array<long>, docs array<long>"


def _add(text: bytes, counts: dict[bytes, int]) -> None:
    """Count the terms of one document, a piece of it at a time; each value holds documents and occurrences."""
    text = text.translate(_TERMS)
    own, at = Counter(), 0
    while at < len(text):
        cut = text.find(b" ", at + PIECE) if len(text) - at > PIECE else -1
        stop = cut if cut >= 0 else len(text)
        own.update(text[at:stop].split())
        at = stop
    get = counts.get
    for term, n in own.items():
        counts[term] = get(term, 0) + DOCUMENT + n


def _chunks(run: int, shard: int, lang: str, *columns: list) -> Iterator[tuple]:
    """Postings (terms, sources, n, docs), sorted by term, as rows of a run."""
    for i in range(0, len(columns[0]), CHUNK):
        yield (shard, run, lang, columns[0][i], *[c[i : i + CHUNK] for c in columns])


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in RUN.split(", ")])
    rows.clear()
    return out


def _sorted_block(block: dict, run: int, shards: int) -> Iterator[tuple]:
    """The rows of a run, by language, shard and term; empties the block."""
    groups = defaultdict(list)
    for lang, source in block:
        groups[lang].append(source)
    for lang, own in groups.items():
        terms, sources, n, docs = [], [], [], []
        for source in own:
            counts = block.pop((lang, source))
            terms += counts
            sources += [source] * len(counts)
            both = np.fromiter(counts.values(), np.int64, len(counts))
            n += (both % DOCUMENT).tolist()
            docs += (both // DOCUMENT).tolist()
        shard = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % shards
        keys = pa.table({"shard": shard, "term": pa.array(terms, pa.binary())})
        order = pc.sort_indices(keys, [("shard", "ascending"), ("term", "ascending")]).to_numpy()
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(ends)):
            at = order[ends[k] : ends[k + 1]].tolist()
            yield from _chunks(run, int(k), lang, *[[c[i] for i in at] for c in (terms, sources, n, docs)])


def _spilled(docs: DataFrame, shards: int) -> DataFrame:
    """The runs of all tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        block: dict = defaultdict(dict)
        held = 0
        for frame in frames:
            for lang, source, text in zip(frame["lang"], frame["source"], frame["text"]):
                own = block[lang, source]
                held -= len(own)
                _add(text, own)
                held += len(own)
                if held >= BLOCK:
                    yield from _frames(_sorted_block(block, number, shards))
                    held, number = 0, number + 1
        yield from _frames(_sorted_block(block, number, shards))

    return stored(docs.mapInPandas(run, RUN), "runs")


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Rows of runs, some at a time."""
    names = [c.split()[0] for c in RUN.split(", ")]
    while held := list(islice(rows, 64)):
        yield pd.DataFrame(held, columns=names)


def _merged(rows) -> Iterator[tuple]:
    """(term, postings) in order, from the chunks of one shard and language in the order of their first terms.

    All that lies before the first term of the next chunk is merged before that chunk is opened.
    """
    chunks: list = []  # (terms, sources, n, docs, place)

    def before(limit: bytes | None) -> Iterator[tuple]:
        parts, left = [], []
        for terms, *rest, at in chunks:
            stop = len(terms) if limit is None else bisect_left(terms, limit, at)
            if stop > at:
                parts.append(zip(*[c[at:stop] for c in (terms, *rest)]))
            if stop < len(terms):
                left.append((terms, *rest, stop))
        chunks[:] = left
        now, postings = None, []
        for term, *posting in heapq.merge(*parts):
            if term != now:
                if postings:
                    yield now, postings
                now, postings = term, []
            postings.append(posting)
        if postings:
            yield now, postings

    for row in rows:
        terms = [bytes(t) for t in row.terms]
        yield from before(terms[0])
        chunks.append((terms, *[c.tolist() for c in (row.sources, row.n, row.docs)], 0))
    yield from before(None)


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator:
    for frame in frames:
        yield from frame.itertuples(index=False)


def _by_source(postings: list) -> dict:
    """source -> (occurrences, documents)."""
    out: dict = {}
    for source, n, docs in postings:
        old = out.get(source, (0, 0))
        out[source] = (old[0] + n, old[1] + docs)
    return out


def _frequencies(runs: DataFrame, shards: int, documents: int) -> DataFrame:
    """Whole posting lists of the terms in at least ``documents`` documents of their language."""

    def longer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for (run, shard, lang), own in groupby(_rows(frames), key=attrgetter("run", "shard", "lang")):
                held = ([], [], [], [])
                for term, postings in _merged(own):
                    for source, (n, docs) in _by_source(postings).items():
                        for column, value in zip(held, (term, source, n, docs)):
                            column.append(value)
                    if len(held[0]) >= CHUNK:
                        yield from _chunks(run, shard, lang, *held)
                        held = ([], [], [], [])
                yield from _chunks(run, shard, lang, *held)

        yield from _frames(rows())

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for (_, lang), own in groupby(_rows(frames), key=attrgetter("shard", "lang")):
                for term, postings in _merged(own):
                    if sum(p[2] for p in postings) >= documents:
                        found = _by_source(postings)
                        yield lang, term, list(found), [n for n, _ in found.values()]

        found = rows()
        while held := list(islice(found, CHUNK)):
            yield pd.DataFrame(held, columns=["lang", "term", "sources", "n"])

    count = runs.agg(F.countDistinct("run")).first()[0]
    while count > FAN:
        count = -(-count // FAN)
        grouped = runs.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(count)))
        dealt = grouped.repartition(shards, "run", "shard").sortWithinPartitions("run", "shard", "lang", "term")
        runs = stored(dealt.mapInPandas(longer, RUN), "runs")
    dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "lang", "term")
    found = dealt.mapInPandas(whole, "lang string, term binary, sources array<string>, n array<long>")
    return stored(found.withColumn("term", F.col("term").cast("string")), "frequencies")


def share(n: Column, total: Column, terms: Column) -> Column:
    """A smoothed share in units, in exact integers; NULL without terms."""
    whole = (total + SMOOTHING * terms).cast("decimal(20,0)")
    part = ((n + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")).cast("decimal(31,0)")
    return F.when(terms > 0, F.call_function("div", part, whole) + 1)


def _both(lists: DataFrame) -> DataFrame:
    """Corrections of pairs for the terms that both sources have: lang, a, b, value; a before b."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: dict = {}
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh_keys, fresh, waiting = [], [], 0

        def add_up() -> None:
            nonlocal keys, sums, waiting
            places, at = np.unique(np.concatenate([keys, *fresh_keys]), return_inverse=True)
            total = np.zeros(len(places), np.int64)
            np.add.at(total, at, np.concatenate([sums, *fresh]))
            keys, sums, waiting = places, total, 0
            fresh_keys.clear()
            fresh.clear()

        def rows() -> pd.DataFrame:
            nonlocal keys, sums
            names = list(ids)
            a, b = (keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist()
            out = pd.DataFrame(
                {"lang": [names[i][0] for i in a], "a": [names[i][1] for i in a], "b": [names[j][1] for j in b], "value": sums}
            )
            keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return out

        for row in _rows(frames):
            own = np.array([ids.setdefault((row.lang, s), len(ids)) for s in row.sources], np.int64)
            p, z = np.asarray(row.p, np.int64), np.asarray(row.z, np.int64)
            for i in range(0, len(own), width := max(1, STEP // len(own))):
                rows_of = slice(i, i + width)
                left, right = np.nonzero(np.arange(len(own))[rows_of, None] < np.arange(len(own)))
                left += i
                value = np.abs(p[left] - p[right]) - np.abs(p[left] - z[right])
                value += np.abs(z[left] - z[right]) - np.abs(p[right] - z[left])
                fresh_keys.append(own[left] << 32 | own[right])
                fresh.append(value)
                waiting += len(left)
                if waiting >= STEP:
                    add_up()
                    if len(keys) >= PAIRS:
                        yield rows()
        add_up()
        yield rows()

    return lists.mapInPandas(run, "lang string, a string, b string, value long")


def audit_sources(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """``docs(text, lang, source)`` -> rows lang, source, part, item, value, rank.

    Part ``pair``: the divergence of a source from each other source of its
    language, all of them ranked. Part ``term``: the ``top`` terms that a source
    has more of than its language. NULL text, lang and source are read as empty
    text; a source without terms is one like others; a language without kept
    terms has pairs of value 0 and no terms. Repeated rows are rows like others,
    ties go by the item's bytes. Further columns are not read, an empty table
    gives an empty result.
    """
    blank = F.lit("")
    docs = short_batches(docs).select(
        F.coalesce("lang", blank).alias("lang"),
        F.coalesce("source", blank).alias("source"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = _frequencies(_spilled(docs, shards), shards, documents)

    flat = lists.select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("n").alias("n"))))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = lists.groupBy("lang").agg(F.count("*").alias("terms"))
    total, kept = F.coalesce("total", F.lit(0)), F.coalesce("terms", F.lit(0))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
    zero = F.coalesce(share(F.lit(0), total, kept), F.lit(0))
    groups = stored(groups.select("lang", "source", total.alias("total"), kept.alias("terms"), zero.alias("z")), "groups")

    p = share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    shares = stored(flat.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", p, "z"), "shares")

    # what a pair has without common terms, as (lang, a, b, value) with a before b
    other = groups.select("lang", F.col("source").alias("b"), F.col("z").alias("y"))
    ends = [F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b")]
    base = groups.join(other, "lang").where("source < b").select("lang", *ends, (F.col("terms") * F.abs(F.col("z") - F.col("y"))).alias("value"))
    shapes = shares.groupBy("lang", "source", "p", "z").agg(F.count("*").alias("k"))
    ahead = F.col("k") * (F.abs(F.col("p") - F.col("y")) - F.abs(F.col("z") - F.col("y")))
    one = shapes.join(other, "lang").where("source <> b").select("lang", *ends, ahead.alias("value"))
    members = F.array_sort(F.collect_list(F.struct("source", "p", "z")))  # a row per source of the language
    common = shares.groupBy("lang", "term").agg(members.alias("m")).where(F.size("m") > 1)
    both = _both(common.select("lang", *[F.col(f"m.{c}").alias(d) for c, d in (("source", "sources"), ("p", "p"), ("z", "z"))]))
    pairs = base.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", "value", F.inline(sides)).withColumn("part", F.lit("pair"))

    sums = lists.select("lang", "term", F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    whole = sums.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    q = share(F.col("n"), F.col("total"), F.col("terms")).alias("q")
    more = shares.join(sums.join(whole, "lang").select("lang", "term", q), ["lang", "term"])
    value = F.col("p") - F.col("q")
    found = more.where(value > 0).select("lang", "source", F.col("term").alias("item"), value.alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    names = ["lang", "source", "part", "item", "value", "rank"]
    ranked = [
        pairs.withColumn("rank", F.row_number().over(order)),
        found.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top),
    ]
    return ranked[0].select(*names).unionByName(ranked[1].select(*names))

"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is a set of windows, and a document holds a window only if it
holds each of the window's shingles. Shingles are ordered by how often the
corpus has them; exact containment needs the first of that order alone as the
window's prefix. The documents' shingles meet the prefixes in a join, the
shingle's place in the window gives the only possible start (positional bound),
the window must end before the document does (length bound), and the words of
those that remain are compared one by one.

Words are cut once and written down; the joins run on the written table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import small_enough, stored

# Fixed value: a word is a run of 0-9, a-z and whatever is beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WINDOW = 10
#: Words of a shingle; a window with fewer words is one shingle.
SHINGLE = 3
#: Shingle keys (8 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; NULL has none."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``benchmark(item_id, text)`` -> distinct ``(item_id, words)``, one row per window."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words")).distinct()


def _key(words: Column, at: Column, width: int) -> Column:
    """Hash of the shingle at the 0-based place; NULL if it goes beyond the end."""
    parts = [F.get(words, at + i) for i in range(width)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def _join_small(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    return rows.join(F.broadcast(keys) if small_enough(keys, BROADCAST_ROWS) else keys, "key", how)


def _hits(docs: DataFrame, windows: DataFrame, width: int) -> DataFrame:
    """Occurrences ``(uid, start, length, item_id)`` of windows in ``docs(uid, words)``."""
    reach = WINDOW + width
    places = F.sequence(F.lit(0), F.size("words") - width)
    shingles = windows.select("item_id", "words", F.explode(places).alias("place"))
    shingles = stored(shingles.withColumn("key", _key(F.col("words"), F.col("place"), width)), "shingles")
    at = docs.where(F.size("words") >= width).select("uid", "words", F.posexplode("words").alias("at", "word"))
    keyed = at.withColumn("key", _key(F.col("words"), F.col("at"), width))
    # rarity over the whole corpus of the shingles that the benchmark has
    held = _join_small(keyed.select("key"), shingles.select("key").distinct(), "left_semi")
    counts = held.groupBy("key").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("key").alias("key"), F.col("place").alias("place"))
    prefix = shingles.join(counts, "key", "left").groupBy("item_id", "words").agg(F.min(order).alias("p"))
    prefix = stored(prefix.where("p.n > 0").select("item_id", "words", "p.key", "p.place"), "prefixes")
    keys = prefix.select("key").distinct()
    # the words around a match are all that the check needs
    low = F.greatest(F.col("at") - reach, F.lit(0))
    near = F.slice("words", low + 1, F.lit(2 * reach))
    if small_enough(keys, BROADCAST_ROWS):
        met = keyed.join(F.broadcast(keys), "key").select("uid", "key", "at", low.alias("low"), near.alias("near"))
    else:
        met = keyed.select("uid", "key", "at").join(keys, "key")
        met = met.join(docs.select("uid", "words"), "uid")
        met = met.select("uid", "key", "at", low.alias("low"), near.alias("near"))
    start = F.col("at") - F.col("place")
    length = F.size("words")
    pairs = met.join(prefix, "key").where(start >= F.col("low"))
    same = F.slice("near", start - F.col("low") + 1, length) == F.col("words")
    return pairs.where(same).select("uid", start.alias("start"), length.alias("length"), "item_id")


def _contamination(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written words ``(uid, doc_id, text_hash, words)`` and ``(uid, n_hit, items)`` of hit documents."""
    kept = stored(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
            words_of(F.col("text")).alias("words"),
        ),
        "words",
    )
    windows = stored(windows_of(benchmark), "windows")
    widths = [r[0] for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]
    hits = None
    for width in sorted(widths):
        own = windows.where(F.least(F.size("words"), F.lit(SHINGLE)) == width)
        part = _hits(kept.select("uid", "words"), own, width)
        hits = part if hits is None else hits.union(part)
    if hits is None:
        empty = kept.select("uid", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
        return kept, empty.limit(0)
    found = hits.groupBy("uid").agg(
        F.collect_set(F.struct("start", "length")).alias("runs"), F.collect_set(F.col("item_id").cast("string")).alias("items")
    )
    covered = F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1)))
    return kept, found.select(
        "uid", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.array_sort("items").alias("items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` -> one row per document.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. NULL
    and empty texts have no words and no hits; an item with a NULL id makes
    hits but is not listed; repeated rows and items are judged each on its
    own. Further columns are not read. Empty tables give no hits, or no rows.
    """
    kept, found = _contamination(docs, benchmark)
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        kept.select("uid", "doc_id", F.size("words").cast("long").alias("n_words"))
        .join(found, "uid", "left")
        .select(
            "doc_id",
            "n_words",
            hit.alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
            (hit > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without any occurrence of a benchmark window."""
    kept, found = _contamination(docs, benchmark)
    bad = kept.join(found, "uid", "left_semi").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"))
    bad = stored(bad.distinct(), "contaminated")
    if small_enough(bad, BROADCAST_ROWS):
        bad = F.broadcast(bad)
    same = docs["doc_id"].cast("long").eqNullSafe(bad["_d"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_t"]
    )
    return docs.join(bad, same, "left_anti")

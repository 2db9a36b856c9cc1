"""URL filters: host and path rules, then exact list membership by a cascade of Bloom filters.

The first filter of the cascade encodes the listed keys. The unlisted keys of
the corpus that it lets through are known, because the corpus's keys are all
there is to ask about, so the second filter encodes those; the third one
encodes the listed keys that the second one lets through, and so on until
nothing gets through. The first filter that lacks a key tells the answer by its
parity, exactly, for every key of the corpus. Filters are bit arrays built by
``bit_or`` aggregations and asked through scalar subqueries: pages meet no join
and do not move.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import stored

#: Listed keys up to which a cascade is built; the filters then stay below about 40 MB. Longer lists are joined.
KEYS = 20_000_000
#: False positive rates of the first filter (at least and at most) and of the others.
FIRST_RATE = (0.001, 0.5)
LATER_RATE = 1 / 16
WORD = 64


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL without one.

    A rule is (verdict, host, path): it fits the host and its subdomains where
    the path starts with the rule's. Among equally long ones the first in
    alphabetical order wins.
    """
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def keys_of(host: Column, path: Column) -> list[Column]:
    """What a list can name of a url: host + path, the host, and its last two or three labels; NULL without a host."""
    keys = [F.concat(host, path), host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)]
    return [F.when(host != "", k) for k in keys]


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


class Level:
    """One filter: its words as a one-row table ``(words array<bigint>)``."""

    def __init__(self, keys: DataFrame, count: int, rate: float, number: int):
        self.number = number
        self.hashes = max(1, math.ceil(-math.log2(rate)))
        words = max(1, math.ceil(max(count, 1) * self.hashes / math.log(2) / WORD))
        self.bits = words * WORD
        place = keys.select(F.explode(F.array(*_places(F.col("key"), number, self.bits, self.hashes))).alias("at"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD).cast("int"))
        set_words = place.groupBy((F.floor(F.col("at") / WORD)).cast("bigint").alias("word")).agg(F.bit_or(bit).alias("held"))
        every = keys.sparkSession.range(words).withColumnRenamed("id", "word")
        filled = every.join(set_words, "word", "left").select("word", F.coalesce("held", F.lit(0).cast("bigint")).alias("held"))
        # one row of bounded size: the number of keys of a cascade is checked
        row = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "held"))), lambda w: w["held"]).alias("words"))
        self.table = stored(row, f"level-{number}")

    def has(self, key: Column) -> Column:
        words = self.table.scalar()
        hit = None
        for at in _places(key, self.number, self.bits, self.hashes):
            word = F.element_at(words, (F.floor(at / WORD) + 1).cast("int"))
            bit = F.call_function("shiftrightunsigned", word, (at % WORD).cast("int")).bitwiseAND(F.lit(1))
            hit = bit == 1 if hit is None else hit & (bit == 1)
        return hit


class Cascade:
    """Exact membership of the universe's keys in a list."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def lists(self, key: Column) -> Column:
        # the first filter without the key decides: an odd one encodes listed keys
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.has(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return answer


def build_cascade(universe: DataFrame, listed: DataFrame, listed_count: int) -> Cascade:
    """``universe(key)`` and ``listed(key)``, both distinct -> the cascade."""
    inside = stored(listed.join(universe, "key", "left_semi"), "listed")
    outside = stored(universe.join(listed, "key", "left_anti"), "unlisted")
    held, other = inside, outside
    n_held, n_other = inside.count(), outside.count()
    levels: list[Level] = []
    while not levels or n_other:
        rate = LATER_RATE
        if not levels:
            low, high = FIRST_RATE
            rate = min(max(0.7 * n_held / max(n_other, 1), low), high)
        level = Level(held, n_held, rate, len(levels) + 1)
        levels.append(level)
        passed = stored(other.where(level.has(F.col("key"))), f"passed-{level.number}")
        held, other, n_held, n_other = passed, held, passed.count(), n_held
        if not n_held:
            break
    return Cascade(levels)


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, keys: int = KEYS
) -> DataFrame:
    """``pages(page_id, url)`` -> ``(page_id, host, path, rule, verdict, listed)``, one row per input row.

    A rule decides first; without one a url is blocked if ``listed(key)`` has
    one of its keys, else allowed. NULL urls and urls without ``://`` have an
    empty host and path, fit no rule and have no keys. Repeated and NULL list
    keys add nothing. Further columns are not read; an empty table gives an
    empty result.
    """
    url = F.col("url")
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    asked = keys_of(F.col("host"), F.col("path"))
    universe = stored(parsed.select(F.explode(F.array(*asked)).alias("key")).where("key is not null").distinct(), "universe")
    listed = stored(listed.select("key").where("key is not null").distinct(), "list")
    count = listed.count()
    if count <= keys:
        cascade = build_cascade(universe, listed, count)
        held = [F.coalesce(cascade.lists(k), F.lit(False)) for k in asked]
        found = parsed.withColumn("listed", held[0] | held[1] | held[2] | held[3])
    else:
        numbered = stored(parsed.withColumn("uid", F.monotonically_increasing_id()), "pages")
        hit = numbered.select("uid", F.explode(F.array(*asked)).alias("key")).join(listed, "key", "left_semi").select("uid").distinct()
        found = numbered.join(hit.withColumn("listed", F.lit(True)), "uid", "left").na.fill(False, ["listed"])
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")

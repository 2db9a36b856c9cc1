"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: a slot is a
mask with a bit per language, and the AND of an n-gram's slots gives every
language that has it. A text gets, for each language, the number of its
n-grams whose mask has the language's bit (a popcount down the masks), less the
share that false positives alone would give. The language with the largest
corrected count is the prediction.

A language has an n-gram if its rate there is at least ``SHARE`` of the rate in
the language where it is commonest, and at least ``RARE``: stray words of other
languages do not count, and the filter's size is bounded.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.llm.common import crc_mod, stored

#: Characters of an n-gram, word edges included.
SIZES = (1, 2, 3, 4)
SHARE = 0.1
#: Least rate of a language's n-gram; a language has at most 1 / RARE of them.
RARE = 1e-6
#: Hash functions, and slots per n-gram held.
HASHES = 4
SLOTS = 8
UNKNOWN = "und"
#: Words that a worker remembers at a time.
CACHE = 100_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def gram_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the words' n-grams, edges as spaces, and the place of each one's word in the list."""
    text = f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(text, dtype="<u4").astype(np.uint64)
    space = chars == 32
    word = np.cumsum(space) - 1
    keys, places = [], []
    state, inner = np.zeros(len(chars), dtype=np.uint64), np.zeros(len(chars), dtype=bool)
    for n in range(1, max(SIZES) + 1):
        length = len(chars) - n + 1
        if length <= 0:
            break
        state = (state[:length] ^ chars[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(29)
        if n > 2:  # a space is an edge, never inside
            inner = inner[:length] | space[n - 2 : n - 2 + length]
        if n in SIZES:
            good = ~inner[:length] if n > 1 else ~space
            keys.append((state + np.uint64(n))[good])
            places.append(word[:length][good])
    return np.concatenate(keys), np.concatenate(places)


class LanguageFilter:
    """The bit-sliced filter; ``languages`` are in the order of their bits."""

    def __init__(self, languages: list[str], grams: dict[int, int]):
        self.languages = languages
        self.planes = max(1, -(-len(languages) // 64))
        self.slots = 1 << max(10, (SLOTS * max(len(grams), 1) - 1).bit_length())
        table = np.zeros((self.slots, self.planes), dtype=np.uint64)
        if grams:
            masks = [[m >> 64 * p & (2**64 - 1) for p in range(self.planes)] for m in grams.values()]
            masks = np.array(masks, dtype=np.uint64)
            for at in self._places(np.array(list(grams), dtype=np.int64).view(np.uint64)).T:
                np.bitwise_or.at(table, at, masks)
        self.table = table
        fill = self._bits(table).mean(axis=0) if languages else np.zeros(0)
        self.false_rate = np.minimum(fill**HASHES, 0.5)

    def _bits(self, masks: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8).reshape(len(masks), -1), axis=1, bitorder="little")
        return bits[:, : len(self.languages)]

    def _places(self, keys: np.ndarray) -> np.ndarray:
        step = keys * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(32) | np.uint64(1)
        first = keys >> np.uint64(32)
        rounds = np.arange(HASHES, dtype=np.uint64)
        return ((first[:, None] + rounds * step[:, None]) & np.uint64(self.slots - 1)).astype(np.int64)

    def counts(self, words: list[str]) -> np.ndarray:
        """For each word the number of its n-grams and the popcount per language."""
        keys, word = gram_keys(words)
        places = self._places(keys)
        masks = self.table[places[:, 0]]
        for k in range(1, HASHES):
            masks = masks & self.table[places[:, k]]
        bits = self._bits(masks)
        columns = [np.bincount(word, minlength=len(words))]
        columns += [np.bincount(word, weights=bits[:, k], minlength=len(words)) for k in range(bits.shape[1])]
        return np.stack(columns, axis=1).astype(np.float64)


class Predictor:
    """texts -> (language, score) of each; remembers the counts of words."""

    def __init__(self, held: LanguageFilter):
        self.held, self.place = held, {}
        self.rows = np.zeros((0, 1 + len(held.languages)))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > CACHE:
            self.place, self.rows, new = {}, self.rows[:0], list(words)
        if new:
            self.place |= {w: len(self.rows) + k for k, w in enumerate(new)}
            self.rows = np.concatenate((self.rows, self.held.counts(new)))

    def _totals(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self.rows.shape[1])
        for at in range(0, len(words), CACHE // 2):
            part = words[at : at + CACHE // 2]
            if len(words) > CACHE // 2:
                self._learn(set(part))
            total += self.rows[[self.place[w] for w in part]].sum(axis=0)
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for at in range(0, len(texts), 256):
            block = [words_of(t) for t in texts[at : at + 256]]
            if not self.held.languages:
                out += [(UNKNOWN, 0.0)] * len(block)
                continue
            small = set()
            start = 0
            for k, words in enumerate(block):
                # a long text learns its own words, which may forget the others': those before it come first
                if len(small) > CACHE // 2 or len(words) > CACHE // 2:
                    self._learn(small)
                    out += [self._best(w) for w in block[start:k]]
                    small, start = set(), k
                if len(words) > CACHE // 2:
                    out.append(self._best(words))
                    start = k + 1
                else:
                    small.update(words)
            self._learn(small)
            out += [self._best(w) for w in block[start:]]
        return out

    def _best(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        total, wrong = self._totals(words), self.held.false_rate
        share = (total[1:] / total[0] - wrong) / (1 - wrong)
        best = int(np.argmax(share))
        return self.held.languages[best], float(min(max(share[best], 0.0), 1.0))


def fit_filter(docs: DataFrame) -> LanguageFilter:
    """``docs(text, lang)`` -> the filter. Rows with a NULL text or language teach nothing.

    All rows count. Languages with more n-grams come first, and win ties.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = defaultdict(Counter)
        held = 0

        def grams() -> Iterator[pd.DataFrame]:
            for lang, own in words.items():
                sums: dict[int, int] = {}
                names = list(own)
                for at in range(0, len(names), CACHE):
                    part = names[at : at + CACHE]
                    keys, word = gram_keys(part)
                    times = np.array([own[w] for w in part])[word]
                    keys, where = np.unique(keys, return_inverse=True)
                    for k, n in zip(keys.view(np.int64).tolist(), np.bincount(where, weights=times).tolist()):
                        sums[k] = sums.get(k, 0) + int(n)
                frame = pd.DataFrame({"gram": np.fromiter(sums, np.int64), "n": np.fromiter(sums.values(), np.int64)})
                frame.insert(0, "lang", pd.Series([lang] * len(frame), dtype=object))
                yield frame
            words.clear()

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                own = words[lang]
                held -= len(own)
                own.update(words_of(text))
                held += len(own)
                if held >= 4 * CACHE:
                    yield from grams()
                    held = 0
        yield from grams()

    rows = docs.where("text is not null and lang is not null").select("lang", "text")
    counts = rows.mapInPandas(run, "lang string, gram long, n long")
    counts = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()  # one row per language
    totals = sorted(totals, key=lambda r: (-r.total, r.lang))
    languages = [r.lang for r in totals]
    if not languages:
        return LanguageFilter([], {})
    by = counts.sparkSession.createDataFrame([(r.lang, float(r.total)) for r in totals], "lang string, total double")
    rates = counts.join(F.broadcast(by), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
    top = F.max("rate").over(Window.partitionBy("gram"))  # a row per language at most
    kept = rates.withColumn("top", top).where((F.col("rate") >= RARE) & (F.col("rate") >= SHARE * F.col("top")))
    bit = {name: 1 << i for i, name in enumerate(languages)}
    masks: dict[int, int] = {}
    for r in kept.select("lang", "gram").toLocalIterator():
        masks[r.gram] = masks.get(r.gram, 0) | bit[r.lang]
    return LanguageFilter(languages, masks)


def identify_language(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang)`` -> ``(doc_id, held_out, lang_pred, score)``, one row per input row.

    Learns from rows whose crc32 of the id as text modulo 4 is not 2. Texts
    that are NULL or have no letter, and all texts if nothing can be learned,
    are ``und`` with score 0. The score is the estimated share of the text's
    n-grams that the language has. Repeated rows and NULL ids are rows like
    others; further columns are not read; an empty table gives an empty result.
    """
    held = fit_filter(docs.where(crc_mod("doc_id", 4) != 2))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = Predictor(held)
        for texts in batches:
            frame = pd.DataFrame(predictor.predict(list(texts)), columns=["lang", "score"])
            yield frame.astype({"lang": object, "score": float})

    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_mod("doc_id", 4) == 2).alias("held_out"),
        predict(F.col("text")).alias("p"),
    )
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))

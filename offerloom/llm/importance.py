"""Target-distribution importance resampling over hashed word runs.

The words of a block of texts form an Aho-Corasick dictionary: each distinct
word, bounded by delimiters, carries its CRC and length. One scan of the block
emits these payloads in order. CRCs of neighbouring words compose to the CRC of
the run that they form, ``crc(ab) = shift(crc(a), len(b)) ^ crc(b)``, so that
no run is ever written out or hashed byte by byte; a run's CRC is its bucket.

A bucket's gain compares its share in the target with its share in the corpus,
a document's weight is the sum of its runs' gains, and the highest weights with
Gumbel noise are a sample without replacement. Counts are a grouped sum of one
row per bucket and task; the draw is a range-partitioned sort of narrow rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import short_batches, stored

BUCKETS = 10_000
WORDS = 20
SHARE = (5, 100)
SEED = 42
#: Bytes of normalised text under one automaton.
BLOCK = 2_000_000

#: A-Z become a-z, digits and bytes from 0x80 stay, all others delimit.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Stands between two documents; no word holds it.
_END = "\n"
_POLYNOMIAL = 0xEDB88320  # of the reflected CRC-32


def normalise(text: bytes) -> bytes:
    """Words in lower case between single blanks."""
    text = text.translate(_NORMAL)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.strip(b" ")


@cache
def _shift_table(bits: int) -> np.ndarray:
    """What ``2**bits`` appended zero bytes do to a CRC, by the CRC's four bytes."""
    if bits:
        half = _shift_table(bits - 1)
        return _apply(half, half.ravel()).reshape(4, 256)
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(_POLYNOMIAL), byte >> 1)
    # the lowest byte is divided out, the others move down
    rest = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(3)]
    return np.stack([byte, *rest])


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def shift(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after ``lengths`` more bytes, but for the CRC of these bytes themselves."""
    crc = crc.copy()
    for bits in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> bits) & 1)
        crc[at] = _apply(_shift_table(bits), crc[at])
    return crc


class Payloads:
    """The dictionary of a block: per word the CRC, the CRC after a blank, and the length with that blank."""

    def __init__(self, block: str):
        words = set(block.split(" "))
        words.difference_update(("", _END))
        self.automaton = ahocorasick.Automaton()
        self.automaton.add_word(f" {_END} ", 0)
        raw = [w.encode("latin-1") for w in words]
        for i, w in enumerate(words, 1):
            self.automaton.add_word(f" {w} ", i)
        self.automaton.make_automaton()
        self.crc = np.fromiter((0, *map(zlib.crc32, raw)), np.uint32, len(raw) + 1)
        length = np.fromiter((0, *map(len, raw)), np.int64, len(raw) + 1)
        blank = np.full(len(length), zlib.crc32(b" "), np.uint32)
        self.after_blank = shift(blank, length) ^ self.crc
        self.length = length + 1

    def scan(self, block: str) -> np.ndarray:
        """The words of the block in order, 0 between two documents."""
        return np.fromiter((i for _, i in self.automaton.iter(block)), np.int64)


def _blocks(texts) -> Iterator[bytes]:
    """Normalised texts, each with its end, in blocks; a long text runs over several."""
    held, size = [], 0
    for text in texts:
        text = normalise(text or b"")
        at = 0
        while len(text) - at > BLOCK:
            cut = text.rfind(b" ", at, at + BLOCK)
            cut = cut if cut > at else text.find(b" ", at + BLOCK)
            if cut < 0:
                break
            yield b" ".join((b"", *held, text[at:cut], b""))
            held, size, at = [], 0, cut + 1
        held += [text[at:], _END.encode()]
        size += len(text) - at + 2
        if size >= BLOCK:
            yield b" ".join((b"", *held, b""))
            held, size = [], 0
    if held:
        yield b" ".join((b"", *held, b""))


def runs(texts, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (place of the text, bucket) per run of one to three words, and of the place per word."""
    place, tail = 0, None
    for raw in _blocks(texts):
        block = raw.decode("latin-1").replace("  ", " ")
        payloads = Payloads(block)
        found = payloads.scan(block)
        ends = found == 0
        where = place + np.cumsum(ends)
        place = int(where[-1]) if len(where) else place
        where, found = where[~ends], found[~ends]
        part = (where, payloads.crc[found], payloads.after_blank[found], payloads.length[found])
        old = 0
        if tail is not None:  # up to two words before, whose own runs are out already
            old = len(tail[0])
            part = tuple(np.concatenate(x) for x in zip(tail, part))
        tail = tuple(x[-2:] for x in part)
        where, crc, after, length = part
        two = shift(crc[:-1], length[1:]) ^ after[1:]
        three = shift(two[:-1], length[2:]) ^ after[2:]
        in_two, in_three = where[:-1] == where[1:], where[:-2] == where[2:]
        in_two[: max(old - 1, 0)] = False
        in_three[: max(old - 2, 0)] = False
        crcs = np.concatenate((crc[old:], two[in_two], three[in_three]))
        places = np.concatenate((where[old:], where[1:][in_two], where[2:][in_three]))
        yield places, (crcs % np.uint32(buckets)).astype(np.int64), where[old:]


def _bucket_counts(df: DataFrame, buckets: int) -> np.ndarray:
    """Runs in each bucket over all rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for _, found, _ in runs((t for frame in frames for t in frame["text"]), buckets):
            total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    counts = df.select(F.col("text").cast("binary").alias("text")).mapInPandas(run, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the log of its smoothed share in the target over that in the source, rounded down."""
    buckets = len(source)
    more, less = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def gumbel(doc_id: int | None, seed: int) -> int:
    """The document's noise, in thousandths, drawn from its id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(docs: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words, weight = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for places, found, own in runs(frame["text"], len(gain)):
                np.add.at(weight, places, gain[found])
                words += np.bincount(own, minlength=len(frame))
            ids = [None if i is None else int(i) for i in frame["doc_id"]]
            yield pd.DataFrame(
                {
                    "doc_id": pd.Series(ids, dtype="Int64"),
                    "n_words": words,
                    "n_features": words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0),
                    "weight": weight,
                    "score": weight + np.array([gumbel(i, seed) for i in ids], dtype=np.int64),
                }
            )

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, words: int = WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """``docs(doc_id, text)``, ``target(text)`` -> one row per document: doc_id, n_features, weight, score, rank.

    Of the documents with at least ``words`` words, the ``share`` with the
    highest scores is drawn and ranked from 1; all others have no rank. A NULL
    text has no words, a NULL id counts as empty text and comes last among
    ties. Repeated rows are rows like others, drawn each by itself; ties of
    one id go by features and weight. Further columns are not read. An empty
    target gives every bucket the same count there; an empty table gives an
    empty result.
    """
    short_batches(docs)
    gain = gains(_bucket_counts(docs, buckets), _bucket_counts(target, buckets))
    rows = stored(_weighed(docs, gain, seed), "weights")
    part, whole = share
    enough = F.col("n_words") >= words
    drawn = part * rows.where(enough).count() // whole
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight"]
    # the id holds the place of the sorted partition and the row's place in it
    ranked = stored(rows.where(enough).orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    part_of = F.shiftright("at", 33)
    counts = ranked.groupBy(part_of.alias("part")).agg(F.count("*").alias("n"))  # a row per partition of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    ranked = ranked.withColumn("part", part_of).join(F.broadcast(starts), "part")
    names = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*names, F.when(rank <= drawn, rank).alias("rank")).unionByName(
        rows.where(~enough).select(*names, F.lit(None).cast("long").alias("rank"))
    )

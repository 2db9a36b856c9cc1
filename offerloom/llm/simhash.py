"""SimHash near-duplicates with pigeonring filtering.

The 64 bits are cut into ``bits + 1`` consecutive segments on a ring. If two
fingerprints differ in at most ``bits`` places, some start exists from which
every chain of l segments differs in at most ``l * bits / (bits + 1)`` places.
With two bits, a chain of one segment must agree, a chain of two may differ in
one place, and the whole ring in two. Chains are counted, not paired: a
fingerprint goes on only if another one shares a chain with it, which takes
map-side counts and one semi-join. The survivors take the full Hamming check
through the points half-way between them: fingerprints two places apart have a
common neighbour one place away from both, and at most 65 fingerprints lie
around one point, so no group grows with the data and no pair is enumerated
beyond a star per point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import fresh, short_batches, small_enough, stored
from offerloom.llm.components import connected_components

WIDTH = 64
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 16
#: Dropped rows up to which their keys are broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000


def fingerprint_of(text: str | None, shingle: int, seed: int = 42) -> int:
    """The signed 64-bit fingerprint; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only; splits at ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, seed) for p in parts], dtype="<u8")
    ones = np.zeros(WIDTH, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The fingerprint column of a text column."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return run(text)


def _segments(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's segments."""
    n = bits + 1
    edges = [round(i * WIDTH / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def candidates(prints: DataFrame, bits: int) -> DataFrame:
    """Distinct fingerprints ``(fp)`` that share a chain with another one.

    A chain of one segment has to agree. Where the budget of two segments is
    one place, the chain's key holds the first one and the second one with one
    place masked, for each place: equal for chains within the budget. Keys are
    hashed; a collision lets a fingerprint through to the full check only.
    """
    ring = _segments(bits)
    fp = F.col("fp")
    chains = []
    for i, here in enumerate(ring):
        shift, width = ring[(i + 1) % len(ring)]
        first = [F.lit(i), _part(fp, *here)]
        if bits < 2:
            chains.append(F.xxhash64(*first))
            continue
        after = _part(fp, shift, width)
        for b in range(width):
            chains.append(F.xxhash64(*first, F.lit(b), after.bitwiseAND(F.lit(~(1 << b)))))
    rows = prints.select("fp", F.explode(F.array(*chains)).alias("chain"))
    shared = rows.groupBy("chain").agg(F.count("*").alias("n")).where("n > 1").select("chain")
    return rows.join(shared, "chain", "left_semi").select("fp").distinct()


def links(prints: DataFrame, bits: int) -> DataFrame:
    """Edges ``(a, b)`` between candidates, with the components of all pairs within ``bits``."""
    fp = F.col("fp")
    flips = [F.lit(1).cast("long") if b == 0 else F.shiftleft(F.lit(1).cast("long"), b) for b in range(WIDTH)]
    if bits == 2:  # the ball of radius one around each
        points = F.array(fp, *[fp.bitwiseXOR(f) for f in flips])
        met = prints.select("fp", F.explode(points).alias("point"))
    else:  # one place masked
        points = F.array(*[
            F.struct(fp.bitwiseAND(F.bitwise_not(f)).alias("point"), F.lit(b).alias("b")) for b, f in enumerate(flips)
        ])
        met = prints.select("fp", F.explode(points).alias("point"))
    around = met.groupBy("point").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    star = around.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a <> b").distinct()
    return star.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)


def near_classes(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Fingerprints ``(fp)``, repeats allowed -> ``(fp, root)`` of those linked to a different one."""
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    distinct = prints.select("fp").distinct()
    if bits == 0:
        return distinct.limit(0).select("fp", F.col("fp").alias("root"))
    found = connected_components(links(stored(candidates(distinct, bits), "ring"), bits))
    return found.select(F.col("node").alias("fp"), "root")


def simhash_components(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fingerprint, component_id)``, one row per input row.

    A NULL text is empty; a text without words has the fingerprint zero and
    links like any other. ``component_id`` is the smallest doc_id of the
    component, NULL if it has none. Repeated rows stay repeated. Further
    columns are not read; an empty table gives an empty result.
    """
    prints = stored(
        short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text"), shingle).alias("fp")),
        "prints",
    )
    firsts = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = stored(firsts.join(near_classes(firsts, bits), "fp", "left"), "roots")
    root = F.coalesce("root", "fp")
    least = roots.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    ids = roots.join(least, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    out = prints.join(ids, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, of which each component keeps one.

    The row with the smallest doc_id stays (NULL last); among several rows of
    that id any one of them.
    """
    uid, fp = fresh(docs, "uid"), fresh(docs, "fp")
    kept = stored(
        short_batches(docs).withColumn(uid, F.monotonically_increasing_id()).withColumn(fp, fingerprints(F.col("text"), shingle)),
        "documents",
    )
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(uid).alias("u"))
    rows = kept.select(F.col(fp).alias("fp"), rank.alias("r"))
    firsts = stored(rows.groupBy("fp").agg(F.min("r").alias("r")), "firsts")
    roots = firsts.join(near_classes(firsts, bits), "fp", "left")
    keep = roots.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("r.u").alias("u0"), F.min("r").alias("r"))
    stay = stored(keep.select(F.col("r.u").alias(uid)), "stay")
    gone = stored(kept.select(uid).join(stay, uid, "left_anti"), "gone")
    if small_enough(gone, BROADCAST_ROWS):
        gone = F.broadcast(gone)
    return kept.join(gone, uid, "left_anti").select(*docs.columns)

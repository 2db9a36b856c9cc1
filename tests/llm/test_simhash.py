"""SimHash components against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.llm.components import connected_components
from offerloom.llm.simhash import drop_near_duplicates, fingerprint_of, near_classes, simhash_components


def brute(values, bits):
    """Component number per value, by all pairs."""
    v = np.array(values, dtype=np.int64).view(np.uint64)
    root = list(range(len(v)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(v)):
        for j in range(i):
            if bin(int(v[i] ^ v[j])).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_components_link_what_all_pairs_link(spark, bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(-(2**63), 2**63 - 1, 12)
    values = [int(s) for s in seeds] + [0, -1]
    for _ in range(150):  # chains and clusters a few places apart
        x = int(values[rng.integers(len(values))])
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            x ^= 1 << int(b)
        x &= 2**64 - 1
        values.append(x - 2**64 if x >= 2**63 else x)
    values = sorted(set(values))
    want = brute(values, bits)
    found = {r.fp: r.root for r in near_classes(spark.createDataFrame([(v,) for v in values], "fp long"), bits).collect()}
    for i, v in enumerate(values):
        assert found.get(v, v) == values[want[i]]  # roots are least, and values ascend


def test_fingerprint_is_a_majority_of_shingle_hash_bits(spark):
    text = "One two  three\tfour FIVE\x0bsix é"
    words = ["one", "two", "three", "four", "five", "six", "é"]
    shingles = [" ".join(words[i : i + 3]) for i in range(5)]
    hashes = [
        r[0] & (2**64 - 1)
        for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()
    ]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > 2.5)
    assert fingerprint_of(text, 3) & (2**64 - 1) == want
    assert fingerprint_of("two words", 3) == fingerprint_of("TWO  words", 3) != 0
    assert fingerprint_of(None, 3) == fingerprint_of(" \n", 3) == 0


def test_rows_ties_and_nulls(spark, documents, rows_of):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long), (3, long), (3, long), (9, long + " tail"), (None, long), (8, None), (7, ""), (1, "other text here")]
    got = rows_of(simhash_components(documents(rows)).select("doc_id", "component_id"))
    near = 3 if bin((fingerprint_of(long, 3) ^ fingerprint_of(long + " tail", 3)) & (2**64 - 1)).count("1") <= 2 else 9
    want = [(5, 3), (3, 3), (3, 3), (9, near), (None, 3), (8, 7), (7, 7), (1, 1)]
    assert got == sorted(want, key=repr)
    kept = drop_near_duplicates(documents(rows))
    assert kept.columns == documents([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({1, 3, 7} | ({9} if near == 9 else set()))
    assert simhash_components(documents([])).count() == drop_near_duplicates(documents([])).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(101)} | {1000 + i: 1000 for i in range(60)}

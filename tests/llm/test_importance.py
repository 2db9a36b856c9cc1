"""Importance resampling against a version that writes every run out, and the rules for odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from offerloom.llm import importance
from offerloom.llm.importance import resample, runs, shift

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))


def buckets_of(text):
    w = words_of(text)
    return [zlib.crc32(b" ".join(w[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target, words=20, share=(5, 100)):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    more, less = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * more / ((s[b] + 1) * less))) for b in range(10000)]
    out = []
    for i, text in rows:
        found = buckets_of(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words_of(text))])
    enough = sorted((r for r in out if r[5] >= words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enough[: share[0] * len(enough) // share[1]], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in out]


def texts():
    random.seed(5)
    pool = ["the", "River", "of", "Größe", "x1", "...", "a-b", "\n", "\x00", "ÉTÉ", "日本", "z" * 70]
    return [" ".join(random.choice(pool) for _ in range(random.randint(0, 90))) for _ in range(150)]


def test_shift_composes_crcs():
    a, b = b"first part", b" and the rest of it" * 9
    got = shift(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)])) ^ np.uint32(zlib.crc32(b))
    assert int(got[0]) == zlib.crc32(a + b)


def test_runs_do_not_depend_on_the_blocks(monkeypatch):
    rows = [None, "", "one", "Two  words!", "a" * 5000 + " b " + "c" * 700, *texts()]
    for block in (importance.BLOCK, 150, 1):
        monkeypatch.setattr(importance, "BLOCK", block)
        got, n = [[] for _ in rows], [0] * len(rows)
        for places, found, own in runs(None if t is None else t.encode() for t in rows):
            for i, b in zip(places.tolist(), found.tolist()):
                got[i].append(b)
            for i in own.tolist():
                n[i] += 1
        assert [sorted(g) for g in got] == [sorted(buckets_of(t)) for t in rows]
        assert n == [len(words_of(t)) for t in rows]


def test_against_all_runs_written_out(spark, documents, rows_of):
    rows = [*enumerate(texts()), (900, None), (901, ""), (902, "the river " * 30_000), (None, "the river of " * 9), (7, "the x1 " * 15), (7, "the x1 " * 15)]
    target = ["the river of größe", None, "", "x1 x1"]
    bench = spark.createDataFrame([(t, "z") for t in target], "text string, doc_id string")
    assert rows_of(resample(documents(rows), bench)) == sorted(brute(rows, target), key=repr)
    assert rows_of(resample(documents(rows), bench, share=(1, 2), words=3)) == sorted(brute(rows, target, 3, (1, 2)), key=repr)


def test_empty_tables(spark, documents, rows_of):
    bench = spark.createDataFrame([], "text string")
    assert resample(documents([]), bench).collect() == []
    rows = [*enumerate(texts()[:30])]
    assert rows_of(resample(documents(rows), bench)) == sorted(brute(rows, []), key=repr)

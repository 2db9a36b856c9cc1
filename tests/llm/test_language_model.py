"""The language model: counts by brute force, probabilities that add up, a gain on held-out text."""

import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from offerloom.llm import language_model as lm

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def brute(rows):
    train = Counter()
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    number = lambda i: b"" if i is None else str(i).encode()
    for i, t in rows:
        if zlib.crc32(number(i)) % 5 != 1:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        own = tokens(t)
        base = sum(np.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        out.append((i, zlib.crc32(number(i)) % 5 == 1, len(own), sum(train[w] > 0 for w in own), n, round(base, 6)))
    return sorted(out, key=repr)


def found(df):
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return sorted([(*(r[k] for k in keys), round(r.base_score, 6)) for r in df.collect()], key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_counts_and_gain_on_held_out_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 2e-4)  # so that the join decides most tokens
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = lm.score_texts(docs).cache()
    assert found(scored) == brute([(r.doc_id, r.text) for r in docs.collect()])
    held = scored.where("held_out").toPandas()
    assert held.score.sum() > held.base_score.sum() + 0.05 * held.n_tokens.sum()


def test_probabilities_of_all_outcomes_add_up(spark):
    rows = [(i, f"a b{i % 7} a c{i} bb cc{i % 3}") for i in range(60)]
    counts = lm._counts(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    frequent, lm.FREQUENT = lm.FREQUENT, 5
    try:
        classes = lm._classes(counts)
    finally:
        lm.FREQUENT = frequent
    model = lm.LogBilinear.start(classes)
    back = lm.LogBilinear.of_rows(model.rows(), classes.size)
    assert all((getattr(model, k) == getattr(back, k)).all() for k in ("context", "target", "bias", "first", "second"))
    scorer = lm.Scorer(model, lm.normalisers(model, np.arange(classes.size + 1)))
    context = np.array([1, classes.size, 3], dtype=np.int32)
    for i, j in zip(context, context[::-1]):
        every = np.arange(classes.size, dtype=np.int32)
        p = np.exp(scorer.log_probabilities(np.full_like(every, i), np.full_like(every, j), every))
        assert abs(p.sum() - 1) < 1e-4
    inside = Counter()
    for r in counts.collect():
        k = classes.of(r.token)
        if k >= len(classes.own):
            inside[k] += (r.n + 0.5) / np.exp(classes.inner(k))
    for k, share in inside.items():
        assert abs(share + 0.5 / np.exp(classes.inner(k)) - 1) < 1e-9


def test_a_text_of_more_tokens_than_a_worker_remembers(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "CACHE", 5)
    monkeypatch.setattr(lm, "KNOWN", 0.05)
    rows = [(i, " ".join(f"w{j % (3 + 7 * i)}" for j in range(40))) for i in range(12)] + [(20, "the " * 50)]
    assert found(lm.score_texts(documents(rows))) == brute(rows)


def test_nulls_repeats_and_empty(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "A b\ta"), (4, "a  B"), (5, "é É x"), (7, "z " * 5000)]
    assert found(lm.score_texts(documents(rows))) == brute(rows)
    assert lm.score_texts(documents([])).count() == 0
    alone = [(i, "w") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    got = lm.score_texts(documents(alone))
    assert found(got) == brute(alone)


def test_words_of_all_texts_in_a_row(monkeypatch):
    texts = [None, " A\x1cb C\x85d\x0be\x0cf\rg ", "", "\u2003 É\u00a0é\tZ\x00", "   ", "\n", "x"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    expected = [(t or "").encode().lower().split() for t in texts]
    for size in (1, 7, 1000):
        monkeypatch.setattr(lm, "PIECE", size)
        found = [lm.tokens_of(piece.column("text")) for piece in lm._pieces(batch)]
        assert [w.encode() for words, _ in found for w in words.to_pylist()] == [w for own in expected for w in own]
        assert [n for _, sizes in found for n in sizes] == [len(own) for own in expected]


def test_a_worker_looks_up_all_tokens_of_a_piece():
    counts = {"the": 50, "a": 20, lm.END: 9, "zz": 5}
    classes = lm.Classes({lm.END: 0, "the": 1, "a": 2}, {"zz": 4, "é1": 5}, counts, np.ones(6), np.ones(6), 100, 30)
    texts = ["the zz zz1 É1x", None, "a q q zzz A", ""]
    rows = list(zip(*(c.to_pylist() for c in lm._Tokens(classes).columns(pa.array(texts)))))
    log = lambda *n: sum(np.log10(x + 0.5) for x in n)
    assert [r[:2] + (dict(zip(r[4].split(" "), r[5])), r[6]) for r in rows] == [
        (5, 3, {"zz1": 1, "É1x": 1}, [1, 4, 4, 3, 0]),
        (1, 1, {}, [0]),
        (6, 3, {"q": 2, "zzz": 1}, [2, 3, 3, 4, 2, 0]),
        (1, 1, {}, [0]),
    ]
    assert np.allclose([r[2] for r in rows], [log(50, 5, 9), log(9), log(20, 20, 9), log(9)])
    assert np.allclose([r[3] for r in rows], [log(5), 0, 0, 0])


def test_training_takes_the_plain_gradient_steps(monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 8)
    monkeypatch.setattr(lm, "NOISE", 5)
    size, n = 6, 21  # the last step is a short one
    classes = lm.Classes({str(k): k for k in range(size)}, {}, {}, np.arange(1.0, 7.0), np.zeros(size), 21, size)
    noise = (classes.totals + 0.5) / (classes.totals + 0.5).sum()
    r = np.random.default_rng(2)
    two, one, target = (r.integers(0, m, n).astype(np.int32) for m in (size + 1, size + 1, size))
    model = lm.LogBilinear.start(classes)
    names = ("context", "target", "bias", "first", "second")
    p = {k: getattr(model, k).astype(float) for k in names}
    model.train(two, one, target, noise, np.random.default_rng(9))
    drawn, kept = np.random.default_rng(9), {k: np.full_like(v, 1e-3) for k, v in p.items()}
    for at in range(0, n, lm.BATCH):
        rows = range(at, min(at + lm.BATCH, n))
        others = np.minimum(np.searchsorted(np.cumsum(noise), drawn.random(lm.NOISE)), size - 1)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for i, j, t in ((two[x], one[x], target[x]) for x in rows):
            h = p["context"][j] @ p["first"] + p["context"][i] @ p["second"]
            gh = np.zeros_like(h)
            for k, real in [(t, 1), *((k, 0) for k in others)]:
                e = (1 / (1 + np.exp(-(h @ p["target"][k] + p["bias"][k] - np.log(noise[k] * lm.NOISE)))) - real) / len(rows)
                gh += e * p["target"][k]
                g["target"][k] += e * h
                g["bias"][k] += e
            for name, c in (("first", j), ("second", i)):
                g[name] += np.outer(p["context"][c], gh)
                g["context"][c] += p[name] @ gh
        for k in names:
            kept[k] += g[k] ** 2
            p[k] -= lm.RATE * g[k] / np.sqrt(kept[k])
    for k in names:
        assert np.allclose(getattr(model, k), p[k], atol=2e-4), k

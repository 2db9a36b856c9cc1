"""Quality classifier: flat trees against a walk node by node, held-out accuracy, and the rules for odd rows."""

import math
import os
import zlib

import numpy as np
import pytest

from offerloom.llm import quality
from offerloom.llm.quality import STATISTICS, fit, score_quality, statistics

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
GOOD = "The river runs past the meadow, and {} gardens lie beyond it.\nIn summer the harvest is long; people walk there often."
JUNK = "BUY!!! NOW!!! ### {} *** $$$ || BUY!!! NOW!!! ### *** $$$ || BUY!!! NOW!!!"


def corpus():
    rows = [(i, (GOOD if i % 3 else JUNK).format("many " * (i % 17))) for i in range(300)]
    return rows, [(i, int(i % 3 > 0), "x") for i, _ in rows]


def walk(model, row):
    total = model.start
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def test_flat_trees_agree_with_a_walk_and_learn_an_interaction():
    random = np.random.default_rng(2)
    x = random.normal(size=(3000, 5)).astype(np.float32)
    x[:, 4] = np.round(x[:, 4])  # ties
    y = ((x[:, 0] > 0) ^ (x[:, 4] > 0)).astype(float)
    model = fit(x, y, trees=30, depth=3)
    p = model.probability(x)
    assert ((p > 0.5) == y).mean() > 0.97
    assert np.allclose(p[:200], [walk(model, r) for r in x[:200]])


def test_one_kind_of_label_gives_the_smoothed_share():
    assert np.allclose(fit(np.ones((9, 2)), np.ones(9)).probability(np.ones((3, 2))), 0.95)
    assert np.allclose(fit(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((3, 2))), 0.5)


def test_statistics_of_a_small_text(monkeypatch):
    got = dict(zip(STATISTICS, statistics(b"Ab ab\nab !! 12")))
    assert got["words"] == pytest.approx(math.log1p(5)) and got["kinds_of_words"] == pytest.approx(4 / 5)
    assert got["share_digit"] == pytest.approx(2 / 14) and got["letterless"] == pytest.approx(2 / 5)
    assert len(statistics(b"")) == len(statistics(b" \n ")) == len(STATISTICS)
    text = ("the river of the garden\n" * 3000).encode()
    whole = statistics(text)
    monkeypatch.setattr(quality, "PIECE", 1000)
    kept = [i for i, n in enumerate(STATISTICS) if n not in ("lines", "line_length", "packed", "first_line", "repeated_lines", "short_lines", "doubled")]
    assert np.allclose(statistics(text)[kept], whole[kept], rtol=1e-5)


def test_odd_rows(spark, documents):
    rows, labels = corpus()
    odd = [(1000, None), (1001, ""), (1002, GOOD.format("x") * 2000), (None, JUNK.format("")), (0, rows[0][1]), (0, rows[0][1])]
    known = spark.createDataFrame(labels + [(5, None, "x"), (None, 1, "x"), (7, 9, "x"), (4, 1, "x")], "doc_id long, quality int, text string")
    docs = documents(rows + odd)
    got = score_quality(docs, known).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 1000)
    assert {r.score for r in score_quality(docs, known.limit(0)).collect()} == {0.5}
    assert score_quality(documents([]), known).collect() == []


def test_sample_is_bounded_and_repeats_count_once(spark, documents):
    docs = documents([(1, "the river")] * 300 + [(3, f"garden {i} " * i) for i in range(40)])
    known = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    measured = quality._measured(docs)
    got = quality._sample(measured, known, "quality", 1000).collect()
    assert sum(r.y for r in got) <= 1 and len(got) <= 41
    assert quality._sample(measured, known, "quality", 10).count() <= 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = score_quality(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = found[found.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95

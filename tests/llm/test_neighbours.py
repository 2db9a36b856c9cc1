"""Neighbours: recall and order against brute force."""

import numpy as np
import pytest

from offerloom.llm import neighbours as nn


def brute(rows, k, every):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for at, (i, q) in enumerate(good):
        if i % every == 0:
            found = []
            for b, (j, v) in enumerate(good):
                if b != at and len(v) == len(q):
                    s = q @ v / np.linalg.norm(q) / np.linalg.norm(v)
                    found.append((-round(float(s), 9), j))
            out.setdefault(i, []).append(sorted(found)[:k])
    return out


def test_chi_square():
    assert abs(nn.chi_square(nn.chi_square_quantile(0.98, 8), 8) - 0.98) < 1e-9
    assert abs(nn.chi_square_quantile(0.95, 2) - 5.991464547) < 1e-6
    assert abs(nn.chi_square_quantile(0.95, 8) - 15.50731306) < 1e-6


@pytest.mark.parametrize("parts", [8192, 60])  # 60: cells of several parts
def test_recall_and_order(spark, monkeypatch, parts):
    monkeypatch.setattr(nn, "CELL_ROWS", 120)
    monkeypatch.setattr(nn, "PART_ROWS", parts)
    monkeypatch.setattr(nn, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24))
    rows = [(i, (centres[i % 20] + 0.5 * rng.normal(size=24)).astype("float32").tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)]  # one very common vector
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, uid int")
    got = {}
    for r in nn.nearest_neighbours(df, 5, 50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-round(r.score, 9), r.vec_id))
    want = brute(rows, 5, 50)
    assert got.keys() == want.keys() and all(len(v) == 5 and v == sorted(v) for v in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q][0]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert got[2000] == want[2000][0]  # ties to the smaller id


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 0.0]), (100, [1.0, 0.0, 0.0]), (0, [1.0, 0.0]), (8, [1e-200, 0.0])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for r in nn.nearest_neighbours(df, 5, 50).orderBy("query_id", "rank").collect():
        got.setdefault((r.query_id, r.rank), []).append((r.vec_id, round(r.score, 6)))
    assert got[(50, 1)] == [(1, 0.707107)] and got[(0, 1)] == [(0, 1.0)] * 2 and got[(0, 2)] == [(8, 1.0)] * 2
    assert not any(q == 100 for q, _ in got) and (50, 5) not in got
    assert nn.nearest_neighbours(df.limit(0)).count() == 0

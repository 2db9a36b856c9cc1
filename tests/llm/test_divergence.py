"""Source divergence against plain counting, with blocks, chunks and merges of any size, and the rules for odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from offerloom.llm import divergence
from offerloom.llm.divergence import audit_sources, share

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(rows, documents, top):
    docs, count = Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        words = [w.decode() for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))]
        count[lang or "", source or ""].update(words)
        docs.update({(lang or "", w) for w in words})
    out = []
    for lang in {g[0] for g in count}:
        kept = [t for (k, t), n in docs.items() if k == lang and n >= documents]
        sources = {s: c for (k, s), c in count.items() if k == lang}

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, ps = p(sum(sources.values(), Counter())), {s: p(c) for s, c in sources.items()}
        for s in sources:
            pairs = [(sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(ps[s][t] - q[t], t) for t in kept if sources[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


def corpus():
    random.seed(3)
    words = [w * k for w in ("the", "Maß", "river", "ÉTÉ", "été", "b") for k in (1, 2, 3)]
    rows = [
        (" 1,".join(random.choice(words) for _ in range(random.randint(0, 40))), random.choice(["en", "de", None, ""]), random.choice(["a", "b", "c", "é", None]))
        for _ in range(250)
    ]
    return rows + [(None, "en", "a"), ("", "en", "silent"), ("...", "lone", "a"), ("x", "lone", "b")] + [("the river the sea", "en", "hot")] * 120


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n long, term string")

    return make


def test_against_plain_counting(frame, rows_of):
    rows = corpus() + [("sea " * 40_000 + "the", "en", "long")]
    assert rows_of(audit_sources(frame(rows), documents=6, top=4)) == brute(rows, 6, 4)


def test_any_block_chunk_and_fan(frame, rows_of, monkeypatch):
    rows = corpus()
    for name, value in {"BLOCK": 40, "CHUNK": 3, "FAN": 2, "PAIRS": 3, "STEP": 4, "PIECE": 10}.items():
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(audit_sources(frame(rows), documents=6, top=4)) == brute(rows, 6, 4)


def test_without_kept_terms_or_rows(frame, rows_of):
    rows = corpus()
    got = rows_of(audit_sources(frame(rows), documents=10**6))
    assert got == brute(rows, 10**6, 50) and {(r[2], r[4]) for r in got} == {("pair", 0)}
    assert audit_sources(frame([])).collect() == []


def test_shares_are_exact_far_beyond_doubles(spark):
    cases = [(0, 0, 1), (10**16 + 1, 10**17 + 3, 10**6), (123456789012345678, 987654321098765432, 7)]
    df = spark.createDataFrame(cases, "n long, total long, terms long")
    got = [r[0] for r in df.select(share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in cases]

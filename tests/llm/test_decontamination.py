"""Benchmark windows against a scan of all places."""

import hashlib
import random
import re

from offerloom.llm.decontamination import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = set()
    for i, t in items:
        w = words(t)
        if w:
            windows |= {(i, tuple(w[k : k + 10])) for k in range(max(1, len(w) - 9))}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    found |= {str(i)} if i is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def tables(spark, documents, docs, items):
    return documents(docs), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, uid string")


def test_equals_brute_force(spark, documents, rows_of):
    rng = random.Random(5)
    vocabulary = ["a", "b", "É", "née", "x1", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 4, 3, 2, 11, 25])] + [(100, None), (101, "!?"), (8, "the end of it all")]
    items += [(10, items[0][1]), (None, "only here null item words stand")]
    docs = [(i, text(rng.randrange(0, 200))) for i in range(12)]
    docs += [(20, "lead " + items[0][1].upper() + "; tail"), (21, f"x, {items[1][1]}"), (22, None), (23, "")]
    docs += [(24, items[5][1]), (20, docs[0][1]), (None, items[0][1]), (25, "Only here: null item WORDS stand!")]
    docs += [(26, " ".join([items[8][1]] * 40)), (26, " ".join([items[8][1]] * 40))]
    d, b = tables(spark, documents, docs, items)
    assert rows_of(contamination(d, b)) == brute(docs, items)
    clean = {(i, t) for i, t in docs} - {(i, t) for i, t in docs if brute([(i, t)], items)[0][5]}
    kept = drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == clean


def test_empty_tables(spark, documents, rows_of):
    d, b = tables(spark, documents, [(1, "some words")], [])
    assert rows_of(contamination(d, b)) == brute([(1, "some words")], [])
    assert drop_contaminated(d, b).count() == 1
    d, b = tables(spark, documents, [], [(1, "some words")])
    assert contamination(d, b).count() == 0

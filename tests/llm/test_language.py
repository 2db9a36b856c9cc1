"""Language prediction: held-out accuracy on the given tables, and its rules."""

import os
import zlib

import numpy as np
import pytest

from offerloom.llm import language
from offerloom.llm.language import LanguageFilter, Predictor, gram_keys, identify_language

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


def test_gram_keys_stay_within_words():
    keys, word = gram_keys(["ab", "c"])
    # " ab ": a b / " a" ab "b " / " ab" "ab " / " ab "; " c ": c / " c" "c " / " c "
    assert np.bincount(word).tolist() == [8, 4]
    again, _ = gram_keys(["c"])
    assert set(again.tolist()) == set(keys[word == 1].tolist())


def test_masks_hold_every_gram_of_every_language():
    rng = np.random.default_rng(2)
    names = [f"l{i:03d}" for i in range(70)]  # two planes
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 3000))
    grams = {int(k): sum(1 << int(b) for b in set(rng.integers(0, 70, 3))) for k in keys}
    held = LanguageFilter(names, grams)
    places = held._places(np.array(list(grams), dtype=np.int64).view(np.uint64))
    masks = np.bitwise_and.reduce(held.table[places], axis=1)
    extra = 0
    for (low, high), want in zip(masks.tolist(), grams.values()):
        got = low | high << 64
        assert got & want == want
        extra += bin(got & ~want).count("1")
    assert extra <= 3 * held.false_rate.sum() * len(grams) + 20


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = identify_language(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_undecided_and_nulls(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    rows = [(i, "the cat sat on the mat", "en", "z") for i in range(8)] + [(20 + i, "der hund ist ein tier", "de", "z") for i in range(8)]
    rows += [(40, None, "en", "z"), (41, "123 !?", "de", "z"), (42, "", None, "z"), (None, "der hund", None, "z"), (43, "ein tier " * 60_000, None, "z")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify_language(spark.createDataFrame(rows, schema)).collect()}
    assert got[40] == got[41] == got[42] == ("und", 0.0)
    assert got[None][0] == got[43][0] == "de" and got[3][0] == "en"
    blank = spark.createDataFrame([(1, "some text", None, "z")], schema)
    assert tuple(identify_language(blank).first())[2:] == ("und", 0.0)
    assert identify_language(blank.limit(0)).count() == 0


def test_long_texts_between_short_ones(monkeypatch):
    keys, _ = gram_keys(["aba", "bab", "abba"])
    held = LanguageFilter(["x", "y"], {int(k): 1 + i % 3 for i, k in enumerate(np.unique(keys).view(np.int64))})
    letters = "abcdefghij"
    long = [" ".join(f"{a}{b}{c}" for a in letters for b in "ab" for c in letters[k:]) for k in range(3)]
    texts = ["aba bab", long[0], "abba", None, long[1], long[2], "bab ab", "aba bab", ""]
    want = [Predictor(held).predict([t])[0] for t in texts]
    monkeypatch.setattr(language, "CACHE", 40)
    predictor = Predictor(held)
    for _ in range(2):
        for (lang, score), (lang_wanted, score_wanted) in zip(predictor.predict(texts), want, strict=True):
            assert lang == lang_wanted and abs(score - score_wanted) < 1e-9

"""Toxicity: the decoder on known obfuscation, held-out accuracy, and the rules for odd rows."""

import os
import random
import re
import zlib

import pytest

from offerloom.llm.toxicity import _readings, CharacterModel, Restorer, Weigher, _character_counts, _token_words, _sample, drop_toxic, score_toxicity

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
BAD, GOOD = ["wretched", "villain", "scoundrel"], ["garden", "meadow", "river", "sunlight", "harvest", "the", "of", "and"]


def corpus():
    rows, labels = [], []
    for i in range(240):
        words = [GOOD[(i * k + k) % len(GOOD)] for k in range(1, 30)]
        toxic = i % 4 == 0
        if toxic:
            words[5], words[15] = BAD[i // 4 % 3], BAD[(i // 4 + 1) % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, documents):
    rows, labels = corpus()
    odd = [(1000, "you v1ll@in and the wr3tched river of the garden"), (1001, "a s c o u n d r e l of the meadow v.i.l.l.a.i.n"),
           (1002, "villllaaaain sc0undrel!!! and garden"), (1003, None), (1004, ""), (None, "the river"), (0, rows[0][1])]
    return documents(rows + odd), spark.createDataFrame(labels + [(5, None, "x"), (None, 1, "x")], "doc_id long, toxic int, text string")


def test_decoder_restores_words(tables):
    model = CharacterModel(_character_counts(tables[0]))
    for noisy, plain in {"v1ll@in": "villain", "wr3tch3d": "wretched", "sc0undrel": "scoundrel", "s-c-o-u-n-d-r-e-l": "scoundrel"}.items():
        assert plain in "".join(model.decode(noisy).split()) or plain in _token_words(noisy, model)
    assert _token_words("garden,", model) == ("garden",) and _token_words("1234", model) == ()


def test_scores_of_obfuscated_and_odd_rows(tables):
    docs, labels = tables
    got = score_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == 1 for i in (1000, 1001, 1002))
    assert all(by[i].predicted == 0 for i in (1003, 1004, None, 1, 2, 3))
    assert all(by[i].predicted == int(i % 4 == 0) for i in range(240))
    assert all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 3 == 1) for r in got)
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        r.doc_id or -1 for r in got if not r.predicted
    )


def test_without_labels_or_rows(spark, documents, tables):
    docs, labels = tables
    assert {r.score < 1e-9 for r in score_toxicity(docs, labels.limit(0)).collect()} == {True}
    assert score_toxicity(documents([]), labels).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = score_toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = found[found.held_out]
    wrong = held.predicted != held.toxic
    assert len(held) > 100 and wrong.mean() < 0.06
    assert (held.predicted[held.toxic == 0] == 1).mean() < 0.02


def read(weigher, text):
    """Letters that weigh in the reading of a text."""
    return weigher.inputs(text)[1] > 0


@pytest.fixture(scope="module")
def weigher(tables):
    model = CharacterModel(_character_counts(tables[0]))
    return Weigher(model, {"vil": 3.0, "villain$": 3.0, "scou": 3.0, "wret": 3.0})


def test_spaced_words_with_punctuation_and_mixed_separators(weigher):
    for noisy in ("v i l l a i n!", '"v i l l a i n"', "(v i l l a i n)", "v i.l l-a i.n", "the garden,v i l l a i n"):
        assert read(weigher, f"the {noisy} of the meadow"), noisy
    assert not read(weigher, "the meadow of the river and the garden, a b c")


def test_every_separator_and_cut_of_the_channel_is_decoded(weigher):
    noisy = ["v,i,l,l,a,i,n", "v'i'l'l'a'i'n", "v  i  l  l  a  i  n", "v\ni\nl\nl\na\ni\nn", "v\ti\tl\tl\ta\ti\tn", "v. i. l. l. a. i. n",
             "sc-oundrel", "s/coundrel", "wr.et.ched", "vi ll ai n", "v1 ll @i n", "sc oun dr el", "wr--etched"]
    for text in noisy:
        assert read(weigher, f"the {text} of the meadow"), text
    model = weigher.restorer.model
    assert model.decode("river-garden") == "river garden" or "river" in _token_words("river-garden", model)
    # the short cut for letters leaves out nothing that a full decoding finds
    full = Restorer(model)
    for text in [*noisy, "the and of a in", "ri ver", "do n't of the"]:
        runs = [run for _, run in full.spaced(text.split())]
        found = [w for run in runs for w in full.joined(run)]
        if any(weigher._most((w,)) for w in found):
            assert all(weigher._can_weigh(r) for r in runs)


def everything(weigher, text):
    """Weights of all tokens and all runs, without the gate."""
    tokens = text.lower().split()
    found = [weigher._most(_token_words(t, weigher.restorer.model)) for t in tokens]
    found += [weigher._most((w,)) for _, run in weigher.restorer.spaced(tokens) for w in weigher.restorer.joined(run)]
    return sorted(w for w in found if w)


def test_gate_hides_nothing(weigher):
    """Random noise of the channel's own characters around the words that weigh."""
    rng = random.Random(11)
    signs = list("abcdefilnorstuvw0134!|@$ .,-_*'~/&#%\n  ")
    words = ["villain", "scoundrel", "wretched", "v1lla1n", "vi ll ai n", "sc0undrel", "w-r-e-t", "vil&&& lain", "ViLLain!!", "vvil", "(vil", "1vil"]
    hits = 0
    for _ in range(1500):
        text = "".join(rng.choice(words) if rng.random() < 0.15 else rng.choice(signs) for _ in range(rng.randint(1, 40)))
        found, n = weigher.found(text)
        assert sorted(found) == everything(weigher, text), text
        assert n == len(text.split())
        hits += bool(found)
    assert hits > 500
    assert Weigher(weigher.restorer.model, {}).found("the villain") == ([], 2)


def readings(token):
    """All readings of a lattice, with the channel's cost, by enumeration."""
    out = [("", 0.0)]
    for m in re.finditer(r"(.)\1*", token + " ", re.S):
        out = [(a + b, s + c) for a, s in out for b, c in _readings(m[1], len(m[0]))]
    return out


def likelihood(model, text):
    score, state = 0.0, "  "
    for c in text:
        if c == " " and state[1] == " ":
            continue
        score += model.log(state + c)
        state = "  " if c == " " else state[1] + c
    return score


def test_decoder_finds_the_best_of_all_readings(tables):
    model = CharacterModel(_character_counts(tables[0]))
    for token in ("v1ll", "w-r3t", "g@rd3n", "r.i v", "s((0un", "aa11!", "v!!l", "1", "the", "--", "o n"):
        best = max(s + likelihood(model, t) for t, s in readings(token))
        got = model.decode(token)
        assert any(abs(s + likelihood(model, t) - best) < 1e-9 and t.strip() == got for t, s in readings(token)), token

def test_sample_of_repeated_ids_is_bounded(spark, documents):
    picked = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    docs = documents([(1, "the villain")] * 300 + [(2, f"garden {i}") for i in range(40)] + [(2, None), (4, "x")] * 3)
    got = _sample(docs, picked, 100).collect()
    assert len(got) == 42 and sum(r.toxic for r in got) == 1
    assert _sample(docs, picked, 10).count() == 10

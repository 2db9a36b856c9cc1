"""The corpus pipeline, stage by stage, against what each stage promises."""

import os

import pytest

import corpus_pipeline
from offerloom.llm import decontamination, simhash, toxicity
from offerloom.llm.common import stored

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_each_stage_on_what_its_predecessor_kept(spark):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    docs, kept = tables["documents"], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name)
        assert after.dtypes == docs.dtypes
        kept.append(after)
        docs = after
    before = [tables["documents"], *kept]
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in before]
    assert all(a >= b for a, b in zip(ids, ids[1:])) and len(ids[-1]) == before[-1].count()
    scores = toxicity.score_toxicity(before[0], tables["labels"]).where("predicted = 0")
    assert ids[1] == {r.doc_id for r in scores.collect()}
    assert ids[2] == {r.component_id for r in simhash.simhash_components(before[1]).collect()}
    clean = decontamination.contamination(before[2], tables["benchmark"]).where("not contaminated")
    assert ids[3] == {r.doc_id for r in clean.collect()} == ids[4]
    changed = before[3].selectExpr("doc_id", "text as t").join(before[4], "doc_id").where("t <> text")
    assert changed.where("text not like '%[SECRET]%' or n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).groupBy("doc_id").sum("length")
    assert {r.doc_id for r in pieces.collect()} == ids[4]
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows_pass_through_all_stages(spark, empty):
    """NULL in any column, empty and long texts, repeated rows and ids, and no rows at all."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    words = "the meadow and the river of a garden in the harvest "
    rows = [(1, None, None, None, None), (None, "a text", "en", "s", 6), (2, "", "en", "s", 0), (3, words * 3000, "en", "s", 1)]
    rows += [(4, words + "alone", "en", "s", 9)] * 3 + [(4, "another text of the same id", None, "t", 1)]
    docs = spark.createDataFrame([] if empty else rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name)
        assert after.dtypes == docs.dtypes and after.exceptAll(docs).count() == 0, name
        docs = after
    kept = docs.collect()
    if not empty:  # exact copies are one document; nothing else is like another
        assert {r.text for r in kept} >= {words * 3000, words + "alone", "a text", "another text of the same id"}
        assert sum(r.text == words + "alone" for r in kept) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert (pieces.count() == 0) == empty and pieces.count() >= len(kept)

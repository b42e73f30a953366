from __future__ import annotations

import corpus_pipeline
from parcelake.llm import decontaminate, language, near_duplicates, quality, queries, tables

SF = "/root/testdata/sf0.001"


def test_stages_in_order_on_what_is_left(spark):
    docs = tables.read(spark, SF, "documents")
    benchmark = tables.read(spark, SF, "benchmark")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_duplicates", "decontamination", "packing"]
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, tables.materialise(stage(spark, left, SF), name)
        assert left.columns == docs.columns and dict(left.dtypes) == dict(docs.dtypes)
        ids = {r["doc_id"] for r in left.collect()}
        if name == "language":
            expected = {r["doc_id"] for r in language.predict(before, language.fit(before))
                        .filter("lang_pred <> 'und' AND score >= 0.5").collect()}
        elif name == "quality":
            expected = {r["doc_id"] for r in quality.score(before).filter("kept").collect()}
        elif name == "near_duplicates":
            expected = {r["class_id"] for r in near_duplicates.join(before).collect()}
        else:
            expected = {r["doc_id"] for r in before.collect()} - {
                r["doc_id"] for r in decontaminate.contamination(before, benchmark).collect()}
        assert ids == expected and left.count() == len(ids)
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.collect()} == ids


def test_empty_corpus(spark, nothing, monkeypatch):
    left = nothing
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, SF)
    assert left.count() == 0


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(entry.queries())

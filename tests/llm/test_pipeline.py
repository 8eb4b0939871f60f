"""The pipeline stage by stage against plain versions of each decision."""

import corpus_pipeline
from tidewright.llm import decontaminate, near_dedup, quality_rules, source_mix
from tidewright.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    ids = {r.doc_id for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == columns + ["shard", "depth"] * (k == 4)
        out[name] = (before, docs)
    got = {n: {r.doc_id for r in d.collect()} for n, (_, d) in out.items()}
    verdict = {r.doc_id for r in quality_rules.quality_rules(out["quality_rules"][0]).where("kept").collect()}
    assert got["quality_rules"] == verdict < ids
    classes = near_dedup.near_duplicates(out["near_duplicates"][0]).collect()
    assert got["near_duplicates"] == {r.class_id for r in classes}
    leaks = {r.doc_id for r in decontaminate.contaminated(out["decontamination"][0], table(spark, SF, "benchmark")).collect()}
    assert got["decontamination"] == got["near_duplicates"] - leaks
    taken = {r.doc_id: (r.taken, r.size) for r in source_mix.mixed_sources(out["source_mix"][0]).collect()}
    times = {}
    for r in out["source_mix"][1].collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert all(abs(times.get(i, 0) - t / s) < 1 for i, (t, s) in taken.items())
    assert out["sharding"][1].count() == out["source_mix"][1].count()


def test_stages_on_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept int"
    odd = spark.createDataFrame([(None, None, None, None, None, None, None), (1, "a b", "x", "s", 3, "z", 1), (1, "a b", "x", "s", 3, "z", 1), (2, "", None, None, 0, None, None)], schema)
    for docs in (odd, spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF)
            assert set(docs.columns) <= set(result.columns) and result.count() <= 2 * docs.count()

"""The pipeline's stages in order, each on what the one before kept."""

import corpus_pipeline
from kontora.llm import line_runs, near_dups
from kontora.llm.common import documents

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "mixing sources", "SentencePiece encoding"]
    docs, columns = documents(spark, FOLDER), documents(spark, FOLDER).columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER).cache()
        assert after.columns == columns
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        if name == "line dedup":
            assert after.count() > 0 and line_runs.report(after).agg({"n_removed": "sum"}).first()[0] == 0  # nothing is left to remove
        if name == "MinHash near-dedup":
            assert all(r.kept for r in near_dups.report(after).collect())
        before = after
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() == before.count() and out.filter("not lossless").isEmpty()
    assert sorted(r.n_chars for r in out.collect()) == sorted(r.n_chars for r in before.collect())


def test_stages_take_no_rows(spark):
    docs = documents(spark, FOLDER).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []

"""Every query of the subpackage with SQL against DuckDB; the pipeline stage by stage."""

import pytest

import corpus_pipeline
from kartotek.llm import decontamination, ngram_join, pii, toxicity
from kartotek.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, data_dir, name):
    assert compare(spark, connect(data_dir), QUERIES[name], ORACLES[name], data_dir) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    extra = docs.limit(3).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars").unionByName(
        docs.limit(2)).unionByName(docs.limit(1).selectExpr("doc_id + 900000 AS doc_id", "CAST(NULL AS STRING) AS text", "lang",
                                                            "CAST(NULL AS STRING) AS source", "n_chars"))
    docs = docs.unionByName(extra)
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, data_dir)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        kept[name] = (before, after)
        before = after
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None)

    first, second = kept["toxicity"]
    machine = toxicity.fit(first, spark.read.parquet(f"{data_dir}/labels.parquet"))
    scores = toxicity.score(first, machine).collect()
    assert ids(second) == sorted(r.doc_id for r in scores if r.doc_id is not None and not r.predicted)
    first, second = kept["near duplicates"]
    groups = ngram_join.shingle_components(first, 5, 80).collect()
    assert ids(second) == sorted({r.component_id for r in groups if r.doc_id is not None})
    first, second = kept["decontamination"]
    bad = {r.doc_id for r in decontamination.leaks(first, spark.read.parquet(f"{data_dir}/benchmark.parquet")).collect()}
    assert ids(second) == [i for i in ids(first) if i not in bad]
    first, second = kept["personal data"]
    assert ids(second) == ids(first)
    assert not any(pii.base_spans(r.text or "") for r in second.collect())
    assert all(r.n_chars == len(r.text or "") for r in second.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, before, data_dir)
    drawn = {r.doc_id for r in last.collect()}
    assert drawn <= set(ids(before)) | {None} and len(drawn) > 0.7 * len(ids(before))


def test_pipeline_on_an_empty_table(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, data_dir).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, data_dir).collect() == []


def test_run_is_registered(spark, data_dir):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert corpus_pipeline.run(spark, data_dir).columns == ["doc_id", "source", "n_tokens", "epoch", "place"]

"""The registered queries against their SQL, and the pipeline against the operators one by one."""
import oracle_util as U
import pytest

import corpus_pipeline
from llm_fixtures import messy, messy_rows, nothing  # noqa: F401
from creditlens.llm import mixing, queries, simhash
from creditlens.sources.tables import Tables

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    ok, msg, _ = U.check(spark, queries.QUERIES[name], queries.ORACLE[name], SF_SMALL, digits=17, types=True)
    assert ok, msg


def test_pipeline(spark):
    t = Tables(spark, SF_SMALL)
    docs = t.documents
    quality = {r.doc_id for r in queries.op4_quality_rules(spark, SF_SMALL).where("kept").collect()}
    step = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    assert step.columns == docs.columns and {r.doc_id for r in step.select("doc_id").collect()} == quality
    once = corpus_pipeline.near_duplicates(spark, step, SF_SMALL)
    ids = {r.doc_id for r in simhash.near_duplicates(step).where("doc_id = component_id").collect()}
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.select("doc_id").collect()) == sorted(ids)
    clean = corpus_pipeline.benchmark_decontamination(spark, once, SF_SMALL)
    dirty = {r.doc_id for r in queries.op5_decontaminate(spark, SF_SMALL).where("contaminated").collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == ids - dirty
    mixed = corpus_pipeline.source_mixing(spark, clean, SF_SMALL)
    uses = {r.doc_id: r.uses for r in mixing.mix(clean).collect()}
    assert sorted(r.doc_id for r in mixed.select("doc_id").collect()) == sorted(i for i, n in uses.items() for _ in range(n))
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in mixed.select("doc_id").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_messy_and_empty_documents(spark, messy, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    for docs in (messy, nothing):
        out = stage(spark, docs, SF_SMALL)
        assert last or out.columns == docs.columns
        assert out.count() <= 2 * docs.count()

"""The registered queries of the subpackage, and the pipeline."""

import pytest

import __spark_entry__ as entry
import compare
import corpus_pipeline
from conftest import SF
from lakewarden.llm import registry


def test_each_operator_has_one_query():
    names = sorted(n for n in registry.queries() if n.startswith("op"))
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_same_rows_as_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rel = duck.execute(registry.oracles()[name])
    want = compare.canon(rel.fetchall(), [d[0] for d in rel.description])
    assert compare.canon([tuple(r) for r in df.collect()], df.columns) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
            docs = spark.createDataFrame(kept.collect(), docs.schema)
            after = {r.doc_id for r in docs.collect()}
            assert after <= before and len(after) == docs.count()
            before = after
    last = kept.collect()
    assert {r.doc_id for r in last} == before and all(r.intact and r.n_tokens == len(r.ids) for r in last)
    assert len(last) > 100


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100

import os

import pytest
from cases import SMALL, as_docs, messy_rows

import __spark_entry__
import corpus_pipeline
from cartwheel.llm import oracle, queries
from cartwheel.llm.common import stored

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver data missing")
FILTERS = corpus_pipeline.STAGES[:3]


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)


def test_every_query_is_registered():
    assert set(queries.registry()) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(oracle.registry()) <= set(__spark_entry__.oracle_sql())
    assert [int(n[2:].split("_")[0]) for n in queries.registry()] == list(range(1, 14))


def test_stages_equal_their_operators_on_what_is_left(spark, small_docs):
    from test_jaccard import brute

    docs = small_docs
    docs = stored(corpus_pipeline.language_id(spark, docs, SMALL), "t")
    assert docs.columns == small_docs.columns and docs.count() == small_docs.count()
    single = stored(corpus_pipeline.near_duplicates(spark, docs, SMALL), "t")
    want = {i for i, _, c in brute([(r.doc_id, r.text) for r in docs.collect()]) if i == c}
    assert ids(single) == sorted(want, key=repr)
    clean = stored(corpus_pipeline.decontamination(spark, single, SMALL), "t")
    assert set(ids(clean)) < set(ids(single))
    mixed = stored(corpus_pipeline.mix_sources(spark, clean, SMALL), "t")
    assert mixed.columns == small_docs.columns and set(ids(mixed)) <= set(ids(clean))
    out = corpus_pipeline.token_output(spark, mixed, SMALL).collect()
    assert sorted((r.doc_id for r in out), key=repr) == ids(mixed)


def test_run_twice(spark):
    once = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert once == sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert len(once) > 100


@pytest.mark.parametrize("rows", [messy_rows(), []], ids=["messy", "empty"])
def test_stages_take_awkward_documents(spark, rows):
    docs = as_docs(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == before or name == "token_output"
    assert (docs.count() > 0) == bool(rows)

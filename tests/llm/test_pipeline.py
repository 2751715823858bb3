"""The pipeline: every stage against what it promises, on the rows of the stage before."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stagewise.llm import toxicity
from stagewise.llm.shared import read_table, written
from tests.llm.test_operators import _components, _hits

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [read_table(spark, SF_DIR, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF_DIR)))
    return docs


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    for kept in stages[1:-1]:
        assert kept.schema == stages[0].schema
    for before, after in zip(stages, stages[1:], strict=False):
        assert ids(after) <= ids(before)


def test_toxic_documents_go(spark, stages):
    model = toxicity.fit_toxicity(stages[0], read_table(spark, SF_DIR, "labels"))
    scored = toxicity.score_toxicity(stages[0], model)
    assert ids(stages[1]) == ids(scored.where("toxicity < 0.5"))


def test_lines_keep_all_documents(stages):
    assert ids(stages[2]) == ids(stages[1])
    assert stages[2].where(F.col("n_chars") != F.length("text")).count() == 0


def test_one_document_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    assert ids(stages[3]) == {c for _, c in _components(rows, 5, 80).values()}


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    clean = {r.doc_id for r in stages[3].collect() if not _hits(r.text, items)[1]}
    assert ids(stages[4]) == clean


def test_mix_is_of_what_is_left(spark, stages):
    mix = stages[5]
    assert ids(mix) == ids(stages[4])
    size, taken = mix.agg(F.sum("size"), F.sum("taken")).first()
    assert abs(taken - 1.5 * size) <= 20


def test_run_gives_the_last_stage(spark, stages):
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stages[5].collect()))

"""Documents to a training mix, in five stages; each works on all that the stage before kept.

    run(spark, sf_dir)       all stages over ``documents``, each written as Parquet and read again
    STAGES                   (name, function of (spark, docs, sf_dir)) in order

All stages but the last return the columns of ``documents``; the last returns one row per document with
the words the mix takes from it and its positions in training. SQL cannot express the learned scores and
the components of the second and third stage, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.decontaminate import drop_contaminated
from stagewise.llm.jaccard import keep_one_each
from stagewise.llm.lines import dedup_line_runs
from stagewise.llm.mixing import mix_sources
from stagewise.llm.shared import read_table, written
from stagewise.llm.toxicity import fit_toxicity, score_toxicity

#: Near-duplicate stage: words of a shingle and percent of shared shingles.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``TOXIC_FROM`` by a model of all labelled documents."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.where(F.col(scored.columns[-1]) < TOXIC_FROM).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that an earlier place holds; ``n_chars`` follows the text."""
    left = dedup_line_runs(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def dedup_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_each(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, range-sorted by training position; ``readings`` holds all its positions."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_similar),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

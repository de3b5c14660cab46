"""The corpus pipeline: documents in, coded token ids out.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and all but the last return the columns of documents. Between stages the
documents are written as Parquet and read again, which also cuts the lineage.

Defined cases: verdicts hold for rows, so ids may be null, shared or repeated; equal rows are copies, of which one stays. A null or empty text, as one without a letter, goes in the first stage.
Very long texts are judged whole. Columns besides those of documents are kept up to the last stage. An empty table, or one of which nothing is kept, gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontamination, language_id, mixing, near_dedup, token_output
from quillmill.llm.common import materialize, new_path, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go: those without a letter, and those of 100 letters or more that are far from every language's profile. Profiles and the floor come from
    all learning documents, each read in both passes. Only sums by language and counts by step are shuffled."""
    names, prototypes = language_id.learn(docs, None)
    return language_id.keep_known(docs, names, prototypes, language_id.least_score(docs, names, prototypes, None))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays, of the smallest id; rows are told apart by a number of their own, as ids may be null or shared."""
    own = materialize(docs.withColumn("_row_of_stage", F.monotonically_increasing_id()), "rows")
    return own.join(near_dedup.copies(own, "_row_of_stage"), "_row_of_stage", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item's words go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' shares of the corpus become their targets: a row for each document and pass over it, with the words taken."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, coded, written and read back."""
    path = new_path(spark, "token-ids")
    token_output.write(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return token_output.read(spark, path)


def _bounded(stage: Stage) -> Stage:
    """The stage, in a session that hands texts to Python workers a thousand at a time: they may be long, and executors hold a batch for each task, twice."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", _bounded(language_stage)),
    ("near_dedup", _bounded(near_dedup_stage)),
    ("decontamination", _bounded(decontamination_stage)),
    ("mixing", _bounded(mixing_stage)),
    ("token_output", _bounded(output_stage)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Hyperdimensional language profiles and the coder have no SQL form.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}

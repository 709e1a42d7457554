"""The corpus pipeline: from raw documents to token files, in stages that are each stored as Parquet.

``STAGES`` lists the stages. Each takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept;
all but the last return the columns of ``documents``. Conventions for nulls, empty texts and repeated rows
are those of the operators: rows without an id pass the filters by id, empty tables pass as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkload.llm import mixing, quality
from sparkload.llm.common import stored
from sparkload.llm.decontaminate import without_passages
from sparkload.llm.neardup import one_of_each_class
from sparkload.llm.queries import END_ID, domain_labels
from sparkload.llm.tokenfiles import read_token_files, write_token_files
from sparkload.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged good and not toxic; those rejected go."""
    return quality.keep_good(docs, quality.fit_quality_model(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of smallest id."""
    return one_of_each_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_passages(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the languages' totals meet smoothed targets; none is dropped."""
    labelled = domain_labels(docs, _table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, mixing.fit_domain_model(docs, labelled))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending order of document id; a row for each document in them."""
    folder = scratch_dir(spark, "pipeline-token-files")
    files = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), folder, END_ID)
    return read_token_files(spark, files, folder)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_files),
]

# The classifiers and the tokenizer have no counterpart in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again for the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return docs

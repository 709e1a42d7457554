"""One query per operator, with production parameters, over the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import ann, licenses, mixing, quality
from .conversations import damaged, repair_report
from .decontaminate import find_passages
from .neardup import near_duplicate_classes
from .registry import ORACLES, QUERIES, query, table
from .secrets import scan_secrets
from .spans import remove_repeats
from .sql import LICENCES, NEAR_DUPLICATES, REPEATS
from .tokenfiles import read_token_files, write_token_files
from .tokens import count_tokens
from .treebpe import encode_documents
from .whitening import whitened_embeddings

__all__ = ["ORACLES", "QUERIES"]

END_ID = 2  # ends each document in the token files
NEAREST = 20


def document_path() -> Column:
    """A documents table as a tree: source, language, document."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.concat_ws("/", name("source"), name("lang"), name("doc_id"))


@query(LICENCES)
def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of the nearest directory with a licence file."""
    return licenses.scan_licences(table(spark, sf_dir, "documents"), document_path())


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; SQL has no counterpart, tests compare with the library."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its probabilities of being good and toxic; tests check held-out accuracy."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit_quality_model(docs, table(spark, sf_dir, "labels")))


@query()
def op4_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item in it; tests compare with the full distance table."""
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets in all documents with the forest's verdict; tests check held-out accuracy."""
    return scan_secrets(table(spark, sf_dir, "documents"), document_path())


@query(NEAR_DUPLICATES)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


@query(REPEATS)
def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated runs."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that have been labelled, with their language as domain."""
    known = docs.select("doc_id", F.col("lang").alias("domain"))
    return known.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


@query()
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document; tests check that the totals meet the targets."""
    docs = table(spark, sf_dir, "documents")
    return mixing.document_rates(docs, mixing.fit_domain_model(docs, domain_labels(docs, table(spark, sf_dir, "labels"))))


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back; tests compare with the library and check the round trip."""
    folder = scratch_dir(spark, "token-files")
    files = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, END_ID)
    return read_token_files(spark, files, folder)


@query()
def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors found for every twentieth; tests check the recall against all pairs."""
    index = ann.build_index(table(spark, sf_dir, "embeddings"))
    asked = index.rows.filter("id % 20 = 0").select("id", "v")
    index = ann.calibrate(index, asked, NEAREST)
    found = ann.search(index, asked, NEAREST)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation; tests compare with brute force."""
    rows = table(spark, sf_dir, "conversations")
    return repair_report(damaged(rows), rows)


@query()
def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of their decoding; tests compare with the library."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings; tests compare with a local computation."""
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))

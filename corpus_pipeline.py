"""Corpus pipeline: rules for quality, SimHash near-duplicates, benchmark passages, pseudonyms, packing.

In every stage null texts count as empty, rows with a null doc_id take part, an empty table gives an empty result, texts are
read whole, and further columns are passed on by all stages but the last, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chargelens.llm import packing, pseudonyms, quality, simhash, winnow
from chargelens.llm.common import stage, table
from chargelens.llm.queries import QUALITY_LEAST, fitted_quality, pseudonym_key


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules score 0.3 or more; others go, copies alike. An unlabelled corpus keeps all."""
    return quality.keep_good(docs, fitted_quality(docs, table(spark, sf_dir, "labels")), QUALITY_LEAST)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of linked fingerprints stays (nulls last); of rows with one doc_id the first as written."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a benchmark's passages make up less than a twentieth stay; exactly a twentieth goes."""
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, repeated rows each; validated personal values in its text are replaced. Null texts stay null."""
    return pseudonyms.pseudonymise(docs, pseudonym_key(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("pseudonyms", with_pseudonyms),
    ("packing", packed),
]

#: fingerprints by XXH64, fitted rules, keyed permutations and tokenizers are beyond SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs

"""The corpus pipeline: quality rules, near-duplicates, decontamination,
surrogates for personal data, packing. Each stage works on what its predecessor
kept, written as Parquet in between.

All stages but the last return the columns of documents: the first three drop
rows (rejected by the rules; not the first of their group of near-duplicates, at
five-word shingles and a similarity of 0.8; holding a benchmark item), the
fourth replaces personal data in the texts. The last returns the pieces of the
packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.common import read_table, written
from marquee.llm.decontamination import without_leaks
from marquee.llm.minhash import without_near_duplicates
from marquee.llm.packing import pack
from marquee.llm.pii import with_surrogates
from marquee.llm.quality_rules import keep_good
from marquee.llm.queries import ERROR, PII_KEY, RISK, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read_table(spark, sf_dir, "labels"), risk=RISK, error=ERROR)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_surrogates(docs, PII_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary(), seq_len=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("packing", packing),
]

# Shingle similarity, alignment, keyed surrogates and tokenising are beyond SQL;
# tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

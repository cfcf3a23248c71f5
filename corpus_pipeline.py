"""From documents to token ids in five stages: quality, near duplicates, repeated passages, benchmark leaks, pieces.

Each stage takes all that its predecessor kept. Null and empty texts pass the stages that compare texts (they equal
nothing) and are scored by the quality stage like any other text. Columns of documents beyond its own are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import decontam, neardup, pieces, quality, relz
from corvane.session import read, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the preference-ranked quality model rejects."""
    return quality.filter_good(docs.select(*COLUMNS), read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest doc_id."""
    return neardup.keep_one(docs.select(*COLUMNS))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words that an earlier place has as part of a run of 20 words; a text of which nothing is left goes."""
    return relz.cut_repeats(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, whole or edited."""
    return decontam.drop_leaks(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each document, and whether they decode to its text."""
    return pieces.encode(docs.select(*COLUMNS))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("pieces", piece_stage),
]

#: Trained scores, alignments and sampled pieces aren't expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

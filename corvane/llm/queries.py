"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.session import read


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.warc import archive_pages

    return archive_pages(read(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.decontam import leaks

    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.quality import quality_scores

    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.ann import nearest

    return nearest(read(spark, sf_dir, "embeddings"))


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.langid import languages

    return languages(read(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.pieces import encode

    return encode(read(spark, sf_dir, "documents"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.shards import shard_rows

    return shard_rows(read(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.relz import repeat_digest

    return repeat_digest(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corvane.llm.urls import judge, labelled_urls

    return judge(read(spark, sf_dir, "pages"), labelled_urls(spark))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from corvane.llm import sql

    return {"op1_warc": sql.ARCHIVE, "op2_near_duplicates": sql.NEAR, "op9_repeats": sql.REPEATS, "op10_url_filter": sql.URLS}

"""Strata and reproducible samples. Counts are exact; membership goes by a hash, not by a random generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: str, seed: int) -> Column:
    """A drawing order that any engine with MD5 can repeat."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def quantile_bands(rows: DataFrame, score: str, bands: int = 4, name: str = "band") -> DataFrame:
    """Right-closed bands between distinct interpolated quantiles, from 0; equal scores never part."""
    cuts = rows.agg(F.percentile(score, F.array(*[F.lit(i / bands) for i in range(1, bands)]))).first()[0] or []
    edges = sorted(set(cuts))
    band = sum((F.when(F.col(score) > e, 1).otherwise(0) for e in edges), F.lit(0))
    return rows.withColumn(name, F.when(F.col(score).isNotNull(), band))


def top_or_other(rows: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """The n commonest values, ties by name; others are 'other'."""
    top = rows.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(n).select(F.col(column).alias("_top"))
    return rows.join(F.broadcast(top), F.col(column) == F.col("_top"), "left").withColumn(name, F.coalesce("_top", F.lit("other"))).drop("_top")


def capped_sample(rows: DataFrame, strata: list[str], cap: int, key: str, seed: int = 0) -> DataFrame:
    """At most cap rows of each stratum. Each partition keeps its own best first, so a huge stratum doesn't move."""
    rows = rows.withColumn("_h", draw(key, seed))
    w = Window.partitionBy(*strata).orderBy("_h", key)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap).drop("_h", "_r")


def strata_report(rows: DataFrame, strata: list[str], cap: int) -> DataFrame:
    return rows.groupBy(*strata).agg(F.count("*").alias("available")).withColumn("sampled", F.least("available", F.lit(cap).cast("long")))


def shuffled(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    return rows.orderBy(draw(key, seed), key)


def cohort_cap(size: int, strata: int) -> int:
    return max(1, round(size / max(1, strata)))


def page(rows: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)

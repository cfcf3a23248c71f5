"""Current state from append-only logs: four rules that differ, and their audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_row(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The whole last row of each key. One shuffle with partial aggregation; no sort."""
    rest = [c for c in log.columns if c != key]
    best = log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, *[F.col("r")[c].alias(c) for c in rest])


def latest_values(log: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The last non-null value of each column, so a row can come from several events."""
    at = F.struct(*order)
    return log.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def latest_valid(log: DataFrame, key: str, order: list[str], valid: Column) -> DataFrame:
    """Invalid events are dropped before the last one is taken."""
    return latest_row(log.where(valid), key, order)


def first_row(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, *[F.col("r")[c].alias(c) for c in rest])


def retry_audit(log: DataFrame, key: str, order: list[str], error: Column) -> DataFrame:
    """Per key: events, errors, distinct outcomes, whether it ever failed and whether its last event did."""
    return log.withColumn("_e", error).groupBy(key).agg(
        F.count("*").alias("n_events"), F.count_if("_e").alias("n_errors"), F.max("_e").alias("ever_failed"), F.max_by("_e", F.struct(*order)).alias("still_failed")
    )


def not_done(work: DataFrame, log: DataFrame, key: str, done: Column) -> DataFrame:
    """Work whose key has no finished event."""
    return work.join(log.where(done).select(key).distinct(), key, "left_anti")

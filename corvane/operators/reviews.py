"""Review events folded into datasets, samples for reviewers, and the state of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators.latest import latest_values
from corvane.operators.sampling import draw


def second_review(rows: DataFrame, events: DataFrame, key: str, order: list[str], columns: list[str], prefix: str = "second_") -> DataFrame:
    """rows with each column's latest value that isn't null under a new name; what rows has stays as it is."""
    last = latest_values(events, key, order, columns).select(key, *[F.col(c).alias(prefix + c) for c in columns])
    return rows.join(last, key, "left")


def resolved(rows: DataFrame, resolutions: DataFrame, key: str, label: str, new: str) -> DataFrame:
    """Labels overridden by resolutions (null decides nothing; of several for a key the smallest counts), and whether that changed them."""
    j = rows.join(resolutions.groupBy(key).agg(F.min(new).alias("_new")), key, "left")
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(label))
    return j.withColumn("overridden", changed).withColumn(label, F.coalesce("_new", label)).drop("_new")


def term_status(candidates: DataFrame, events: DataFrame, term: str, decision: str, order: list[str], lists: dict[str, str]) -> DataFrame:
    """candidates with review_status and the list that the latest decision puts the term in; unknown decisions leave it pending."""
    last = events.groupBy(term).agg(F.max_by(decision, F.struct(*order)).alias("_d"))
    to = reduce(lambda w, d: w.when(F.col("_d") == d, lists[d]), lists, F.when(F.lit(False), ""))
    j = candidates.join(last, term, "left").withColumn("list", to).drop("_d")
    return j.withColumn("review_status", F.when(F.col("list").isNotNull(), "decided").otherwise("pending"))


def blind_sample(rows: DataFrame, key: str, label: str, sizes: dict, seed: int = 0) -> DataFrame:
    """So many rows of each label, in drawing order; ValueError if a label has fewer. Each draw is a distributed top-k."""
    have = {r[0]: r[1] for r in rows.where(F.col(label).isin(*sizes)).groupBy(label).count().collect()}  # a row for each label asked for
    short = {k: have.get(k, 0) for k, n in sizes.items() if have.get(k, 0) < n}
    if short:
        raise ValueError(f"too few rows: {short}")
    parts = [rows.where(F.col(label) == k).orderBy(draw(key, seed), key).limit(n) for k, n in sizes.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(draw(key, seed + 1), key)


def diversified(rows: DataFrame, strata: list[str], limit: int, key: str, seed: int = 0) -> DataFrame:
    """At most limit rows, at most ceil(limit / strata) of one stratum (nulls are one). Partitions keep only their own best."""
    n = rows.select(*strata).distinct().count()
    if not n:
        return rows
    w = Window.partitionBy(*strata).orderBy(draw(key, seed), key)
    capped = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= -(-limit // n)).drop("_r")
    return capped.orderBy(draw(key, seed), key).limit(limit)


def live_verdicts(cache: DataFrame, key: str, order: list[str], found: Column, at: str, cutoff: Column) -> DataFrame:
    """(key, found): the latest verdict of each key, if it is positive or not older than cutoff. Others have to be asked again."""
    last = cache.withColumn("_found", found).groupBy(key).agg(F.max_by(F.struct(F.col("_found").alias("found"), F.col(at).alias("at")), F.struct(*order)).alias("v"))
    return last.where(F.col("v.found") | (F.col("v.at") >= cutoff)).select(key, "v.found")


def run_status(events: DataFrame, group: str, at: str, total: int, window: int = 300, stall: int = 180) -> DataFrame:
    """For each group: events so far and in the window (seconds) before the newest event of all, minutes left, and whether it stalls."""
    now = F.col("_now")
    e = events.select(group, F.col(at).cast("timestamp").cast("double").alias("_t"))
    e = e.crossJoin(F.broadcast(e.agg(F.max("_t").alias("_now"))))  # one row
    out = e.groupBy(group).agg(F.count("*").alias("done"), F.count_if(F.col("_t") > now - window).alias("recent"), (F.first("_now") - F.max("_t")).alias("_age"))
    left = F.greatest(F.lit(total) - F.col("done"), F.lit(0)) * window / 60.0 / F.nullif("recent", F.lit(0))
    return out.select(group, "done", "recent", F.round(left, 3).alias("minutes_left"), (F.col("_age") > stall).alias("stalled"))


def incomplete(rows: DataFrame, fetched: str, expected: str, tolerance: float = 0.002) -> DataFrame:
    """rows with the relative gap between fetched and expected and whether it is within tolerance; nothing expected is complete at 0."""
    gap = F.when(F.col(expected) == 0, F.when(F.col(fetched) == 0, 0.0).otherwise(1.0)).otherwise(F.abs(F.col(fetched) - F.col(expected)) / F.col(expected))
    return rows.withColumn("gap", F.round(gap, 6)).withColumn("complete", gap <= tolerance)

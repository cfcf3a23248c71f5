"""Record identity: components over shared identifiers, and one record from each cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import table


def connected(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """(row_id, cluster): the smallest row of all that share an identifier, directly or not. Rows without one are alone.

    Labels pass from rows to identifiers and back until none changes; each round is two aggregates, so a common identifier costs no pairs.
    """
    pairs = table(rows.select(F.col(row_id).alias("row"), F.explode(F.array(*[F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in keys])).alias("value")).where("value is not null"), "pairs")
    labels = rows.select(F.col(row_id).alias("row"), F.col(row_id).alias("cluster"))
    while True:
        by_value = pairs.join(labels, "row").groupBy("value").agg(F.min("cluster").alias("cluster"))
        low = pairs.join(by_value, "value").groupBy("row").agg(F.min("cluster").alias("low"))
        low = low.join(labels.select(F.col("row").alias("low"), F.col("cluster").alias("jump")), "low", "left").select("row", F.least("low", "jump").alias("low"))
        after = table(labels.join(low, "row", "left").select("row", F.coalesce(F.least("cluster", "low"), "cluster").alias("cluster"), (F.col("low") < F.col("cluster")).alias("moved")), "clusters")
        labels = after.select("row", "cluster")
        if not after.where("moved").limit(1).count():
            return labels.withColumnRenamed("row", row_id)


def consolidate(rows: DataFrame, cluster: str, order: str, first: list[str], longest: list[str], lists: list[str]) -> DataFrame:
    """One row a cluster: first non-null, longest or united values."""
    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in first]
    aggs += [F.max_by(c, F.struct(F.length(c), -F.col(order))).alias(c) for c in longest]
    aggs += [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists]
    return rows.groupBy(cluster).agg(F.count("*").alias("n_rows"), *aggs)


def merged_label(rows: DataFrame, cluster: str, label: str) -> DataFrame:
    """'conflict' where a cluster has both labels, else its label or 'unlabelled'."""
    g = rows.groupBy(cluster).agg(F.max(F.col(label) == "positive").alias("p"), F.max(F.col(label) == "negative").alias("n"))
    p, n = F.coalesce("p", F.lit(False)), F.coalesce("n", F.lit(False))
    return g.select(cluster, F.when(p & n, "conflict").when(p, "positive").when(n, "negative").otherwise("unlabelled").alias("merged_label"))


def duplicate_groups(rows: DataFrame, row_id: str, key: str) -> DataFrame:
    return rows.groupBy(F.lower(key).alias("key")).agg(F.count("*").alias("n"), F.min(row_id).alias("keeper")).where("n > 1")

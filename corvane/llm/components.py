"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import table


def components(edges: DataFrame) -> DataFrame:
    """edges has long columns a and b. Returns (node, comp) for every node of an edge; comp is the component's smallest node.

    Each round takes the smallest label among a node and its neighbours, then that label's own label, so a chain of
    n nodes needs about log n rounds. A hub's labels meet in a partial aggregate, and AQE splits its join.
    No edge: no row. Loops and repeated edges change nothing; edges with a null end are left out.
    """
    e = edges.select("a", "b").where("a is not null and b is not null")
    both = table(e.union(e.select("b", "a")).distinct(), "edges")
    labels = table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        # each node hands its label to its neighbours and to its own label's node
        given = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.min("comp").alias("comp"))
        up = given.join(labels.select(F.col("node").alias("n2"), F.col("comp").alias("c2")), F.col("node") == F.col("n2")).select(F.col("c2").alias("node"), "comp")
        low = given.union(up).union(labels).groupBy("node").agg(F.min("comp").alias("low"))
        jump = low.join(low.select(F.col("node").alias("n2"), F.col("low").alias("l2")), F.col("low") == F.col("n2"), "left")
        after = table(jump.select("node", F.coalesce(F.least("low", "l2"), "low").alias("comp")), "labels")
        changed = after.join(labels.withColumnRenamed("comp", "old"), "node").where("comp <> old").limit(1).count()
        labels = after
        if not changed:
            return labels

"""Append-only event logs as streams. Late rows are never dropped: no query here has a watermark unless its caller gives one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corvane.operators.latest import latest_row


def read_log(spark: SparkSession, path: str, schema, files_a_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else r).parquet(path)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new events; the checkpoint makes a restart go on where it ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def new_only(stream: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """A stream without the keys that a table has."""
    return stream.join(done.select(key).distinct(), key, "left_anti")


MOVES = "part int, version long"


def maintain_latest(stream: DataFrame, key: str, order: list[str], path: str, checkpoint: str, parts: int = 16) -> StreamingQuery:
    """A last-event-wins table in parts by a hash of the key. A batch rewrites only the parts that it touches, each as a new version beside the old one, and then
    lists its parts in a file of moves, so a batch that fails or runs twice changes nothing. read_latest() reads it."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = latest_row(batch, key, order).withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        rows = rows.persist()
        touched = [r[0] for r in rows.select("part").distinct().collect()]  # parts at most
        versions = {p: v for p, v in _versions(spark, path, number).items() if p in touched}
        if versions:
            rows_all = rows.unionByName(_old(spark, path, rows.schema, versions))
        else:
            rows_all = rows
        final = latest_row(rows_all.drop("part"), key, order).withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
        final.write.mode("overwrite").partitionBy("part").parquet(f"{path}/v{number}")
        spark.createDataFrame([(p, number) for p in touched], MOVES).coalesce(1).write.mode("overwrite").json(f"{path}/moves/batch={number}")
        rows.unpersist()

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The newest version of each part, of batches before a number."""
    if not _exists(spark, f"{path}/moves"):
        return {}
    moves = spark.read.schema(f"{MOVES}, batch long").json(f"{path}/moves")
    moves = moves if before is None else moves.where(F.col("batch") < before)
    return {r[0]: r[1] for r in moves.groupBy("part").agg(F.max("version")).collect()}  # parts at most


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _old(spark: SparkSession, path: str, schema: T.StructType, versions: dict[int, int]) -> DataFrame:
    plain = T.StructType([f for f in schema.fields if f.name != "part"])
    out = None
    for p, v in sorted(versions.items()):
        one = spark.read.schema(plain).parquet(f"{path}/v{v}/part={p}").withColumn("part", F.lit(p))
        out = one if out is None else out.unionByName(one)
    return out


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that maintain_latest() keeps."""
    versions = _versions(spark, path)
    return _old(spark, path, schema, versions).drop("part") if versions else spark.createDataFrame([], schema)


def recent_rate(events: DataFrame, time: str, late: str | None = None) -> DataFrame:
    """Events in each five-minute window, every minute. The same for batches and streams; late bounds a stream's state, and drops what is later."""
    rows = events.withColumn("_t", F.col(time).cast("timestamp"))
    rows = rows.withWatermark("_t", late) if rows.isStreaming and late else rows
    return rows.groupBy(F.window("_t", "5 minutes", "1 minute").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def alerts(events: DataFrame, group: str, at: str, stall: int = 180) -> DataFrame:
    """Changes of a run's state, from its events alone: 'stalled' where the next event is more than stall seconds away, 'resumed' at that event, 'down' after an error and 'up' at the next event that isn't one.

    events also has ok (boolean). One window over each run's events.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(at)
    t = F.col(at).cast("timestamp").cast("double")
    e = events.select(group, at, "ok", (t - F.lag(t).over(w)).alias("_gap"), F.lag("ok").over(w).alias("_was"))
    late = F.col("_gap") > stall
    states = F.array_compact(F.array(F.when(late, "resumed"), F.when(~F.col("ok") & F.coalesce("_was", F.lit(True)), "down"), F.when(F.col("ok") & ~F.coalesce("_was", F.lit(True)), "up")))
    return e.select(group, at, F.explode(states).alias("alert"))


def copy_log(spark: SparkSession, path: str, to: str, schema, checkpoint: str) -> StreamingQuery:
    """New files of a log into another place, once each."""
    return ingest(read_log(spark, path, schema), to, checkpoint)

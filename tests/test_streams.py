"""Streams over event logs: restarts, late rows, and parts that stay as they are."""

from pathlib import Path

from pyspark.sql import functions as F

from corvane.streaming import log


def write(spark, path, rows):
    spark.createDataFrame(rows, "k long, at timestamp, v string").coalesce(1).write.mode("append").parquet(path)


def test_latest_takes_late_rows_and_rewrites_touched_parts_only(spark, tmp_path):
    from datetime import datetime

    t = lambda h: datetime(2024, 1, 1, h)
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    write(spark, src, [(k, t(5), "first") for k in range(20)])
    schema = spark.read.parquet(src).schema
    run = lambda: log.maintain_latest(log.read_log(spark, src, schema), "k", ["at"], out, check, 4).awaitTermination()
    run()
    write(spark, src, [(3, t(9), "new"), (3, t(1), "late")])
    run()
    run()
    got = {r.k: r.v for r in log.read_latest(spark, out, schema).collect()}
    assert got == {k: "new" if k == 3 else "first" for k in range(20)}
    assert len(list(Path(out, "v0").glob("part=*"))) == 4 and len(list(Path(out, "v1").glob("part=*"))) == 1


def test_rate_of_a_stream_drops_no_late_rows(spark, tmp_path):
    from datetime import datetime

    src = str(tmp_path / "src")
    write(spark, src, [(1, datetime(2024, 1, 5), "x")])
    write(spark, src, [(2, datetime(2023, 1, 1), "very late")])
    stream = log.read_log(spark, src, spark.read.parquet(src).schema, 1)
    q = log.recent_rate(stream, "at").writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("rates").agg(F.sum("n")).first()[0] == 10


def test_read_latest_of_nothing(spark, tmp_path):
    schema = spark.range(1).schema
    assert log.read_latest(spark, str(tmp_path / "none"), schema).count() == 0

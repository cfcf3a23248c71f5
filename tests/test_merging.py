"""Merges, reviews and repairs on small rows: nulls, ties, empty tables."""

import pytest
from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import merging, reviews


def test_first_of_batches(spark):
    schema = "b map<string, array<struct<_id: string, v: int>>>"
    rows = spark.createDataFrame([({"2": [("x", 1), (None, 2)], "1": [("x", 3), ("y", 4), (" ", 5)]},), (None,)], schema)
    found, left = merging.first_of_batches(rows, "b", "_id")
    assert sorted(map(tuple, found.collect())) == [("1", "x", 3), ("1", "y", 4)]
    assert sorted((r["batch"], r["v"]) for r in left.collect()) == [("1", 5), ("2", 2)]
    none, rest = merging.first_of_batches(rows.limit(0), "b", "_id")
    assert none.count() == rest.count() == 0


def test_migrate_there_and_back(spark):
    rows = spark.createDataFrame([(("1.0", 1),), (("0.9", 2),)], "doc struct<schema_version: string, a: int>")
    up = merging.migrate(rows, "doc", "licence", F.lit("unknown"), ("1.0", "1.1"))
    assert sorted(tuple(r.doc) for r in up.collect()) == sorted([("0.9", 2, None), ("1.1", 1, "unknown")])
    down = merging.migrate(up, "doc", "licence", F.lit("unknown"), ("1.0", "1.1"), reverse=True)
    assert sorted(tuple(r.doc) for r in down.collect()) == [("0.9", 2, None), ("1.0", 1, None)]


def test_duplicate_plan_kinds(spark):
    rows = spark.createDataFrame([("g", 1, "x"), ("g", 2, None), ("h", 3, "x"), ("h", 4, "y"), ("i", 5, "z"), ("i", 6, "z"), ("j", 7, "w")], "k string, id long, c string")
    got = {r.k: (r.keeper, r.losers, r.kind, r.disputed) for r in merging.duplicate_plan(rows, "k", "id", ["c"]).collect()}
    assert got == {"g": (1, 1, "mergeable", ""), "h": (3, 1, "conflicting", "c"), "i": (5, 1, "identical", "")}


def test_blind_sample_is_the_same_again_and_refuses_to_be_short(spark):
    rows = spark.range(100).select("id", (F.col("id") % 2).alias("label"))
    draw = lambda: [tuple(r) for r in reviews.blind_sample(rows.repartition(5), "id", "label", {0: 5, 1: 7}, 1).collect()]
    assert draw() == draw() and sum(x[1] for x in draw()) == 7 and len(draw()) == 12
    with pytest.raises(ValueError, match="too few"):
        reviews.blind_sample(rows, "id", "label", {0: 5, 2: 1})


def test_diversified_takes_nulls_as_a_stratum(spark):
    rows = spark.range(50).select("id", F.when(F.col("id") >= 45, F.lit(None)).when(F.col("id") < 40, "a").otherwise("b").alias("s"))
    got = reviews.diversified(rows, ["s"], 9, "id").groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"a": 3, "b": 3, None: 3}
    assert reviews.diversified(rows.limit(0), ["s"], 9, "id").count() == 0


def test_text_functions(spark):
    row = spark.createDataFrame([("# Head\n> see [the **label**](http://x.y) `code`-like\n- item", None)], "a string, b string")
    got = row.select(text.strip_formatting(F.col("a")), text.strip_formatting(F.col("b")), text.rendered("{a}|{b}", a=F.lit("x"), b=F.col("b")), text.in_batch(F.col("b"), ["x"], []), text.members(F.lit(None).cast("array<string>"), ["x"])).first()
    assert tuple(got) == ("Head\nsee the label code like\n  item", "", "x|", False, [])  # markup goes, white space stays
    with pytest.raises(ValueError, match="neither"):
        text.in_batch(F.col("a"), [], [])

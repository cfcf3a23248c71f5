"""The stages of the pipeline on odd rows, and each against what its operator says."""

import corpus_pipeline
from corvane.llm import decontam, neardup, quality

SF = "/root/testdata/sf0.001"


def test_stages_take_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.where("n_chars between 300 and 2000").orderBy("doc_id").limit(3).collect()
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, good[0].text, "en", "s", 5), (None, good[1].text + " more", "en", "s", 5), (9003, "y" * 200_000, "en", "s", 1), (9003, "y" * 200_000, "en", "s", 1)]
    more = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 as bucket", "true as gone", "2 as `odd.name`")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "substrings", "decontamination", "pieces"]
    rows = more
    for name, stage in corpus_pipeline.STAGES:
        rows.write.parquet(str(tmp_path / name)) if rows is not more else None
        rows = stage(spark, spark.read.parquet(str(tmp_path / name)) if rows is not more else more, SF)
        empty = stage(spark, more.limit(0), SF)
        assert empty.columns == rows.columns and empty.count() == 0
        if name != "pieces":
            assert rows.columns == corpus_pipeline.COLUMNS
    out = rows.collect()
    assert out and all(r.lossless for r in out)


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["quality"](spark, docs, SF).collect()}
    assert kept == {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    one = {r.doc_id for r in stages["near_duplicates"](spark, docs, SF).collect()}
    assert one == {r.doc_id for r in neardup.near_duplicates(docs).where("kept").collect()}
    clean = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    leaks = {r.doc_id for r in decontam.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert clean == {r.doc_id for r in docs.select("doc_id").collect()} - leaks and leaks


def test_filters_keep_columns_of_any_name(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    wide = docs.selectExpr("*", "1 as `a``b`", "2 as `c.d`", "3 as item_id")
    assert quality.filter_good(wide, docs, labels).columns == wide.columns
    assert decontam.drop_leaks(wide, bench).columns == wide.columns
    assert quality.filter_good(wide, docs, labels).count() == quality.filter_good(docs, docs, labels).count()


def test_many_null_ids(spark):
    rows = [(None, f"word{i % 40} of a text that {i % 40} others share with it") for i in range(400)] + [(5, "word3 of a text that 3 others share with it")]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 401 and [r.component_id for r in out if r.doc_id == 5] == [5] and sum(r.component_id == 5 for r in out) == 11

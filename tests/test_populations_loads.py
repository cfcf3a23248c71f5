"""Refusals, odd rows and empty tables of populations, loads, links, answers and sources."""

import pytest
from pyspark.sql import functions as F

from corvane.functions import links, text
from corvane.operators import answers, cascades, graphs, linking, loads, populations, sampling, steps, vectors, windows
from corvane.sources import tables


def test_staged_refuses_what_cannot_be_merged_back(spark):
    schema = "pid string, title string, abstract string, journal string, year int"
    ok = spark.createDataFrame([("a", "t", "x", "j", 1), ("b", "t", " ", "j", 1)], schema)
    assert [r.pid for r in populations.staged(ok).collect()] == ["a"]
    for bad in (ok.union(ok), ok.withColumn("pid", F.lit(" ")), ok.drop("journal")):
        with pytest.raises(populations.Refused):
            populations.staged(bad)
    assert populations.staged(ok.limit(0)).count() == 0


def test_scope_and_cost_refuse(spark):
    r = spark.createDataFrame([(1, "human_curated", "positive")], "id long, label_confidence string, label string")
    with pytest.raises(populations.Refused, match="no scope"):
        populations.scope("other", r, "id", r, r)
    with pytest.raises(populations.Refused, match="classification"):
        populations.in_scope(r, "id", None, "positives")
    with pytest.raises(populations.Refused, match="above"):
        populations.projected_cost(10_000, None, most=1.0)


def test_listed_fails_at_an_absent_id(spark):
    ids = spark.createDataFrame([(1, 0), (5, 1)], "id long, ord int")
    with pytest.raises(Exception, match="absent: 5"):
        populations.listed(ids, spark.range(3).withColumn("x", F.lit(1)), "id", "ord").collect()


def test_first_with_id_keeps_rows_without_one(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, " ")], "ord int, id string")
    assert sorted(map(tuple, populations.first_with_id(rows, "id", "ord").collect())) == [(1, "a"), (3, None), (4, " ")]
    assert populations.first_with_id(rows.limit(0), "id", "ord").count() == 0


def test_patches_with_repeated_keys_add_no_rows(spark):
    rows = spark.createDataFrame([(1, "k", None), (2, None, " "), (3, "z", "old")], "id long, k string, v string")
    patch = spark.createDataFrame([("k", "b"), ("k", "a"), (None, "n")], "value string, v string")
    assert sorted(map(tuple, cascades.fill(rows, patch, F.trim("k"), ["v"]).collect())) == [(1, "k", "a"), (2, None, " "), (3, "z", "old")]
    with pytest.raises(ValueError, match="already"):
        cascades.licences(rows.withColumn("license_checked", F.lit(True)), patch, patch)


def test_loads_refuse_before_they_write(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c")], "id long, v string")
    never = F.lit(False)
    with pytest.raises(loads.Refused, match="differ"):
        loads.load_plan(target, new, "id", never)
    with pytest.raises(loads.Refused, match="repeated"):
        loads.load_plan(target, new.union(new), "id", never, True)
    with pytest.raises(loads.Refused, match="malformed"):
        loads.load_plan(target, new, "id", F.col("v") == "c", True)
    assert loads.load_plan(target, new, "id", never, True) == {"inserted": 1, "identical": 0, "replaced": 1}
    with pytest.raises(loads.Refused, match="may not"):
        loads.planned(target, new.select("id", loads.given(F.col("v")).alias("v")), "id", set())
    with pytest.raises(loads.Refused, match="versions"):
        loads.release(target, "r", "v", [], "v")


def test_strict_json_fails_and_tolerant_does_not(spark):
    one = spark.createDataFrame([("[1", "x")], "a string, b string")
    assert one.select(text.json_list(F.col("a"))).first()[0] == []
    with pytest.raises(Exception, match="not a JSON list"):
        one.select(loads.strict_list("a")).collect()
    with pytest.raises(Exception, match="not a JSON object"):
        one.select(loads.strict_object("b", "struct<x: int>")).collect()


def test_malformed_links_stop_a_build(spark):
    rows = spark.createDataFrame([(1, [("geo", "GSE1,", None)])], "doc long, links array<struct<resource: string, id: string, url: string>>")
    assert linking.malformed(rows).first().problems == ["trailing punctuation"]
    with pytest.raises(Exception, match="malformed link in 1"):
        linking.checked(rows).collect()


def test_identifiers_of_odd_strings(spark):
    odd = [None, "", " ", "((((", "a" * 5000, " GSE1", "GSE1 x", "10.1/x"]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    got = [tuple(r) for r in df.select(links.cleaned(F.col("x")), links.publication(F.col("x"))["kind"], F.size(links.doi_candidates(F.col("x"))), links.canonical_url(F.col("x"), F.col("x"), F.col("x"))).collect()]
    assert [g[0] for g in got] == ["", "", "", "", "a" * 5000, "", "GSE1", "10.1/x"] and {g[1] for g in got} == {None} and {g[2] for g in got} == {0}


def test_empty_answers(spark):
    df = spark.createDataFrame([(None,), ("",), ("[]",), ("{}",)], "raw string")
    vocabulary = {"a": {"x": "X"}, "b": {"y": "Y"}}
    out = answers.parsed(df, "raw", ["a"], ["b"], vocabulary, {"a": 1, "b": 1}, {}).collect()
    assert [r.parse_status for r in out] == ["parse_error"] * 3 + ["ok"] and all(r.a == r.b == r.vocab_violations == [] for r in out)


def test_ancestors_of_cycles_and_strangers(spark):
    t = spark.createDataFrame([(1, [2]), (2, [1, 9]), (3, [2, 4]), (4, []), (5, None)], "id long, parents array<long>")
    out = {r.id: (r.ancestor, r.depth) for r in graphs.nearest_ancestor(t, spark.createDataFrame([(4,)], "id long")).collect()}
    assert out == {4: (4, 0), 3: (4, 1)}


def test_similarity_in_blocks_is_the_same(spark, monkeypatch):
    v = spark.createDataFrame([(i, [float(i % 5 + 1), float(i % 3), 1.0]) for i in range(40)] + [(90, [0.0, 0.0, 0.0]), (91, None)], "vec_id long, v array<double>")
    q = v.where("vec_id % 4 = 0 or vec_id > 80")
    whole = sorted(map(tuple, vectors.top_k(v, q, 3).collect()))
    monkeypatch.setattr(vectors, "SENT", 200)
    assert whole == sorted(map(tuple, vectors.top_k(v, q, 3).collect())) and len(whole) == 30


def test_terms_beyond_the_bound_are_refused(spark, monkeypatch):
    from corvane.operators import joins

    monkeypatch.setattr(joins, "MOST_TERMS", 2)
    docs, terms = spark.createDataFrame([(1, "Abc")], "id long, t string"), spark.createDataFrame([("a",), ("B",), ("c",)], "term string")
    with pytest.raises(ValueError, match="more than"):
        joins.containing(docs, "t", terms, "term", "id")
    assert [r.term for r in joins.containing(docs, "t", terms.limit(2), "term", "id").collect()] == ["a", "b"]


def test_windows_before_any_fetch(spark):
    empty = spark.createDataFrame([], windows.LEDGER)
    with pytest.raises(windows.Refused, match="nothing"):
        windows.plan_index(empty, 2020, "2021-01-01")
    assert sorted(r.year for r in windows.missing_years(empty, 2019, "2021-05-05").collect()) == [2019, 2020, 2021]


def test_steps_and_maps(spark):
    with pytest.raises(KeyError, match="no steps"):
        steps.Registry().run(["x"], {})
    assert steps.parallel_map(spark.range(0), "id", str, "string").collect() == []


def test_samples_are_the_same_again(spark):
    rows = spark.range(200).withColumn("s", F.when(F.col("id") % 7 > 0, F.col("id") % 3))
    draw = lambda n: sorted(map(tuple, sampling.capped_sample(rows.repartition(n), ["s"], 5, "id", 4).collect()))
    assert draw(3) == draw(7) and len(draw(2)) == 20


def test_readers_of_odd_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('PMCID\tPMID\nPMC1\t"12"\n\t\nx\tnan\n')
    assert [tuple(r) for r in tables.id_pairs(spark, str(tmp_path / "a.tsv"), "\t").collect()][0] == ("PMC1", "12")
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n[2]\n{"a": 3, "b')
    assert [r.a for r in tables.whole_lines(spark, str(tmp_path / "b.jsonl"), "a int").collect()] == [1]
    folder = tmp_path / "pdf"
    folder.mkdir()
    for n in ("PMC7_main.pdf", "PMC8_main.pdf", "other.pdf"):
        (folder / n).write_bytes(b"x")
    assert sorted(r.pmcid for r in tables.pdf_ids(spark, str(folder), "flat_main_pdf").collect()) == ["PMC7", "PMC8"]
    with pytest.raises(KeyError):
        tables.load_sources(spark, [{"kind": "none"}])

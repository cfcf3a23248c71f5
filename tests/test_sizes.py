"""Queries whose results went wrong on large tables or on several executors, on small tables that show it."""

from collections import Counter

import duckdb

from corvane.operators import linking
from corvane.plans import catalog


def both(spark, sf_dir, name, tables):
    c = duckdb.connect()
    for t in tables:
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet/*.parquet')")
    df = catalog.queries()[name](spark, str(sf_dir))
    columns = ", ".join(df.columns)
    return Counter(map(tuple, df.collect())), Counter(c.execute(f"select {columns} from ({catalog.oracle_sql()[name]})").fetchall())


def test_lexicon_does_not_depend_on_the_order_of_seeds(spark, monkeypatch, tmp_path):
    spark.createDataFrame([("SMALL BRUSHED", "Brand#11", 30), ("LARGE BRUSHED", "Brand#12", 3)], "p_type string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    make = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a, **k: make(self, rows[::-1], *a, **k))  # as the first to come may be any of them
    got, want = both(spark, tmp_path, "candidate_lexicon", ["part"])
    assert got == want and got["ECONOMY", "phrases+seed"] == got["seed only", "seed"] == 1


def test_entries_whose_ids_are_cut_alike_stay_apart(spark, tmp_path):
    keys = [100166, 1001666, 166, 1666, 1666, 100165, 1001650]
    spark.createDataFrame([(k, f"name {i}") for i, k in enumerate(keys)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k,) for k in (0, 165, 166, 1150, 1165, 1166)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got, want = both(spark, tmp_path, "entry_links", ["part", "customer"])
    assert got == want and sum(r[2] == "phs100166" for r in got) == 2


def test_entries_of_one_id_are_one_link_unless_told_apart(spark):
    entries = spark.createDataFrame([(k, "geo", "GSE7", t, None, ["PMID:5", "doi:10.1/x"]) for k, t in ((1, "a"), (2, "b"))], "n int, domain string, entry_id string, title string, page string, values array<string>")
    papers = spark.createDataFrame([(9, "5", None, "10.1/x")], "doc long, pmid string, pmcid string, doi string")
    domains = spark.createDataFrame([("geo", "geo", "IsSupplementedBy", "GEO")], "domain string, resource string, relationship string, publisher string")
    assert linking.from_entries(entries, papers, domains).count() == 1
    rows = linking.from_entries(entries, papers, domains, "n").collect()
    assert sorted(r.title for r in rows) == ["a", "b"] and {r.matched_by for r in rows} == {"pmid"}

import re
from itertools import combinations

import pytest

from corvane.llm.neardup import near_duplicates

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = {}
    for k, (d, _) in enumerate(rows):
        if sets[k] and d in ids and sets[ids[d]] == sets[k]:
            up[root(k)] = root(ids[d])
        ids.setdefault(d, k)
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if sets[k] and d is not None:
            least[root(k)] = min(d, least.get(root(k), d))
    return sorted(((d, len(s), c := (least.get(root(k)) if s else d), d == c) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(5, base), (3, base.upper()), (3, base.upper()), (9, base.replace("w40", "x")), (1, ""), (2, None), (4, " \t\n"), (6, "a b"), (7, "A  b"), (8, "a c"), (None, base)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, node int")
    assert got(df) == brute(rows)


def test_chain_needs_round_two(spark):
    # neighbours are linked, the ends aren't: no single centre links all
    w = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(w[4 * i : 4 * i + 60])) for i in range(20)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []

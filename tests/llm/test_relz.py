import hashlib
import re

import pytest

from corvane.llm import relz

SF = "/root/testdata/sf0.01"


def brute(rows):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    seen, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: (split[k][0] is None, split[k][0] or 0)):
        d, w = split[k]
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            x = tuple(w[i : i + 20])
            if x in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(x)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, size):
    docs = df.select("doc_id", "text")
    return sorted(map(tuple, relz.repeats(docs, relz.digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", size).collect()), key=str)


@pytest.mark.parametrize("size", [40_000, 400_000, 8 << 20])
def test_equals_brute_force(spark, size):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(docs, size) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(70)), " ".join(f"b{i}" for i in range(25))
    rows = [(4, a), (2, "x " + a[4:200]), (2, "x " + a[4:200]), (7, f"{b}\t{a}  {b}"), (None, a), (1, ""), (3, None), (9, "same " * 50), (8, " ".join(["é"] * 19)), (10, "y" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 1 << 20) == brute(rows)
    cut = {r.doc_id: r for r in relz.cut_repeats(df.selectExpr("doc_id", "text", "1 as part", "2L as n_chars").where("doc_id <> 2")).collect()}
    assert cut[7].text == b and cut[7].n_chars == len(b) and cut[7].part == 1 and cut[4].text == a and cut[3].text is None and cut[9].text.startswith("same")
    found = {(r.doc_id, r.first_word, r.n_words) for r in relz.repeat_spans(df).collect()}
    assert (7, 25, 95) in found and (9, 0, 50) not in found


def parse(rows):
    """The same greedy parse by dictionaries: the earliest place of each window, factors, and windows across their boundaries."""
    split = sorted((d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows)
    place = {}
    for d, w in split:
        for i in range(len(w) - 19):
            place.setdefault(tuple(w[i : i + 20]), (d, i))
    out = []
    for d, w in split:
        copied = [place[tuple(w[i : i + 20])] if place[tuple(w[i : i + 20])] < (d, i) else None for i in range(len(w) - 19)]
        i = 0
        while i < len(copied):
            if copied[i] is None:
                i += 1
                continue
            (ref, at), n = copied[i], 20
            while i + n - 19 < len(copied) and copied[i + n - 19] == (ref, at + n - 19):
                n += 1
            out.append((d, i, n, ref, at, False))
            out += [(d, k, 20, *copied[k], True) for k in range(i + n - 19, min(i + n, len(copied))) if copied[k]]
            i += n
    return sorted(out)


@pytest.mark.parametrize("size", [60_000, 8 << 20])
def test_factors_equal_a_brute_force_parse(spark, size):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    a, b = " ".join(f"a{i}" for i in range(70)), " ".join(f"b{i}" for i in range(60))
    rows += [(1001, a), (1002, b), (1003, a[:180] + " " + b[40:200]), (1004, b[80:] + " " + a + " x " + a), (1005, "same " * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in relz.repeat_factors(df, size).collect())
    want = parse(rows)
    assert found == want and any(f[5] for f in want) and any(f[2] > 20 for f in want)


def test_factors_hold_the_words_they_copy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in docs.collect()}
    for r in relz.repeat_factors(docs, 300_000).collect():
        assert (r.ref_doc_id, r.ref_word) < (r.doc_id, r.first_word)
        assert words[r.doc_id][r.first_word : r.first_word + r.n_words] == words[r.ref_doc_id][r.ref_word : r.ref_word + r.n_words]


def test_words_of_regular_patterns_are_told_apart(spark):
    thue = "".join("ab"[i.bit_count() & 1] for i in range(2048))
    other = thue.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{thue} " * 25), (2, f"{other} " * 25), (3, f"{thue[:200]} " * 25), (4, f"{other[:200]} " * 25)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 1 << 20) == brute(rows)


def test_cut_keeps_columns_of_any_name(spark):
    a = " ".join(f"a{i}" for i in range(30))
    rows = [(1, a, 7, True, "x", 1.5), (2, "b " + a, 8, False, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int, gone boolean, `a``b` string, key double")
    out = relz.cut_repeats(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [rows[0], (2, "b", 8, False, None, None)]


def test_empty(spark):
    assert relz.repeat_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []

"""Queries whose parts hold few rows."""

from collections import Counter

import numpy as np

from corvane.llm import ann


def answers(rows, every, k=5):
    """Brute force: of an id's rows the smallest vector asks and the nearest answers."""
    out = {}
    for q in {i for i, _ in rows if i % every == 0}:
        x = np.array(min(v for i, v in rows if i == q))
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = max(best.get(i, -2), float(np.dot(x, v) / np.linalg.norm(x) / np.linalg.norm(v)))
        out[q] = [i for _, i in sorted((-round(s, 12), i) for i, s in best.items())[:k]]
    return out


def found(df, **how):
    out = {}
    for r in sorted(ann.nearest(df, **how).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_repeated_ids_leave_room_for_others(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 8)))]
    rows += [rows[7]] * 300 + [(7, v.tolist()) for v in rng.normal(size=(40, 8))] + [(20, v.tolist()) for v in rng.normal(size=(30, 8))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, every=10, target=1.0, parts=1) == answers(rows, 10)
    few = [(0, [1.0, 0.0]), (1, [1.0, 0.1])] * 50 + [(2, [0.0, 1.0]), (1, [0.9, 0.1])]
    assert found(spark.createDataFrame(few, "vec_id long, embedding array<double>"), every=1) == answers(few, 1)


def test_blocks_and_slices_of_a_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(6).normal(size=(900, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, every=2, parts=1) == answers(rows, 2)


def test_parts_grow_with_the_table():
    assert [ann.parts_of(n) for n in (0, 10_000, 32 * 16384, 33 * 16384, 10**12)] == [32, 32, 32, 33, 256]


def test_no_structure_and_many_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 60)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(7).normal(size=(6000, 12)))]
    got, want = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50), answers(rows, 50)
    assert ann.parts_of(6000) == 100 and got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_a_query_has_k_rows_however_few_its_parts_hold(spark, monkeypatch):
    class Uneven:
        """One probe; some 90 rows lie thinly in 31 parts, all others in the last."""

        def __init__(self, x, parts):
            self.parts = parts

        def probes(self, *a):
            return 1

        def ranked(self, x, many):
            first = [int(abs(v[0]) * 1e4) % 31 if abs(v[0]) > 2 else 31 for v in x]
            return np.array([np.roll(np.arange(32), -p) for p in first])[:, : min(many, 32)]

    monkeypatch.setattr(ann, "Router", Uneven)
    rows = [(i, x.tolist()) for i, x in enumerate(np.random.default_rng(8).normal(size=(2000, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    many = Counter(r.query_id for r in ann.nearest(df, every=1, parts=32).collect())
    assert len(many) == 2000 and set(many.values()) == {5}

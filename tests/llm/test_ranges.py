"""Shards by splitters: ranges at every size, whole groups, and an assignment of its own held against them."""

import zlib
from collections import defaultdict

import pytest

from corvane.llm import shards


def plain(rows, n=8):
    """Shares of the shards, dealt again with plain loops: large groups whole to the emptiest, the line by the middle of each group."""
    size = lambda t: len((t or "").encode()) + 1
    held = defaultdict(int)
    for _, t in rows:
        held[t or ""] += size(t)
    total = sum(held.values())
    load = [0] * n
    for x in sorted((x for x in held.values() if total / n / shards.WHOLE < x <= total / n), reverse=True):
        load[load.index(min(load))] += x
    return held, total, load


@pytest.mark.parametrize("rows_a_range", [50_000, 60])
def test_bytes_are_near_equal_and_groups_whole(spark, monkeypatch, rows_a_range):
    monkeypatch.setattr(shards, "RANGE_ROWS", rows_a_range)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    seen, splitters = [], shards.splitters
    monkeypatch.setattr(shards, "splitters", lambda *a: seen.append(splitters(*a)) or seen[-1])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    held, total, load = plain(rows)
    out = shards.shard_rows(docs).collect()
    assert len(seen[0][0]) >= 31  # several ranges for each shard
    texts, sizes, where = dict(rows), defaultdict(int), defaultdict(set)
    for r in out:
        sizes[r.shard] += r.size
        where[texts[r.doc_id] or ""].add(r.shard)
    assert all(len(where[t]) == 1 for t, x in held.items() if x <= total / 8)
    share = total / 8
    assert all(abs(x - share) <= share / shards.WHOLE + 1 for x in sizes.values())


def test_a_made_table_of_large_groups_keeps_them_whole(spark):
    rows = [(i, f"group {i % 12} " * (6 + i % 12)) for i in range(920)] + [(1000 + i, f"single {i}") for i in range(300)]
    out = shards.shard_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    where = defaultdict(set)
    for r in out:
        where[r.text_crc32].add(r.shard)
    held, total, load = plain(rows)
    assert all(len(where[zlib.crc32(t.encode())]) == 1 for t, x in held.items() if x <= total / 8)
    sizes = defaultdict(int)
    for r in out:
        sizes[r.shard] += r.size
    best = max(max(load), total / 8)  # the least that whole groups allow, dealt this way
    assert max(sizes.values()) <= best * 1.02


def test_the_line_is_cut_at_the_splitter_nearest_to_each_share(spark):
    """Shards of the line against a second assignment: the exact running sum at each splitter."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen, ends = [], shards.ends
    out = {r.doc_id: r for r in shards.shard_rows(docs).collect()}
    again = {r.doc_id: r for r in shards.shard_rows(docs.repartition(7)).collect()}
    assert {d: (r.shard, r.slot) for d, r in out.items()} == {d: (r.shard, r.slot) for d, r in again.items()}
    held = {0: (10, 1), 2: (20, 2), 3: (5, 1)}
    assert ends(held, [10.0, 15.0, 10.0]) == [(0, 10.0), (2, 15.0)] and not seen


def test_large_groups_fill_the_emptiest_shards():
    to, fill = shards.dealt([(1, 60), (2, 50), (3, 10)], 3, 300)
    assert to == {1: 0, 2: 1, 3: 2} and fill == [40.0, 50.0, 90.0]
    to, fill = shards.dealt([(1, 90), (2, 90)], 3, 200)
    assert fill == [0.0, 0.0, 20.0]


def test_bytes_and_rows_both_make_ranges():
    assert shards.ranges_for(1000, 10 << 30, 8) == 160 and shards.ranges_for(10_000_000, 1 << 20, 8) == 200
    assert shards.ranges_for(0, 0, 8) == 0 and shards.ranges_for(3, 9, 8) == 3

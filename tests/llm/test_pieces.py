import math
from collections import Counter

import numpy as np
import pytest

from corvane.llm import pieces
from corvane.llm.words import mix


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def cut(v, texts, keys, seed=0):
    raw = [t.encode() for t in texts]
    offs = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    ids, at = pieces.sample(v, np.frombuffer(b"".join(raw), np.uint8), offs, mix(np.array(keys, np.int64).view(np.uint64)), seed)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


ODD = ["", " ", "  two  spaces ", "a\tb\nc\r\n", "▁marker ▁", "naïve Straße 東京 \U0001f600", "x" * 1000, "é" * 333, " " * 500, "\x00\x7f", "The cat sat. " * 40]


def test_lossless_and_reproducible(vocabulary):
    v = vocabulary
    for seed in (0, 7):
        found = cut(v, ODD, range(len(ODD)), seed)
        for t, ids in zip(ODD, found, strict=True):
            assert b"".join(v.text[i] for i in ids).decode() == t
        assert [cut(v, [t], [k], seed)[0] for k, t in enumerate(ODD)] == found
    assert cut(v, ODD, range(len(ODD)), 0) != cut(v, ODD, range(len(ODD)), 7)


def test_draws_follow_the_lattice(vocabulary):
    v, text = vocabulary, " there"
    vocab = {t: i for i, t in enumerate(v.text) if t and i not in set(v.byte_ids.tolist())}

    def ways(s):
        return [[]] if not s else [[vocab[s[:k]], *w] for k in range(1, len(s) + 1) if s[:k] in vocab for w in ways(s[k:])]

    exact = {tuple(w): math.prod(v.weight[i] for i in w) for w in ways(text.encode())}
    total, n = sum(exact.values()), 20_000
    seen = Counter(map(tuple, cut(v, [text] * n, range(n))))
    assert set(seen) <= set(exact)
    for w, x in exact.items():
        p = x / total
        assert abs(seen[w] - n * p) <= 6 * math.sqrt(n * p * (1 - p)) + 3


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = pieces.encode(docs)
    assert out.where("not lossless").count() == 0
    rows = {r.doc_id: r for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in pieces.decode(out).collect()} == texts
    assert {r.doc_id: r.ids for r in pieces.encode(docs.repartition(5)).collect()} == {k: r.ids for k, r in rows.items()}
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (None, "a b", 0)], "doc_id long, text string, ids int")
    got = {(r.doc_id, tuple(r.ids) if r.ids is not None else None, r.lossless) for r in pieces.encode(odd).collect()}
    assert (1, None, True) in got and (2, (), True) in got and len(got) == 3
    assert pieces.encode(odd.limit(0)).collect() == []

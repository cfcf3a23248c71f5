"""Leaks that common or missing word runs must not hide."""

import math
import random

from corvane.llm import decontam


def test_an_edited_copy_in_many_documents_is_found(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    item = rng.choices(vocab, k=30)
    copy = [f"new{i}" if i in (4, 9, 14, 19, 24) else w for i, w in enumerate(item)]
    held = {"whole": copy, "first": item[:17], "rest": item[13:]}  # each in far more than 50 documents
    docs = []
    for name in held:
        for _ in range(120):
            w = rng.choices(vocab, k=60)
            w[20:20] = held[name]
            docs.append((len(docs), " ".join(w)))
    docs += [(len(docs) + k, " ".join(rng.choices(vocab, k=60))) for k in range(100)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontam.leaks(docs_df, bench).collect()} == set(range(360))
    assert {r.doc_id for r in decontam.drop_leaks(docs_df, bench).collect()} == set(range(360, 460))


def smith_waterman(a, b):
    best, row = 0.0, [0.0] * (len(b) + 1)
    for x in a:
        new = [0.0]
        for j, y in enumerate(b):
            new.append(max(0.0, row[j] + (1 if x == y else -0.5), row[j + 1] - 0.5, new[j] - 0.5))
        best, row = max(best, *new), new
    return best / len(a)


def test_leaks_are_all_of_the_real_threshold(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(400)]
    items = {k: rng.choices(vocab, k=n) for k, n in enumerate((12, 12, 30, 30, 7, 4, 2, 45))}
    gone = lambda t, at: [f"new{i}" if i in at else w for i, w in enumerate(t)]
    spaced = lambda t, k: [x for i, w in enumerate(t) for x in ([w, f"new{i}"] if i % k == k - 1 else [w])]
    copies = [gone(items[0], (3, 6, 9)), spaced(items[2], 2), spaced(items[2], 1), gone(items[3], range(2, 30, 3)), spaced(items[7], 2)]
    for _ in range(150):
        t = list(rng.choice(list(items.values())))
        for _ in range(rng.randrange(len(t))):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randrange(2)] = rng.choices(vocab, k=rng.randrange(2))
        copies.append(t)
    docs = []
    for d, t in enumerate(copies):
        w = rng.choices(vocab, k=rng.randrange(60))
        at = rng.randrange(len(w) + 1)
        w[at:at] = t
        docs.append((d, " ".join([*w, "end"])))
    exact = {(d, k): smith_waterman(t, x.split()) for d, x in docs for k, t in items.items()}
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")
    for threshold in (0.5, 0.7):
        found = {(r.doc_id, r.item_id): r.score for r in decontam.leaks(docs_df, bench, threshold).collect()}
        assert found.keys() == {p for p, s in exact.items() if s >= threshold}
        assert all(math.isclose(s, exact[p]) for p, s in found.items())
    assert {(0, 0), (1, 2), (2, 2), (3, 3), (4, 7)} <= {p for p, s in exact.items() if s >= 0.5}

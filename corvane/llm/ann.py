"""Approximate nearest neighbours by learned partitions.

On a bounded sample (EACH vectors a part, by a hash of vec_id) a neighbour graph is built and cut into balanced parts that
keep neighbours together. There are PARTS parts, and more for tables of more than PARTS blocks, MOST at most. A small classifier then learns from a vector which parts its neighbours lie in. Every vector is
indexed in its most probable part, a query goes to its several most probable parts, and all vectors there are ranked by
their exact cosine in double precision. How many parts is measured: a quarter of the sample is kept out of the learning,
and the fewest parts that find TARGET of its neighbours are taken (vectors without structure need most parts). Parts are searched in
blocks of bounded size, and so are the queries that a part is asked: a part with a third of all vectors is many tasks, each hands
on its best few, and only rows of a part with more than a block of queries are sent more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import ship, table

EACH, NEIGHBOURS, HIDDEN, ROUNDS, PARTS, MOST, TARGET, BLOCK = 128, 12, 96, 160, 32, 256, 0.955, 16384


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the square
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def closest(x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of x to each of these rows, some rows at a time."""
    out, step = np.zeros((len(rows), k), np.int64), max(1, (1 << 21) // max(1, len(x)))
    for i in range(0, len(rows), step):
        some = rows[i : i + step]
        s = x[some] @ x.T
        s[np.arange(len(some)), some] = -2
        out[i : i + step] = np.argpartition(-s, k - 1, 1)[:, :k]
    return out


def halves(x: np.ndarray, rows: np.ndarray, parts: int, first: int, out: np.ndarray) -> None:
    """Equal cuts along the widest direction, again and again: where the balanced partitioning starts."""
    if parts == 1:
        out[rows] = first
        return
    y = x[rows] - x[rows].mean(0)
    v = y[np.argmax((y * y).sum(1))]
    for _ in range(8):
        v = y.T @ (y @ v)
        v /= np.linalg.norm(v) + 1e-12
    order = rows[np.argsort(y @ v, kind="stable")]
    low = parts // 2
    at = len(rows) * low // parts
    halves(x, order[:at], low, first, out)
    halves(x, order[at:], parts - low, first + low, out)


def balanced(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Parts of the graph, none over 1.1 times its share: nodes move to where more of their neighbours are, best gains first."""
    label = np.zeros(len(x), np.int64)
    halves(x, np.arange(len(x)), parts, 0, label)
    most = int(1.1 * len(x) / parts) + 1
    for _ in range(12):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].reshape(-1)), 1.0)
        np.add.at(votes, (graph.reshape(-1), np.repeat(label, graph.shape[1])), 1.0)
        to = votes.argmax(1)
        gain = votes[np.arange(len(x)), to] - votes[np.arange(len(x)), label]
        size, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[to[i]] < most:
                size[label[i]] -= 1
                size[to[i]] += 1
                label[i] = to[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """One hidden layer, trained on the share of a vector's neighbours in each part."""

    def __init__(self, x: np.ndarray, parts: int):
        rng = np.random.default_rng(9)
        k = min(NEIGHBOURS, len(x) - 1)
        self.parts = parts = max(1, min(parts, len(x) // 8)) if k > 0 else 1
        d = x.shape[1] if len(x) else 1
        self.net = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, parts)), np.zeros(parts)]
        if parts == 1:
            return
        graph = closest(x, np.arange(len(x)), k)
        label = balanced(x, graph, parts)
        goal = np.zeros((len(x), parts))
        np.add.at(goal, (np.arange(len(x)), label), k / 2)
        np.add.at(goal, (np.repeat(np.arange(len(x)), k), label[graph].reshape(-1)), 1.0)
        goal /= goal.sum(1, keepdims=True)
        m, v = [np.zeros_like(p) for p in self.net], [np.zeros_like(p) for p in self.net]
        for t in range(1, ROUNDS + 1):
            h = np.maximum(0, x @ self.net[0] + self.net[1])
            e = (softmax(h @ self.net[2] + self.net[3]) - goal) / len(x)
            back = (e @ self.net[2].T) * (h > 0)
            for i, g in enumerate((x.T @ back, back.sum(0), h.T @ e, e.sum(0))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                self.net[i] = self.net[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-10)

    def probes(self, x: np.ndarray, fresh: np.ndarray, k: int, target: float) -> int:
        """The fewest parts in which the vectors numbered fresh find target of their k nearest among x."""
        if self.parts == 1 or not len(fresh):
            return self.parts
        near = closest(x, fresh, min(k, len(x) - 1))
        order = self.ranked(x, self.parts)
        where = np.argsort(order[fresh], 1)  # at which probe a part's turn comes
        turn = np.take_along_axis(where, order[near, 0], 1).reshape(-1)
        return next(p for p in range(1, self.parts + 1) if (turn < p).mean() >= target)

    def ranked(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The most probable parts of each vector, first the most probable."""
        p = np.maximum(0, unit(x) @ self.net[0] + self.net[1]) @ self.net[2] + self.net[3]
        return np.argsort(-p, 1, kind="stable")[:, : min(probes, self.parts)]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def best(query_id: np.ndarray, q: np.ndarray, vec_id: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Each query's k nearest ids of these vectors by exact cosine, ties to the smaller id; of an id's rows the nearest counts."""
    order = np.argsort(vec_id, kind="stable")
    vec_id, v = vec_id[order], v[order]
    first = np.flatnonzero(np.append(True, vec_id[1:] != vec_id[:-1]))
    nq, nv = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    out: tuple[list, list, list] = ([], [], [])
    fast = (v / nv[:, None]).astype(np.float32)
    for i in range(len(q)):
        rough = fast @ (q[i] / nq[i]).astype(np.float32)
        rough[vec_id == query_id[i]] = -np.inf
        peak = np.maximum.reduceat(rough, first) if len(first) < len(rough) else rough
        at = np.flatnonzero(rough >= (np.partition(peak, -k)[-k] if len(peak) > k else -2) - 2e-5)
        at = at[np.isfinite(rough[at])]
        exact = (v[at] * q[i]).sum(1) / (nv[at] * nq[i])
        top = np.lexsort((vec_id[at], -exact))
        top = top[np.sort(np.unique(vec_id[at][top], return_index=True)[1])[:k]]
        out[0].append(np.full(len(top), query_id[i]))
        out[1].append(vec_id[at][top])
        out[2].append(exact[top])
    return tuple(np.concatenate([*x, np.zeros(0, t)]).astype(t) for x, t in zip(out, (np.int64, np.int64, np.float64), strict=True))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose id isn't null and whose vector is neither null, empty or zero nor holds a null or non-finite component; of the commonest length."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = vectors.select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(finite & F.exists("embedding", lambda x: x != 0))
    sizes = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("embedding") == (sizes[0][0] if sizes else 0))


def parts_of(n: int) -> int:
    """How many parts n vectors are put into: a block each, but PARTS at least and MOST at most."""
    return min(MOST, max(PARTS, -(-n // BLOCK)))


def by_part(values: np.ndarray) -> Column:
    """A row's number of these, by its part."""
    return F.get(F.array(*[F.lit(int(x)) for x in values]), F.col("part"))


def counted(rows: DataFrame, parts: int) -> np.ndarray:
    """How many rows each part has; at most one row a part comes to the driver."""
    sizes = {r[0]: r[1] for r in rows.groupBy("part").count().collect()}
    return np.array([sizes.get(p, 0) for p in range(parts)], np.int64)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, parts: int | None = None, target: float = TARGET) -> DataFrame:
    """vectors: vec_id, embedding. Queries are rows whose vec_id is divisible by every.

    Returns query_id, rank, vec_id, score. A row that usable() leaves out is neither query nor candidate. Rows of one id are one
    query, that with the smallest vector, and no candidate of one another; as a candidate an id has the best score of its rows.
    No vector, or one alone: no row.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = table(usable(vectors), "vectors")
    n = good.count()
    ids = good.select("vec_id").distinct().count()
    good = table(good.distinct(), "vectors") if ids < n else good  # one row of an id's equal rows is enough
    parts = parts or parts_of(n)
    most = EACH * parts
    chance = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = good.where(chance * n < most).orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(most + most // 4).select("embedding").toArrow()
    x = unit(matrix(sample["embedding"])) if sample.num_rows else np.zeros((0, 1))
    x = x[np.random.default_rng(3).permutation(len(x))]
    fresh = np.arange(len(x) // 4)
    router = Router(x[len(fresh) :], parts)
    probes = router.probes(x, fresh, k, target)

    def place(many: int, held: np.ndarray | None = None, least: int = 0):
        """Each row at its first parts: many, and with held (ids of the parts) as many more as hold least ids."""

        def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in tables:
                if t.num_rows:
                    r = router.ranked(matrix(t["embedding"]), many if held is None else router.parts)
                    take = np.ones(r.shape, bool)
                    if held is not None:
                        before = np.cumsum(held[r], 1) - held[r]
                        take = (np.arange(r.shape[1]) < many) | (before < least)
                    row = pa.array(np.repeat(np.arange(t.num_rows), take.sum(1)))
                    yield pa.RecordBatch.from_arrays([t["vec_id"].take(row), t["embedding"].take(row), pa.array(r[take].astype(np.int32))], ["vec_id", "embedding", "part"])

        return run

    schema = "vec_id long, embedding array<double>, part int"
    indexed = table(good.mapInArrow(place(1), schema), "indexed")
    sizes = counted(indexed, router.parts)
    held = counted(indexed.select("vec_id", "part").distinct(), router.parts) if ids < n else sizes
    least = k + 1 + int(held.sum()) - ids  # ids that are in several parts count once, and its own doesn't
    asked = good.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = table(asked.mapInArrow(place(probes, held, least), schema), "asked")
    blocks, slices = (by_part(np.maximum(1, -(-many // BLOCK))) for many in (sizes, counted(asked, router.parts)))
    at = F.xxhash64("vec_id", "embedding")
    asked = asked.withColumn("slice", F.pmod(at, slices).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = indexed.withColumn("block", F.pmod(at, blocks).cast("int")).withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not (queries.num_rows and block.num_rows):
            q, v, s = (np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
        else:
            q, v, s = best(queries["vec_id"].to_numpy(), matrix(queries["embedding"]), block["vec_id"].to_numpy(), matrix(block["embedding"]), k)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    keys = ["part", "block", "slice"]
    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

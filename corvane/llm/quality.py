"""Quality scores by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs: each good one is preferred to each bad one. A linear score of text features is
learned by logistic loss on the differences of the pairs' features, so only what tells good from bad counts, not how common
either is. The threshold is where good and bad part best, and scores are mapped so that it is CUT.

Every labelled document that may be learnt from counts, and every pair of a good and a bad one. The loss of all pairs needs
no list of them: in one pass over the features, documents are counted and their features summed by label and by bin of the
score, and the driver folds the bins with each other. In these sums a score is its bin's, of 1/BINS of the range that
scores of the model can have. Sums are of whole numbers (features in steps of 1/UNIT), so no order of the rows
changes the model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.exchange import plainly
from corvane.llm.words import binary, buffer, flat, steps, words
from corvane.session import ship, table

CUT, UNIT, BINS, PASSES, DECAY = 0.3, 1 << 16, 1 << 14, 40, 1e-4
_KINDS = ["|", "#", "$", "%", "&", "*", "!", "?", "<>{}[]\\^~=_+@`", ".", ",", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\n", "\"'():;/-"]
_KIND = np.full(256, len(_KINDS), np.int64)
for _k, _c in enumerate(_KINDS):
    _KIND[[ord(x) for x in _c]] = _k
_KIND[0x80:] = len(_KINDS) + 1
FEATURES, LIMIT = len(_KINDS) + 7, 8  # standard features are cut to within LIMIT


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row for each text: shares of kinds of characters (log scale), word lengths, repeated words and lengths."""
    n = np.diff(offs)
    size = np.maximum(n, 1)
    doc = np.repeat(np.arange(len(n)), n)
    kinds = np.bincount(doc * (len(_KINDS) + 2) + _KIND[data], minlength=len(n) * (len(_KINDS) + 2)).reshape(len(n), -1)
    shares = [np.log1p(200 * kinds[:, k] / size) for k in (*range(len(_KINDS)), len(_KINDS) + 1)]
    w = words(data, offs, True)
    count = np.diff(w.first)
    many = np.maximum(count, 1)
    owner = np.repeat(np.arange(len(n)), count)
    same = (w.hash[1:] == w.hash[:-1]) & (owner[1:] == owner[:-1])
    beside = np.bincount(owner[1:][same], minlength=len(n)) / many
    order = np.lexsort((w.hash, owner))
    again = (w.hash[order][1:] == w.hash[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.bincount(owner[order][1:][again], minlength=len(n)) / many
    mean = np.bincount(owner, weights=w.end - w.start, minlength=len(n)) / many
    odd = np.bincount(owner, weights=np.abs(w.end - w.start - mean[owner]), minlength=len(n)) / many
    return np.stack([*shares, np.log1p(20 * beside), repeated, np.log1p(mean), np.log1p(odd), np.log1p(count), (count == 0).astype(float)], 1)


def measured(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in tables:
        data, offs = buffer(t["text"])
        for i, j in steps(offs):
            x = np.rint(features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) * UNIT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([t["doc_id"][i:j], t["h"][i:j], binary(x.reshape(-1), np.arange(j - i + 1) * FEATURES)], ["doc_id", "h", "x"])


def matrix(t: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The labels of some documents, and their features in steps of 1/UNIT."""
    return t["quality"].to_numpy().astype(np.int64), flat(t["x"], np.int32)[0].reshape(-1, FEATURES).astype(np.int64)


def sums(at: np.ndarray, n: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (at, n, *s.T)], ["at", "n", *[f"s{k}" for k in range(s.shape[1])]])


def moments(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By label: how many documents, the sums of their features and of the squares."""
    for t in tables:
        y, x = matrix(t)
        for label in np.unique(y):
            some = x[y == label]
            yield sums(np.array([label]), np.array([len(some)]), np.concatenate([some.sum(0), (some * some).sum(0)])[None])


def standard(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    return np.rint(np.clip((x / UNIT - mean) / sd, -LIMIT, LIMIT) * UNIT)


def products(mean: np.ndarray, sd: np.ndarray):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By label and feature: the sum of the standard feature (as n), and of its products with all features."""
        for t in tables:
            y, x = matrix(t)
            for label in np.unique(y):
                z = standard(x[y == label], mean, sd).astype(np.int64)
                yield sums(label * FEATURES + np.arange(FEATURES), z.sum(0), z.T @ z)

    return run


def binned(mean: np.ndarray, sd: np.ndarray, w: np.ndarray, width: float):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By label and bin of the score: how many documents, and the sums of their standard features."""
        n, s = np.zeros(2 * BINS, np.int64), np.zeros((2 * BINS, FEATURES), np.int64)
        for t in tables:
            y, x = matrix(t)
            z, score = standard(x, mean, sd).T.copy(), np.zeros(len(y))
            for k in range(FEATURES):  # one after another, so that a row's score doesn't depend on its neighbours
                score += z[k] / UNIT * w[k]
            here, place = np.unique(y * BINS + np.clip(np.floor(score / width).astype(np.int64) + BINS // 2, 0, BINS - 1), return_inverse=True)
            n[here] += np.bincount(place)
            for k in range(FEATURES):
                s[here, k] += np.bincount(place, z[k]).astype(np.int64)
        here = np.flatnonzero(n)
        yield sums(here, n[here], s[here])

    return run


def summed(rows: DataFrame, run, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole sums over all rows by at, in order; at most 2 * BINS of them."""
    names = [f"s{k}" for k in range(columns)]
    found = rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("at", "n", *names)))
    all_ = found.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).cast("double").alias(c) for c in names]).toPandas().sort_values("at")
    return all_["at"].to_numpy(np.int64), all_["n"].to_numpy(np.int64), all_[names].to_numpy(float)


class Pairs:
    """The loss of all pairs of a good and a bad document, for a model's weights."""

    def __init__(self, rows: DataFrame, mean: np.ndarray, sd: np.ndarray):
        self.rows, self.mean, self.sd = rows, mean, sd

    def metric(self, many: np.ndarray) -> np.ndarray:
        """The inverse of the curvature without weights, a quarter of the mean square of pairs' differences, and of a ridge."""
        _, n, s = summed(self.rows, products(self.mean, self.sd), FEATURES)
        m, c = n.reshape(2, FEATURES) / UNIT / many[:, None], s.reshape(2, FEATURES, FEATURES) / UNIT**2 / many[:, None, None]
        return np.linalg.inv((c.sum(0) - np.outer(m[0], m[1]) - np.outer(m[1], m[0])) / 4 + 0.01 * np.eye(FEATURES))

    def __call__(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss with decay and its gradient; leaves the counts of bad and good documents a bin in n."""
        self.width = 2 * LIMIT * float(np.abs(w).sum()) / (BINS - 2) or 1.0
        at, n, s = summed(self.rows, binned(self.mean, self.sd, w, self.width), FEATURES)
        self.n, x = np.zeros(2 * BINS), np.zeros((2 * BINS, FEATURES))
        self.n[at], x[at] = n, s / UNIT
        self.n, x = self.n.reshape(2, BINS), x.reshape(2, BINS, FEATURES)
        (bad, good), many = self.n, self.n.sum(1)
        lead = np.arange(1 - BINS, BINS) * self.width  # of a good document over a bad one
        wrong = 1 / (1 + np.exp(np.clip(lead, -500, 500)))
        loss = good @ folded(bad, np.logaddexp(0, -lead)) / many.prod()
        grad = folded(good, wrong[::-1]) @ x[0] / many.prod() - folded(bad, wrong) @ x[1] / many.prod()
        return float(loss) + DECAY / 2 * float(w @ w), grad + DECAY * w

    def threshold(self) -> float:
        """Where the largest shares of good documents above and of bad ones below are; the middle of the gap, if no score is near."""
        bad, good = self.n / self.n.sum(1, keepdims=True)
        best = int(np.argmax(np.append(good[::-1].cumsum()[::-1], 0) + np.append(0, bad.cumsum())))
        used = np.flatnonzero(self.n.any(0))
        low, high = used[used < best], used[used >= best]
        low, high = (low.max() + 1 if len(low) else high.min()), (high.min() if len(high) else low.max() + 1)
        return float((low + high) / 2 - BINS // 2) * self.width


def folded(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each bin i the sum over all bins j of n[j] times what of holds for i - j."""
    size = 4 * len(n)
    return np.fft.irfft(np.fft.rfft(n, size) * np.fft.rfft(of, size), size)[len(n) - 1 : 2 * len(n) - 1]


def descended(loss, w: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Weights of least loss by BFGS, to a slope of 2e-4 or PASSES calls of loss; the last call is for the weights returned."""
    f, g = loss(w)
    calls, size, last = 1, 1.0, w
    while calls < PASSES and np.abs(g).max() > 2e-4 and size > 1e-3:
        step = -size * h @ g
        last = w + step
        new, slope = loss(last)
        calls += 1
        if new > f + 1e-4 * float(step @ g):
            size /= 2
            continue
        y = slope - g
        if (c := float(step @ y)) > 1e-12:
            k = np.eye(len(w)) - np.outer(step, y) / c
            h = k @ h @ k.T + np.outer(step, step) / c
        w, f, g, size = last, new, slope, 1.0
    if last is not w:
        loss(w)
    return w


class Model:
    def __init__(self, mean: np.ndarray, sd: np.ndarray, w: np.ndarray, at: float):
        self.mean, self.sd, self.w, self.at = mean, sd, w, at

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((x - self.mean) / self.sd, -LIMIT, LIMIT) @ self.w - self.at
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -500, 500)))


def held_out(column: str = "doc_id"):
    """Rows that the model may not learn from."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id, text; labels: doc_id, quality 0 or 1. Other labels, null ids and held-out rows are left out; an id that docs repeats counts once. Without both labels every score is CUT."""
    ship(docs.sparkSession)
    usable = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out()).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    texts = docs.where("doc_id is not null").where(~held_out()).select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = texts.mapInArrow(measured, texts.drop("text").schema.add("x", "binary"))
    found = found.groupBy("doc_id").agg(F.min_by("x", "h").alias("x"))  # one text of an id that documents repeat
    rows = table(found.join(usable, "doc_id").select("quality", "x"), "quality")
    label, n, s = summed(rows, moments, 2 * FEATURES)
    mean, square = s.sum(0).reshape(2, FEATURES) / max(1, n.sum()) / np.array([[UNIT], [UNIT**2]])
    sd = np.sqrt(np.maximum(square - mean**2, 0)) + 1e-9
    if len(label) < 2:
        return Model(mean, sd, np.zeros(FEATURES), 0.0)
    loss = Pairs(rows, mean, sd)
    w = descended(loss, np.zeros(FEATURES), loss.metric(n))
    return Model(mean, sd, w, loss.threshold())


def scored(model: Model, columns: list[str]):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            data, offs = buffer(t["text"])
            x = [model.score(features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])) for i, j in steps(offs)]
            yield pa.RecordBatch.from_arrays([*[t[c] for c in columns], pa.array(np.concatenate([*x, np.zeros(0)]))], [*columns, "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, score, predicted. Null text is scored as an empty one."""
    model = fit(docs, labels)
    rows = docs.select("doc_id", "text").mapInArrow(scored_ids(model), "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def scored_ids(model: Model):
    return scored(model, ["doc_id"])


def filter_good(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the model fitted on training and labels doesn't reject, with all columns, whatever their names. Null and empty texts are scored like others."""
    model = fit(training, labels)
    plain = plainly(docs, "text")

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            data, offs = buffer(t["text"])
            x = [model.score(features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])) for i, j in steps(offs)]
            yield t.filter(pa.array(np.concatenate([*x, np.zeros(0)]) >= CUT))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)

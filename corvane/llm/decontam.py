"""Benchmark leaks: rare words as anchors, then Smith-Waterman alignment by words.

Words are runs of letters and digits, A-Z folded. A match is 1, a mismatch or gap -0.5; a document leaks an item if the best
local score is at least THRESHOLD of the item's n words. Such an alignment matches at least m = THRESHOLD n of the item's words
within a bounded stretch of the document. Of any n - m + k words of the item it so matches k or more: these are its anchors, and
a stretch with k of them is looked at. How often words occur in all documents only orders them, rarest first, so anchors are few;
no copy is missed, whatever its edits and however often it is repeated. Stretches with m of the item's words are aligned with the
whole item.

The benchmark is held against all documents, in blocks of at most BLOCK_BYTES of text that are sent to the executors, so a
benchmark of any size can be used. Whether a document leaks depends on it alone: no document moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.exchange import member, plainly
from corvane.llm.words import PLAIN, buffer, steps, words
from corvane.session import ship

THRESHOLD, PENALTY, BLOCK_BYTES = 0.5, 0.5, 8 << 20
#: Share of the matches a leak needs that must be anchors: more anchors wanted make stretches fewer, but the anchors commoner.
WANTED = 0.35
#: Places of parts that are aligned at once.
CELLS = 1 << 16


class Items:
    """A block of the benchmark: each item's words, and its anchors as sorted hashes with the items they are from."""

    def __init__(self, ids: list, texts: list[str], threshold: float = THRESHOLD):
        data, offs = buffer(pa.array(texts, pa.large_string()))
        w = words(data, offs, True, PLAIN)
        parts = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.ids = [i for i, p in zip(ids, parts, strict=True) if len(p)]
        self.words = [p for p in parts if len(p)]
        self.distinct = [np.unique(p, return_counts=True) for p in self.words]
        self.numbers = [np.searchsorted(own, p) for p, (own, _) in zip(self.words, self.distinct, strict=True)]
        self.vocabulary = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))
        n = np.array([len(p) for p in self.words], np.int64)
        self.matches = np.maximum(1, np.ceil(threshold * n - 1e-9)).astype(np.int64)
        self.span = (n + np.maximum(0, n - threshold * n) / PENALTY + 1e-9).astype(np.int64)  # words an alignment covers at most
        self.wanted = np.maximum(1, (self.matches * WANTED).astype(np.int64))
        self.anchor(np.zeros(len(self.vocabulary), np.int64))

    def anchor(self, counts: np.ndarray) -> None:
        """counts: how often each word of the vocabulary occurs in the documents. Anchors are each item's rarest words."""
        flat, item = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, p in enumerate(self.words):
            order = np.lexsort((p, counts[np.searchsorted(self.vocabulary, p)]))
            flat.append(np.unique(p[order[: len(p) - self.matches[k] + self.wanted[k]]]))
            item.append(np.full(len(flat[-1]), k))
        flat, item = np.concatenate(flat), np.concatenate(item)
        order = np.argsort(flat, kind="stable")
        self.flat, self.item = flat[order], item[order]
        self.anchors = np.unique(self.flat)


def word_counts(items: Items):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.vocabulary), np.int64)
        for t in tables:
            data, offs = buffer(t["text"])
            for i, j in steps(offs):
                h = words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True, PLAIN).hash
                total += np.bincount(np.searchsorted(items.vocabulary, h[member(items.vocabulary, h)]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    return run


def align(item: np.ndarray, part: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of all of item in part: score, where it starts in part and where it ends."""
    n = len(part)
    slope = PENALTY * np.arange(n + 1)
    score, start = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for x in item:
        step = score[:-1] + np.where(part == x, 1.0, -PENALTY)
        up = score[1:] - PENALTY
        new, begin = np.zeros(n + 1), np.arange(n + 1)
        new[1:] = np.maximum(np.maximum(step, up), 0)
        begin[1:] = np.where(new[1:] <= 0, begin[1:], np.where(step >= up, start[:-1], start[1:]))
        lead = np.maximum.accumulate(new + slope)  # gaps in part: the best place further left, less the way
        left = lead - slope
        further = left > new + 1e-12
        if further.any():
            source = np.maximum.accumulate(np.where(new + slope >= lead, np.arange(n + 1), 0))
            begin = np.where(further, begin[source], begin)
            new = np.maximum(new, left)
        score, start = new, begin
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (float(score[k]), int(start[k]), k)
    return best


def stretches(items: Items, w) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first word, word after) of a batch: all places that hold as many anchors of an item as a leak must."""
    at = np.flatnonzero(member(items.anchors, w.hash))
    if not len(at):
        return
    low, high = np.searchsorted(items.flat, w.hash[at], "left"), np.searchsorted(items.flat, w.hash[at], "right")
    row = np.repeat(np.arange(len(at)), high - low)
    item = items.item[np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[row]]
    at = at[row]
    doc = np.searchsorted(w.first, at, "right") - 1
    key = doc * len(items.words) + item
    order = np.argsort(key, kind="stable")
    at, item, doc, key = at[order], item[order], doc[order], key[order]
    span = items.span[item]
    end = np.arange(len(at)) + items.wanted[item] - 1  # the last of the anchors wanted from here on
    near = end < len(at)
    end[~near] = 0
    near &= (key[end] == key) & (at[end] - at < span)
    hit = np.flatnonzero(near)
    if not len(hit):
        return
    key, doc, item = key[hit], doc[hit], item[hit]
    x, y = np.maximum(at[end[hit]] - span[hit] + 1, w.first[doc]), np.minimum(at[hit] + span[hit], w.first[doc + 1])
    new = np.ones(len(hit), bool)
    new[1:] = (key[1:] != key[:-1]) | (x[1:] > y[:-1])
    first = np.flatnonzero(new)
    yield from zip(doc[first].tolist(), item[first].tolist(), x[first].tolist(), y[np.append(first[1:], len(hit)) - 1].tolist(), strict=True)


def best_scores(items: list[np.ndarray], parts: list[np.ndarray]) -> np.ndarray:
    """The best local score of each item in its part, many at once. Words are numbers; -1 in a part is a word the item lacks."""
    out = np.zeros(len(parts), np.float32)
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * len(parts[order[b]]) <= CELLS:
            b += 1
        some = order[a:b]
        x = np.full((max(len(items[i]) for i in some), b - a), -2, np.int32)
        y = np.full((len(parts[some[-1]]), b - a), -1, np.int32)
        for c, i in enumerate(some):
            x[: len(items[i]), c], y[: len(parts[i]), c] = items[i], parts[i]
        slope = (PENALTY * np.arange(len(y) + 1, dtype=np.float32))[:, None]  # halves: exact in 32 bits
        score, best = np.zeros((len(y) + 1, b - a), np.float32), np.zeros(b - a, np.float32)
        for row in x:
            new = score - np.float32(PENALTY)
            np.maximum(new[1:], score[:-1] + np.where(y == row, np.float32(1), np.float32(-PENALTY)), out=new[1:])
            np.maximum(new, 0, out=new)
            new += slope
            np.maximum.accumulate(new, axis=0, out=new)
            new -= slope
            score = new
            np.maximum(best, score.max(axis=0), out=best)
        out[some] = best
        a = b
    return out


def leaks_of(items: Items, w, threshold: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, words) of a batch's texts: the best alignment of each text and item."""
    found, parts = [], []
    for d, k, x, y in stretches(items, w):
        part, (own, times) = w.hash[x:y], items.distinct[k]
        place = np.minimum(np.searchsorted(own, part), len(own) - 1)
        same = own[place] == part
        if np.count_nonzero(same) < items.matches[k] or np.minimum(np.bincount(place[same], minlength=len(own)), times).sum() < items.matches[k]:
            continue
        found.append((d, k, x, y))
        parts.append(np.where(same, place, -1))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for (d, k, x, y), s in zip(found, best_scores([items.numbers[k] for _, k, _, _ in found], parts).tolist(), strict=True):
        if s / len(items.words[k]) >= threshold and s / len(items.words[k]) > best.get((d, k), (0,))[0]:
            s, i, j = align(items.words[k], w.hash[x:y])
            best[d, k] = (s / len(items.words[k]), x + i - int(w.first[d]), j - i)
    return [(*key, *v) for key, v in best.items()]


def blocks_of(benchmark: DataFrame, threshold: float) -> Iterator[Items]:
    """The benchmark's items in blocks, streamed to the driver. Items without words are left out."""
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text.encode())
        if size >= BLOCK_BYTES:
            yield Items(ids, texts, threshold)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, threshold)


def anchored_blocks(docs: DataFrame, benchmark: DataFrame, threshold: float) -> Iterator[Items]:
    ship(docs.sparkSession)
    for items in blocks_of(benchmark, threshold):
        counts = np.zeros(len(items.vocabulary), np.int64)
        found = docs.select("text").mapInArrow(word_counts(items), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # a row for each word of the block at most
        counts[found["word"].to_numpy()] = found["n"].to_numpy()
        items.anchor(counts)
        yield items


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, text; benchmark: item_id, text. Returns doc_id, item_id, score, first_word, n_words of each leak.

    first_word counts from 0. Null and empty texts leak nothing. Repeated documents and items leak each for themselves.
    """
    schema = "doc_id long, item_id long, score double, first_word long, n_words long"
    out = docs.sparkSession.createDataFrame([], schema)

    def search(items: Items):
        def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in tables:
                data, offs = buffer(t["text"])
                for i, j in steps(offs):
                    w = words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True, PLAIN)
                    rows = leaks_of(items, w, threshold)
                    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                    ids = t["doc_id"].take(pa.array([i + d for d in columns[0]], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([items.ids[k] for k in columns[1]], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], ["doc_id", "item_id", "score", "first_word", "n_words"])

        return run

    for items in anchored_blocks(docs, benchmark, threshold):
        out = out.union(docs.select("doc_id", "text").mapInArrow(search(items), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that leak no item, with all columns, whatever their names."""
    out = plainly(docs, "text")
    schema = out.schema

    def drop(items: Items):
        def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in tables:
                data, offs = buffer(t["text"])
                keep = np.ones(t.num_rows, bool)
                for i, j in steps(offs):
                    w = words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True, PLAIN)
                    for d, *_ in leaks_of(items, w, threshold):
                        keep[i + d] = False
                yield t.filter(pa.array(keep))

        return run

    for items in anchored_blocks(docs, benchmark, threshold):
        out = out.mapInArrow(drop(items), schema)
    return out.toDF(*docs.columns)

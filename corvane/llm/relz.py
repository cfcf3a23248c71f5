"""Repeated passages by relative Lempel-Ziv: documents are factored greedily against indexed reference blocks.

Documents lie in buckets of about 8 MB, the reference blocks. A block's index knows every window of 20 words and the earliest
place (document, word) at which it starts. A document is parsed from its start: where the window at a word starts earlier too, a
factor begins that copies from that place, and it goes on for as long as the next window's earliest place is the next word
of the same document; the parse continues behind the factor's last word. Other words are literals. Factors have 20 words
or more. A window across the boundary behind a factor is in no factor, so each such window is looked up as well, and one that starts
earlier is a boundary factor of 20 words of its own. So every repeated window is in a factor, and the words of all factors go.

The indexes are dealt, never gathered. The smallest hash of the eleven 10-word runs in a window is its anchor; equal
windows have equal anchors. Buckets first exchange anchors, each once (see exchange); only windows whose anchor another
bucket has are then sent, each once, with their first place. Their owner tells every bucket the earliest place of
those of its windows that an earlier document of another bucket has. Repeats within a bucket are found there. A passage that a third of all
documents hold so costs one entry a bucket.

Windows are compared by two hashes of 64 bits each, made from different mixes of their words' hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.exchange import joined, member, pack, plainly, shared_keys
from corvane.llm.words import Words, binary, buffer, flat, inside, mix, runs, steps, words
from corvane.session import ship

U = np.uint64
WINDOW, GRAM = 20, 10
BUCKET_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max
SENT = "part long, bucket long, keys binary, checks binary, docs binary, places binary"
REPLY = "bucket long, keys binary, checks binary, docs binary, places binary"


def smallest(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k values in a row."""
    n, at = len(x) - k + 1, 1
    if n <= 0:
        return x[:0]
    while 2 * at <= k:
        x = np.minimum(x[:-at], x[at:])
        at *= 2
    return np.minimum(x[:n], x[k - at : k - at + n]) if at < k else x


class Bucket:
    """Words and windows of a bucket's texts, in the order of doc_id."""

    def __init__(self, table: pa.Table):
        ids = table["doc_id"].to_numpy() if not table["doc_id"].null_count else table["doc_id"].fill_null(LAST).to_numpy()
        self.table = table.take(pa.array(np.argsort(ids, kind="stable")))
        self.ids = np.sort(ids, kind="stable")
        self.data, self.offs = buffer(self.table["text"])
        parts = [words(self.data[self.offs[i] : self.offs[j]], self.offs[i : j + 1] - self.offs[i]) for i, j in steps(self.offs)]
        ranges = [self.offs[i] for i, _ in steps(self.offs)]
        sizes = np.cumsum([0, *(len(p.hash) for p in parts)])
        cat = lambda xs: np.concatenate([*xs, np.zeros(0, np.int64)]).astype(np.int64)
        first = cat([p.first[:-1] + n for p, n in zip(parts, sizes, strict=False)])
        self.words = Words(np.concatenate([p.hash for p in parts] + [np.zeros(0, np.uint64)]), cat([p.start + o for p, o in zip(parts, ranges, strict=True)]), cat([p.end + o for p, o in zip(parts, ranges, strict=True)]), np.append(first, sizes[-1]))
        self.valid = inside(self.words.first, WINDOW)

    def anchors(self) -> np.ndarray:
        return smallest(runs(self.words.hash, GRAM), WINDOW - GRAM + 1)

    def windows(self) -> np.ndarray:
        return runs(self.words.hash, WINDOW)

    def checks(self) -> np.ndarray:
        """A second hash of each window, over other values of its words."""
        return runs(mix(self.words.hash ^ U(0x2545F4914F6CDD1D)), WINDOW)

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, at, "right") - 1


def anchor_keys(table: pa.Table) -> np.ndarray:
    b = Bucket(table)
    return b.anchors()[b.valid]


def first_places(x: np.ndarray) -> np.ndarray:
    """For each value the number of the first equal one."""
    order = np.argsort(x, kind="stable")
    new = np.ones(len(x), bool)
    new[1:] = x[order][1:] != x[order][:-1]
    out = np.empty(len(x), np.int64)
    out[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(x) else order
    return out


def send_windows(parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(table: pa.Table, reply: pa.Table) -> pa.Table:
        if not table.num_rows or not reply.num_rows:
            return pa.table({c: pa.array([], pa.int64() if c in ("part", "bucket") else pa.binary()) for c in ("part", "bucket", "keys", "checks", "docs", "places")})
        b = Bucket(table)
        at = np.flatnonzero(b.valid)
        at = at[member(joined(reply), b.anchors()[at])]
        hashes = b.windows()[at]
        first = np.flatnonzero(first_places(hashes) == np.arange(len(at)))
        at, row = at[first], b.row_of(at[first])
        return pack(table["bucket"][0].as_py(), hashes[first], parts, checks=b.checks()[at], docs=b.ids[row].astype(np.int64), places=at - b.words.first[row])

    return send


def earlier(table: pa.Table) -> pa.Table:
    """One part of the key space: for each bucket its windows that another bucket has in an earlier document, with the earliest place."""
    keys, offs = flat(table["keys"])
    checks, docs, places = flat(table["checks"])[0], flat(table["docs"], np.int64)[0], flat(table["places"], np.int64)[0]
    bucket = np.repeat(table["bucket"].to_numpy(), np.diff(offs))
    order = np.lexsort((bucket, docs, checks, keys))
    keys, checks, docs, places, bucket = keys[order], checks[order], docs[order], places[order], bucket[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    top = np.flatnonzero(new)[np.cumsum(new) - 1] if len(keys) else np.zeros(0, np.int64)
    again = np.flatnonzero(~new)
    again = again[np.argsort(bucket[again], kind="stable")]
    here, first = np.unique(bucket[again], return_index=True)
    offs = np.append(first, len(again))
    return pa.table({"bucket": pa.array(here, pa.int64()), "keys": binary(keys[again], offs), "checks": binary(checks[again], offs), "docs": binary(docs[top[again]], offs), "places": binary(places[top[again]], offs)})


class Factors(NamedTuple):
    """Copied stretches in the order of their words: where each starts and how many words it has (in the bucket), the place it
    is copied from, and whether it lies across the boundary behind another."""

    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    boundary: np.ndarray


def factored(b: Bucket, reply: pa.Table) -> Factors:
    """Greedy parse of all texts of a bucket against its own index and the other blocks' answers."""
    at = np.flatnonzero(b.valid)
    hashes, row = b.windows()[at], b.row_of(at)
    first = first_places(hashes)
    copied = first < np.arange(len(at))  # an earlier place in this bucket
    doc, place = b.ids[row[first]].astype(np.int64), at[first] - b.words.first[row[first]]
    if reply.num_rows and len(at):
        keys = flat(reply["keys"])[0]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        found = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        hit = np.flatnonzero((keys[found] == hashes) & (flat(reply["checks"])[0][order][found] == b.checks()[at]))
        doc[hit], place[hit] = flat(reply["docs"], np.int64)[0][order][found[hit]], flat(reply["places"], np.int64)[0][order][found[hit]]
        copied[hit] = True
    some = np.flatnonzero(copied)
    here, doc, place, row = at[some], doc[some], place[some], row[some]
    follows = np.zeros(len(some), bool)  # goes on with what the window before copies
    follows[1:] = (here[1:] == here[:-1] + 1) & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + 1) & (row[1:] == row[:-1])
    run = np.flatnonzero(~follows)
    last = np.append(run[1:], len(some)) - 1  # each run's last window
    run_of = np.cumsum(~follows) - 1
    pick, size, edge = [], [], []
    k = 0
    while k < len(some):
        end = int(last[run_of[k]])
        pick.append(k)
        size.append(int(here[end] - here[k]) + WINDOW)
        edge.append(False)
        stop = int(here[k]) + size[-1]
        nxt = int(np.searchsorted(here, stop))
        pick += range(end + 1, nxt)  # windows across the boundary that start earlier too
        size += [WINDOW] * (nxt - end - 1)
        edge += [True] * (nxt - end - 1)
        k = nxt
    pick = np.array(pick, np.int64)
    return Factors(here[pick], np.array(size, np.int64), doc[pick], place[pick], np.array(edge, bool))


def removed(b: Bucket, f: Factors) -> np.ndarray:
    """Mask over a bucket's words: in a factor."""
    edge = np.zeros(len(b.words.hash) + 1, np.int64)
    np.add.at(edge, f.start, 1)
    np.add.at(edge, f.start + f.size, -1)
    return np.cumsum(edge[:-1]) > 0


def kept_text(b: Bucket, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each text's kept words, joined by one space."""
    w, keep = b.words, np.flatnonzero(~gone)
    doc = np.searchsorted(w.first, keep, "right") - 1
    more = np.append(doc[1:] == doc[:-1], False) if len(keep) else np.zeros(0, bool)  # another kept word follows in this text
    edge = np.zeros(len(b.data) + 1, np.int8)
    edge[w.start[keep]] += 1
    np.subtract.at(edge, w.end[keep], 1)
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = b.data.copy()
    data[w.end[keep][more]] = 0x20
    mask[w.end[keep][more]] = True
    return data[mask], np.append(0, np.cumsum(mask))[b.offs]


def digest(b: Bucket, f: Factors) -> pa.Table:
    gone = removed(b, f)
    data, offs = kept_text(b, gone)
    view, first = memoryview(data), b.words.first
    cut = np.append(0, np.cumsum(gone))
    sha = [hashlib.sha256(view[i:j]).hexdigest() for i, j in zip(offs[:-1], offs[1:], strict=True)]
    return pa.table({"doc_id": b.table["doc_id"], "n_words": np.diff(first), "n_removed": cut[first[1:]] - cut[first[:-1]], "kept_sha256": pa.array(sha, pa.string())})


def listed(b: Bucket, f: Factors) -> pa.Table:
    row = b.row_of(f.start)
    source = pa.array(f.doc, mask=f.doc == LAST) if len(f.doc) else pa.array([], pa.int64())
    return pa.table({"doc_id": b.table["doc_id"].take(pa.array(row)), "first_word": f.start - b.words.first[row], "n_words": f.size, "ref_doc_id": source, "ref_word": f.place, "boundary": pa.array(f.boundary)})


def spans(b: Bucket, f: Factors) -> pa.Table:
    """The words to remove as ranges of word numbers of a document."""
    first, gone = b.words.first, removed(b, f)
    new = gone & ~np.append(False, gone[:-1])
    new[first[:-1][first[:-1] < len(gone)]] |= gone[first[:-1][first[:-1] < len(gone)]]
    start = np.flatnonzero(new)
    doc = np.searchsorted(first, start, "right") - 1
    cut = np.append(0, np.cumsum(gone))
    stop = np.minimum(np.append(start[1:], len(gone)), first[doc + 1])
    return pa.table({"doc_id": b.table["doc_id"].take(pa.array(doc)), "first_word": start - first[doc], "n_words": cut[stop] - cut[start]})


def cut(b: Bucket, f: Factors) -> pa.Table:
    """All columns of a bucket; a text from which words went holds the rest, joined by one space, and n_chars (if there) its length."""
    gone = removed(b, f)
    data, offs = kept_text(b, gone)
    n = np.append(0, np.cumsum(gone))
    hit = n[b.words.first[1:]] > n[b.words.first[:-1]]
    text = b.table["text"].to_pylist()
    for i in np.flatnonzero(hit):
        text[i] = bytes(data[offs[i] : offs[i + 1]]).decode() or None
    dropped = pa.array([bool(h) and t is None for h, t in zip(hit, text, strict=True)])
    at = b.table.schema.get_field_index
    out = b.table.set_column(at("text"), "text", pa.array(text, pa.string()))
    if at("n_chars") >= 0:
        old = b.table["n_chars"]
        out = out.set_column(at("n_chars"), "n_chars", pa.array([len(t) if h and t is not None else k for t, k, h in zip(text, old.to_pylist(), hit, strict=True)]).cast(old.type))
    return out.filter(pc.invert(dropped))


def repeats(docs: DataFrame, finish: Callable[[Bucket, Factors], pa.Table], schema: T.StructType | str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Apply finish to each bucket of docs and its factors.

    docs has doc_id and text. Null text has no words. Earlier means a smaller doc_id; null ids come last; rows of the same
    id are earlier or later than one another in a fixed order. An empty table gives an empty one.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    parts = max(1, -(-size // (4 * bucket_bytes)))
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("long")
    rows = docs.select("doc_id", "text", dealt.alias("bucket"))
    anchors = shared_keys(rows, anchor_keys, parts)
    sent = rows.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(send_windows(parts), SENT)
    reply = sent.groupBy("part").applyInArrow(earlier, REPLY)
    empty = pa.table({"doc_id": pa.array([], pa.int64())})

    def last(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:  # an answer has a bucket of rows always
            return empty
        b = Bucket(table)
        return finish(b, factored(b, answers))

    if docs.columns == ["doc_id", "text"]:
        return rows.groupBy("bucket").cogroup(reply.groupBy("bucket")).applyInArrow(last, schema)

    return docs.groupBy(dealt).cogroup(reply.groupBy("bucket")).applyInArrow(last, schema)


def repeat_digest(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256."""
    return repeats(docs.select("doc_id", "text"), digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def repeat_factors(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The factors: doc_id, first_word (from 0), n_words, ref_doc_id and ref_word it is copied from, and whether it lies across a boundary."""
    return repeats(docs.select("doc_id", "text"), listed, "doc_id long, first_word long, n_words long, ref_doc_id long, ref_word long, boundary boolean", bucket_bytes)


def repeat_spans(docs: DataFrame) -> DataFrame:
    """The ranges of words to remove: doc_id, first_word (from 0), n_words."""
    return repeats(docs.select("doc_id", "text"), spans, "doc_id long, first_word long, n_words long")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """docs without the repeated words. A document all of whose words went is dropped; others keep all columns, whatever their names."""
    plain = plainly(docs, "doc_id", "text", "n_chars")
    return repeats(plain, cut, plain.schema).toDF(*docs.columns)

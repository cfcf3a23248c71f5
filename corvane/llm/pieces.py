"""Sampled piece segmentations by forward filtering and backward sampling, and their lossless decoding.

A SentencePiece model file gives the pieces. A text is cut where no piece can cross: between characters whose adjoining bytes no
piece holds side by side, as before each run of spaces. Such a segment may have any length; all pieces that match form its lattice. The forward pass sums the weights of all ways to each place, the
backward pass draws a segmentation from its end, each piece with its share of the weight. Draws are hashes of the row's key, a
seed and the byte place, so a row always gets the same segmentation, whatever rows are beside it.

Piece weights come from ranks: a model of merges has no probabilities, so piece r weighs 1 / (r + SHIFT), to the power ALPHA.
Nothing is normalised: spaces are the pieces' marker one for one, and characters without a piece (the
marker itself too) are spelt in the model's byte pieces. So decoding gives back every byte.

Sums of weights shrink with each piece, so beyond UNSCALED bytes each place has its own power of two. Distinct segments of a
batch share one lattice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm.words import buffer, hashes, mix, steps
from corvane.session import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA, SHIFT, UNSCALED, SEED = 1.0, 20.0, 32, 0
#: Bytes of text whose lattices are built at once. Larger steps share hardly more segments and cost more memory and time.
LATTICES, SLICE = 1 << 16, 4 << 20
U = np.uint64


class Vocabulary:
    """The pieces of a model as a trie in flat arrays, read on the driver and sent to executors (some megabytes)."""

    def __init__(self, pieces: list[tuple[int, bytes, float]], bytes_: list[int]):
        """pieces: id, bytes (the marker as a space), rank; bytes_: ids of the 256 byte pieces."""
        self.byte_ids = np.array(bytes_, np.int32)
        size = 1 + max([*bytes_, *(i for i, _, _ in pieces)])
        self.text: list[bytes] = [b""] * size
        for b, i in enumerate(bytes_):
            self.text[i] = bytes([b])
        weight = np.zeros(size)
        weight[self.byte_ids] = 1 / (size + SHIFT) ** ALPHA
        children: dict[tuple[int, int], int] = {}
        ends = [-1]
        self.longest = 1
        self.pairs = np.zeros(1 << 16, bool)  # bytes that lie side by side in a piece
        for i, text, rank in pieces:
            node = 0
            for b in text:
                nxt = children.get((node, b))
                if nxt is None:
                    nxt = children[node, b] = len(ends)
                    ends.append(-1)
                node = nxt
            if ends[node] < 0 or 1 / (rank + SHIFT) ** ALPHA > weight[ends[node]]:
                ends[node] = i
            self.text[i] = text
            weight[i] = 1 / (rank + SHIFT) ** ALPHA
            self.longest = max(self.longest, len(text))
            for a, b in zip(text[:-1], text[1:], strict=True):
                self.pairs[a << 8 | b] = True
        self.weight, self.ends = weight, np.array(ends, np.int32)
        self.bits = max(8, int(4 * len(children)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        for (node, b), nxt in children.items():
            key = node << 8 | b
            at = int(self.slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.to[at] = key, nxt
        self.blob = np.frombuffer(b"".join(self.text), np.uint8)
        self.blob_at = np.append(0, np.cumsum([len(t) for t in self.text]))

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node below, or -1."""
        key = node.astype(np.int64) << 8 | byte
        at = self.slot(key)
        out = np.full(len(key), -1, np.int32)
        rest = np.arange(len(key))
        while len(rest):
            here = self.keys[at[rest]]
            hit = here == key[rest]
            out[rest[hit]] = self.to[at[rest[hit]]]
            rest = rest[~hit & (here >= 0)]
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
        return out


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, bytes_ = [], [0] * 256
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            bytes_[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces.append((i, sp.id_to_piece(i).replace("▁", " ").encode(), -sp.get_score(i)))
    return Vocabulary(pieces, bytes_)


def segments(v: Vocabulary, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where segments start: at texts, and at characters that no piece holds together with the byte before."""
    n = len(data)
    begin = np.zeros(n, bool)
    begin[1:] = ~v.pairs[data[:-1].astype(np.int64) << 8 | data[1:]] & ((data[1:] & 0xC0) != 0x80)
    begin[offs[:-1][offs[:-1] < n]] = True
    return np.flatnonzero(begin)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all elements of ranges, one range after another."""
    first = np.cumsum(size) - size
    return np.repeat(start - first, size) + np.arange(int(size.sum()))


def lattice(v: Vocabulary, data: np.ndarray, offs: np.ndarray):
    """Edges of all segments' lattices: for each node the range of its incoming edges, summed shares, sources and pieces.

    Segment s has a node before each of its bytes and one at its end; node numbers are offs[s] + s + place.
    """
    n, size = len(data), np.diff(offs)
    seg = np.repeat(np.arange(len(size)), size)
    place = np.arange(n) - offs[seg]
    lead = (data & 0xC0) != 0x80
    ends_char = np.append(lead[1:], True)
    ends_char[offs[1:] - 1] = True
    src, length, piece = [], [], []
    at = np.flatnonzero(lead)
    node, single = np.zeros(len(at), np.int32), np.zeros(n, bool)
    char = np.repeat(np.flatnonzero(lead), np.diff(np.append(np.flatnonzero(lead), n))) if len(at) else np.zeros(0, np.int64)
    for k in range(v.longest):
        inside = at + k < offs[seg[at] + 1]
        at, node = at[inside], node[inside]
        if not len(at):
            break
        node = v.child(node, data[at + k])
        at, node = at[node >= 0], node[node >= 0]
        hit = (v.ends[node] >= 0) & ends_char[at + k]
        src.append(at[hit])
        length.append(np.full(int(hit.sum()), k + 1))
        piece.append(v.ends[node[hit]])
        whole = hit & (char[at + k] == at)
        single[at[whole]] = True
    spelt = np.flatnonzero(~single[char]) if n else np.zeros(0, np.int64)
    src.append(spelt)
    length.append(np.ones(len(spelt), np.int64))
    piece.append(v.byte_ids[data[spelt]])
    src, length, piece = (np.concatenate(x) for x in (src, length, piece))
    end = place[src] + length
    source = src + seg[src]
    target = source + length
    order = np.argsort(end << 7 + (n + len(size)).bit_length() | target << 7 | length)  # by place, as the forward pass goes, then by node
    length = length[order]
    source, target, piece, end = source[order], target[order], piece[order], end[order]
    weight = v.weight[piece]
    total = np.zeros(n + len(size))
    total[offs[:-1] + np.arange(len(size))] = 1.0
    cut = np.searchsorted(end, np.arange(1, int(end.max()) + 2)) if len(end) else np.zeros(1, np.int64)
    share = np.empty(len(source))
    power = np.zeros(len(total), np.int32)
    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True), 1):
        share[a:b] = total[source[a:b]] * weight[a:b]
        first = np.flatnonzero(np.append(True, target[a + 1 : b] != target[a : b - 1])) if b > a else np.zeros(0, np.int64)
        if len(first) and k <= UNSCALED:
            total[target[a:b][first]] = np.add.reduceat(share[a:b], first)
        elif len(first):
            here, times, scale = target[a:b][first], np.diff(np.append(first, b - a)), power[source[a:b]]
            top = np.maximum.reduceat(scale, first)
            share[a:b] = np.ldexp(share[a:b], scale - np.repeat(top, times))
            total[here], up = np.frexp(np.add.reduceat(share[a:b], first))
            share[a:b] = np.ldexp(share[a:b], -np.repeat(up, times))
            power[here] = top + up
    order = np.argsort(target << 7 | length)
    source, target, piece, share = source[order], target[order], piece[order], share[order] / total[target[order]]
    # whole numbers: their sums don't depend on what else is in the batch
    return np.searchsorted(target, np.arange(len(total) + 1)), np.cumsum(1 + (share * 2.0**36).astype(np.int64)), source, piece


def sample(v: Vocabulary, data: np.ndarray, offs: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of texts, one after another, and where each text's begin. keys: a 64-bit key for each text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    start = segments(v, data, offs)
    end = np.append(start[1:], n)
    _, first, same = np.unique(hashes(data, start, end), return_index=True, return_inverse=True)
    size = (end - start)[first]
    uoffs = np.append(0, np.cumsum(size))
    into, summed, source, piece = lattice(v, data[ragged(start[first], size)], uoffs)
    base = np.append(0, summed)[into[:-1]]  # what is summed before a node's edges
    width = np.append(0, summed)[into[1:]] - base
    doc = np.searchsorted(offs, start, "right") - 1
    key = mix(keys + U(seed * 0x9E3779B97F4A7C15 % 2**64))[doc]
    root = uoffs[same] + same  # the node before the segment's first byte
    node, place = root + (end - start), (end - offs[doc]).astype(np.uint64)
    out = np.full(n, -1, np.int32)
    live = np.arange(len(start))
    while len(live):
        here = node[live]
        draw = (mix(key[live] ^ mix(place[live])) >> U(11)).astype(np.float64) * 2.0**-53
        edge = np.searchsorted(summed, base[here] + (draw * width[here]).astype(np.int64), "right")
        back = source[edge]
        out[start[live] + back - root[live]] = piece[edge]
        place[live] -= (here - back).astype(np.uint64)
        node[live] = back
        live = live[back > root[live]]
    at = np.flatnonzero(out >= 0)
    return out[at], np.searchsorted(at, offs)


def spell(v: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of pieces, and how many each has."""
    size = v.blob_at[ids + 1] - v.blob_at[ids]
    return v.blob[ragged(v.blob_at[ids], size)], size


def encode(docs: DataFrame, path: str = MODEL, seed: int = SEED) -> DataFrame:
    """docs: doc_id, text. Returns per row: doc_id, n_pieces, ids, lossless (whether the ids decode to the text's bytes).

    Null text has null ids and no pieces; empty text has none. Rows of one id share their draws, so equal rows are cut alike.
    Batches are worked and handed back in slices of at most SLICE bytes of text (or one row).
    """
    ship(docs.sparkSession)
    v = load(path)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (b.slice(i, j - i) for b in tables for i, j in steps(buffer(b["text"])[1], SLICE)):
            data, offs = buffer(t["text"])
            keys = t["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            parts, counts, lossless = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for i, j in steps(offs, LATTICES):
                sub, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                ids, at = sample(v, sub, o, mix(keys[i:j]), seed)
                back, size = spell(v, ids)
                ends = np.append(0, np.cumsum(size))[at]
                if len(back) == len(sub) and (ends == o).all():
                    wrong = np.append(0, np.cumsum(back != sub))
                    good = wrong[o[1:]] == wrong[o[:-1]]
                else:
                    good = np.array([bytes(back[a:b]) == bytes(sub[c:d]) for a, b, c, d in zip(ends[:-1], ends[1:], o[:-1], o[1:], strict=True)], bool)
                parts.append(ids)
                counts.append(np.diff(at))
                lossless.append(good)
            n, null = np.concatenate(counts), t["text"].is_null().to_numpy(zero_copy_only=False)
            at = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
            lists = pa.ListArray.from_arrays(at, pa.array(np.concatenate(parts)), mask=pa.array(null) if null.any() else None)
            yield pa.RecordBatch.from_arrays([t["doc_id"], pa.array(n), lists, pa.array(np.concatenate(lossless))], ["doc_id", "n_pieces", "ids", "lossless"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """encoded: doc_id, ids. Returns doc_id, text. Null ids give a null text."""
    ship(encoded.sparkSession)
    v = load(path)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            text = [None if x is None else bytes(spell(v, np.array(x, np.int64))[0]).decode() for x in t["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([t["doc_id"], pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

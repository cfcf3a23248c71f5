"""Words of whole texts as hash arrays, without a Python object for each word.

A batch of UTF-8 texts is one byte buffer. Words are runs of bytes outside 0x20 and 0x09-0x0D. A word's hash takes in eight
bytes at a step and mixes all bits after each, so no pattern of repeated bytes cancels out; the cost is a few vector
operations a word.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII character but letters and digits parts words as well.
PLAIN = np.ones(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    PLAIN[_low:_high] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: The bits of a block of eight bytes that belong to a word with so many bytes left.
_HELD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words of more bytes than this are hashed one by one.
LONG = 256
#: Bytes of text that are hashed at once: the work arrays then stay within some tens of megabytes.
STEP = 1 << 20


class Words(NamedTuple):
    hash: np.ndarray  #: uint64 for each word
    start: np.ndarray  #: byte at which it starts
    end: np.ndarray  #: byte after it
    first: np.ndarray  #: for each text, and one more: number of its first word


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes. Stretches of more than LONG bytes go through BLAKE2, as their steps would be too many."""
    size = end - start
    h = mix(size.astype(np.uint64) + U(0x51ED270B9F36A1C5))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    at, k = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(at):
        left = size[at] - k
        h[at] = mix(h[at] ^ (block[start[at] + k] & _HELD[np.minimum(left, 8)]))
        at, k = at[left > 8], k + 8
    for i in np.flatnonzero(size > LONG):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def steps(offs: np.ndarray, limit: int = STEP):
    """Ranges of rows of about limit bytes; a longer row is alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offs: np.ndarray, fold: bool = False, space: np.ndarray = _SPACE) -> Words:
    """The words of texts that lie one after another in data."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(offs), np.int64))
    solid = ~space[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = offs[:-1][(offs[:-1] < n) & (np.diff(offs) > 0)]
    begin[inner] = solid[inner]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = offs[1:][np.diff(offs) > 0] - 1
    stop[last] = solid[last]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return Words(hashes(_LOWER[data] if fold else data, start, end), start, end, np.searchsorted(start, offs))


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word sequences that start at each word; those of the last k - 1 words are missing."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, at, out, done = h, 1, None, 0
    while True:  # powers of two of k, put one behind the other
        if k & at:
            part = have[done : done + n]
            out = part.copy() if out is None else mix(out * U(0xD6E8FEB86659FD93) + part)
            done += at
        if 2 * at > k:
            return out
        have = mix(have[: len(have) - at] * U(0xA0761D6478BD642F) + have[at:])
        at *= 2


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Which of the runs of k words lie within one text: a mask over word numbers 0 to n - k."""
    n = int(first[-1])
    ok = np.ones(max(0, n - k + 1), bool)
    if len(ok):
        left = np.zeros(n + 1, np.int32)  # +1 and -1 around the last k - 1 starts of each text
        ends, size = first[1:], np.diff(first)
        back = np.minimum(k - 1, size)
        np.add.at(left, ends - back, 1)
        np.add.at(left, ends, -1)
        ok = np.cumsum(left)[: len(ok)] == 0
    return ok


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word hashes of each text, with where each text's begin. A text of fewer words has one: all its words."""
    n_docs, first = len(w.first) - 1, w.first
    size = np.diff(first)
    r, ok = runs(w.hash, k), inside(first, k)
    owner = np.repeat(np.arange(n_docs), size)
    value, doc = r[ok], owner[: len(ok)][ok]
    few = np.flatnonzero((size > 0) & (size < k))
    if len(few):
        short = []
        for i in few:
            x = np.array([size[i]], np.uint64)
            for y in w.hash[first[i] : first[i + 1]]:
                x = mix(x * U(0xE7037ED1A0B428DB) + y)
            short.append(x[0])
        value, doc = np.concatenate([value, np.array(short, np.uint64)]), np.concatenate([doc, few])
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    value, doc = value[order], doc[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[keep], doc[keep]
    return value, np.searchsorted(doc, np.arange(n_docs + 1))


def binary(parts: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes from one flat array; offsets count its elements."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64) * parts.itemsize), pa.py_buffer(np.ascontiguousarray(parts))]).cast(pa.binary())


def flat(column: pa.Array | pa.ChunkedArray, dtype=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of binary()."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], pa.binary())
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.copy().view(dtype), (offs - offs[0]) // np.dtype(dtype).itemsize

"""Lattices of segments of any length."""

from fractions import Fraction

import numpy as np
import pytest

from corvane.llm import pieces
from corvane.llm.words import mix

TEXTS = ["there" * 40, "https://example.org/" + "aQz9" * 30, "東京都は日本の首都である" * 12, "สวัสดีชาวโลก" * 12, " " * 300, "if (x) {\r\n\r\r  y();\r\n}\x01\t\x7f", "x" * 700]


@pytest.mark.parametrize("text", TEXTS)
def test_shares_are_those_of_the_whole_lattice(text):
    v, raw = pieces.load(), text.encode()
    n, byte_ids = len(raw), v.byte_ids.tolist()
    ids = {t: i for i, t in enumerate(v.text) if t and i not in set(byte_ids)}
    starts = [k for k in range(n) if raw[k] & 0xC0 != 0x80]
    edges = {(a, b): ids[raw[a:b]] for a in starts for b in [*starts, n] if a < b <= a + v.longest and raw[a:b] in ids}
    for a, b in zip(starts, [*starts[1:], n], strict=True):
        if (a, b) not in edges:
            edges |= {(k, k + 1): byte_ids[raw[k]] for k in range(a, b)}
    total = [Fraction(1), *[Fraction(0)] * n]
    for (a, b), i in sorted(edges.items(), key=lambda e: e[0][1]):
        total[b] += total[a] * Fraction(v.weight[i])
    data, offs = np.frombuffer(raw, np.uint8), np.array([0, n])
    cuts = [*pieces.segments(v, data, offs).tolist(), n]
    assert not any(a < c < b for a, b in edges for c in cuts)
    found = {}
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        into, summed, source, piece = pieces.lattice(v, data[x:y], np.array([0, y - x]))
        units = np.diff(np.append(0, summed))
        for node in range(1, y - x + 1):
            some = range(into[node], into[node + 1])
            found |= {(x + int(source[e]), x + node): (int(piece[e]), units[e] / units[some].sum()) for e in some}
    assert {e: i for e, (i, _) in found.items()} == edges
    for (a, b), (i, share) in found.items():
        assert abs(share - float(total[a] * Fraction(v.weight[i]) / total[b])) < 1e-9


def test_pieces_cross_where_long_segments_were_cut():
    v = pieces.load()
    n, raw = 400, ("there" * 40).encode()
    data, offs = np.frombuffer(raw * n, np.uint8), np.arange(n + 1) * len(raw)
    out, at = pieces.sample(v, data, offs, mix(np.arange(n).astype(np.uint64)), 0)
    inner = 0
    for a, b in zip(at[:-1], at[1:], strict=True):
        ends = np.cumsum([len(v.text[i]) for i in out[a:b]])
        assert ends[-1] == len(raw)
        inner += 64 not in ends
    assert inner > n // 10

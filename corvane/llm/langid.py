"""Languages of words, spans and texts.

Learned are counts of byte trigrams of each language (A-Z folded, other ASCII as spaces). Each word gets a score for each
language: the sum of its trigrams' log probabilities. The script of a word, by ranges of its characters, narrows the languages to
those learned in that script. Viterbi then labels the words of a text, with a penalty for each switch of
language, so spans of mixed text are found. A text's language is that with most letters.

Learned from a bounded sample: about SAMPLE documents of each language, chosen by a hash of doc_id; their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.words import buffer, steps, words
from corvane.session import ship

SAMPLE, BITS, SWITCH, STEP = 3000, 16, 9.0, 4 << 20
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
#: Script ranges: first code point, and the number of the script that holds from there on; 0 is none (signs, digits, marks).
RANGES = (
    (0x00, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xC0, 1), (0x2B0, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 7), (0x780, 8), (0x7C0, 9),
    (0x900, 10), (0x980, 11), (0xA00, 12), (0xA80, 13), (0xB00, 14), (0xB80, 15), (0xC00, 16), (0xC80, 17), (0xD00, 18), (0xD80, 19), (0xE00, 20), (0xE80, 21), (0xF00, 22), (0x1000, 23), (0x10A0, 24),
    (0x1100, 25), (0x1200, 26), (0x13A0, 27), (0x1780, 28), (0x1800, 29), (0x18B0, 9), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 9), (0x3000, 0), (0x3040, 30), (0x30A0, 31), (0x3100, 9), (0x3400, 32),
    (0xA000, 9), (0xAC00, 25), (0xD7B0, 9), (0xF900, 32), (0xFB00, 1), (0xFB13, 4), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF3B, 0), (0xFF41, 1), (0xFF5B, 0),
    (0xFF66, 31), (0xFFA0, 25), (0xFFE0, 0), (0x10000, 9), (0x1F000, 0), (0x20000, 32), (0xE0000, 0),
)
SCRIPTS = 33
_FROM = np.array([x for x, _ in RANGES])
_IS = np.array([s for _, s in RANGES], np.int8)
_ASCII = _IS[np.searchsorted(_FROM, np.arange(128), "right") - 1]


def trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram around each byte, and which bytes are of letters."""
    x = _FOLD[data].astype(np.uint32)
    left, right = np.empty_like(x), np.empty_like(x)
    left[1:], right[:-1] = x[:-1], x[1:]
    left[offs[:-1][offs[:-1] < len(x)]] = 0x20
    right[offs[1:][offs[1:] > 0] - 1] = 0x20
    code = (left << np.uint32(16) | x << np.uint32(8) | right) * np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - BITS), x != 0x20


def counted(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, place, n): trigram counts, and at negative places those of words by script."""
    total: dict[str, np.ndarray] = {}
    for t in tables:
        langs = np.array(t["lang"].to_pylist(), object)
        data, offs = buffer(t["text"])
        for i, j in steps(offs):
            sub, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            code, letter = trigrams(sub, o)
            doc = np.repeat(np.arange(i, j), np.diff(o))
            w = words(sub, o)
            script = word_scripts(sub, w)
            owner = np.repeat(np.arange(i, j), np.diff(w.first))
            for lang in set(langs[i:j]):
                n = total.setdefault(lang, np.zeros((1 << BITS) + SCRIPTS, np.int64))
                n[: 1 << BITS] += np.bincount(code[letter & (langs[doc] == lang)], minlength=1 << BITS)
                n[1 << BITS :] += np.bincount(script[langs[owner] == lang], minlength=SCRIPTS)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "place", "n"])


def scripts(data: np.ndarray) -> np.ndarray:
    """The script of the character that starts at each byte; 0 at bytes within a character."""
    out = np.where(data < 0x80, _ASCII[data & 0x7F], 0).astype(np.int8)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        more = np.concatenate([data, np.zeros(3, np.uint8)])
        size = np.digitize(data[lead], (0xE0, 0xF0)) + 1  # bytes that follow
        code = data[lead].astype(np.int64) & np.array([0, 0x1F, 0x0F, 0x07])[size]
        for k in (1, 2, 3):
            code = np.where(size >= k, code << 6 | more[lead + k] & 0x3F, code)
        out[lead] = _IS[np.searchsorted(_FROM, code, "right") - 1]
    return out


def word_scripts(data: np.ndarray, w) -> np.ndarray:
    """The script of each word: that of the highest number among its characters, 0 where it has no letter."""
    return np.maximum.reduceat(scripts(data), w.start) if len(w.start) else np.zeros(0, np.int8)


class Model:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        self.step = max(1 << 16, STEP * 8 // max(8, len(self.langs)))  # bytes of text at once: words times languages are bounded
        table = np.array([counts[k] for k in self.langs], float).reshape(-1, (1 << BITS) + SCRIPTS)
        n = table[:, : 1 << BITS]
        self.log = np.log((n + 0.3) / (n.sum(1, keepdims=True) + 0.3 * (1 << BITS))).astype(np.float32)
        s = table[:, 1 << BITS :]
        self.bar = np.where(s >= 0.005 * np.maximum(1, s[:, 1:].sum(1, keepdims=True)), 0.0, -1e4)
        self.bar[:, 0] = 0
        self.bar[:, (self.bar < 0).all(0)] = 0  # a script that nobody has narrows nothing

    def label(self, data: np.ndarray, offs: np.ndarray):
        """The words of the texts, each word's language number and its letters."""
        w = words(data, offs)
        code, letter = trigrams(data, offs)
        n = np.append(0, np.cumsum(letter))
        letters = n[w.end] - n[w.start]
        emit = np.empty((len(w.start), len(self.langs)))
        script = word_scripts(data, w)
        for k in range(len(self.langs)):
            total = np.append(0.0, np.cumsum(np.where(letter, self.log[k][code], 0), dtype=np.float64))
            emit[:, k] = total[w.end] - total[w.start] + self.bar[k][script]
        emit -= emit.max(1, keepdims=True) if len(emit) else 0
        return w, viterbi(emit, w.first), letters


def viterbi(emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best labels of all texts at once: step t handles word t of every text that has one."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # texts with more than t words
    kind = np.min_scalar_type(-max(1, emit.shape[1]))
    back = np.zeros(emit.shape, kind)
    best = np.zeros((len(size), emit.shape[1]))
    for t in range(longest):
        k = active[t]
        at = start[:k] + t
        now = best[:k]
        if t:
            top = now.argmax(1)
            move = now[np.arange(k), top][:, None] - SWITCH
            stay = now >= move
            back[at] = np.where(stay, np.arange(emit.shape[1], dtype=kind), top[:, None])
            now = np.where(stay, now, move)
        best[:k] = now + emit[at]
    label = np.zeros(len(emit), kind)
    state = best.argmax(1).astype(kind)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = start[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return label


def has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts with at least one Unicode letter."""
    n = np.append(0, np.cumsum((data < 0x80) & (_ASCII[data & 0x7F] == 1)))
    found = n[offs[1:]] > n[offs[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offs) > 0)):
        found[i] = any(c.isalpha() for c in bytes(data[offs[i] : offs[i + 1]]).decode(errors="replace"))
    return found


def fit(docs: DataFrame, out: int = 1, fold: int = 3) -> Model:
    """docs: doc_id, text, lang. Rows of the held-out fold and with a null lang, id or text are left out. The model holds 2**BITS numbers for each language, so languages are some hundreds at most."""
    ship(docs.sparkSession)
    use = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out(out, fold))
    sizes = use.groupBy("lang").agg(F.count("*").alias("all"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = use.select("doc_id", "text", "lang").join(F.broadcast(sizes), "lang").where(chance * F.col("all") < SAMPLE)
    rows = some.select("lang", "text").mapInArrow(counted, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, part in rows.groupby("lang"):
        counts[lang] = np.zeros((1 << BITS) + SCRIPTS, np.int64)
        counts[lang][part["place"].to_numpy()] = part["n"].to_numpy()
    return Model(counts)


def held_out(out: int = 1, fold: int = 3):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % fold == out


def predict(model: Model):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            data, offs = buffer(t["text"])
            for i, j in steps(offs, model.step):
                sub, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                name, score = np.full(j - i, "und", object), np.zeros(j - i)
                if model.langs:
                    w, label, letters = model.label(sub, o)
                    owner = np.repeat(np.arange(j - i), np.diff(w.first))
                    weight = np.bincount(owner * len(model.langs) + label.astype(np.int64), weights=letters, minlength=(j - i) * len(model.langs)).reshape(j - i, -1)
                    some = has_letter(sub, o)
                    best = weight.argmax(1)
                    name = np.where(some, np.array(model.langs, object)[best], "und")
                    score = np.where(some, weight.max(1) / np.maximum(1, weight.sum(1)), 0.0)
                yield pa.RecordBatch.from_arrays([t["doc_id"][i:j], pa.array(name.tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return run


def languages(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score (share of letters in that language's spans)."""
    model = fit(docs)
    return docs.select("doc_id", "text").mapInArrow(predict(model), "doc_id long, lang_pred string, score double").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def language_spans(docs: DataFrame, model: Model) -> DataFrame:
    """Spans of one language: doc_id, first_word, n_words, lang. Texts without words have none."""
    ship(docs.sparkSession)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            data, offs = buffer(t["text"])
            for i, j in steps(offs, model.step):
                w, label, _ = model.label(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                owner = np.repeat(np.arange(j - i), np.diff(w.first))
                new = np.ones(len(label), bool)
                new[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
                start = np.flatnonzero(new)
                n = np.diff(np.append(start, len(label)))
                yield pa.RecordBatch.from_arrays([t["doc_id"][i:j].take(pa.array(owner[start])), pa.array(start - w.first[owner[start]]), pa.array(n), pa.array([model.langs[k] for k in label[start]], pa.string())], ["doc_id", "first_word", "n_words", "lang"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, first_word long, n_words long, lang string")

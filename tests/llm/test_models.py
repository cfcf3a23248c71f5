"""Leaks, quality, languages and neighbours: brute force, held-out accuracy and odd rows."""

import math
import random
import zlib

import numpy as np

from corvane.llm import ann, decontam, langid, quality

SF = "/root/testdata/sf0.01"


def plain(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def smith_waterman(a, b):
    best, row = 0.0, [0.0] * (len(b) + 1)
    for x in a:
        new = [0.0]
        for j, y in enumerate(b):
            new.append(max(0.0, row[j] + (1 if x == y else -0.5), row[j + 1] - 0.5, new[j] - 0.5))
        best, row = max(best, *new), new
    return best / len(a)


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, n))] for n in (12, 30))
        s, i, j = decontam.align(np.array(a), np.array(b))
        assert math.isclose(s / len(a), smith_waterman(a, b), abs_tol=1e-9) and 0 <= i <= j <= len(b)


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(k, " ".join(rng.choices(vocab, k=30))) for k in range(12)] + [(90, None), (91, ""), (92, "tiny one")]
    docs = []
    for d in range(150):
        w = rng.choices(vocab, k=120)
        if d % 3 == 0:
            leak = items[d % 12][1].split()
            for _ in range(d % 12):
                leak[rng.randrange(len(leak))] = rng.choice(vocab)
            if d % 5 == 0:
                del leak[rng.randrange(len(leak))]
            w[40:40] = leak
        docs.append((d, " ".join(w).upper() if d % 2 else ", ".join(w)))
    docs += [(900, None), (901, ""), (902, "some TINY, one here"), (None, items[0][1])]
    exact = {(d, k): smith_waterman(plain(x), plain(t) or [None]) for d, t in docs for k, x in items if plain(x)}
    docs_df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontam.leaks(docs_df, bench).collect()}
    assert all(math.isclose(x, exact[p]) for p, x in found.items()) and (902, 92) in found
    assert found.keys() == {p for p, x in exact.items() if x >= decontam.THRESHOLD}
    want = set(found)
    kept = decontam.drop_leaks(docs_df, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want} and kept.columns == docs_df.columns
    assert decontam.leaks(docs_df.limit(0), bench).collect() == [] and decontam.leaks(docs_df, bench.limit(0)).collect() == []


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x " * 50_000)], "doc_id long, text string")
    assert quality.quality_scores(odd, labels).count() == 3
    assert all(math.isclose(r.score, 0.3) and r.predicted == 1 for r in quality.quality_scores(docs.limit(5), labels.limit(0)).collect())
    assert quality.quality_scores(docs.limit(0), labels.limit(0)).count() == 0


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.languages(docs).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97
    model = langid.fit(docs)
    long = {lang: next(r.text for r in docs.where(f"lang = '{lang}' and n_chars between 800 and 1500").collect()) for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, long["en"] + " " + long["de"])], "doc_id long, text string")
    spans = sorted(langid.language_spans(mixed, model).collect(), key=lambda r: r.first_word)
    assert [r.lang for r in spans] == ["en", "de"] and abs(spans[0].n_words - len(long["en"].split())) <= 3
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 !! 3", None), (4, "東京", None), (None, "the the", "en")], "doc_id long, text string, lang string")
    more = docs.where("lang = 'en' and doc_id > 10").select("doc_id", "text", "lang")
    out = {r.doc_id: r.lang_pred for r in langid.languages(odd.union(more)).collect()}
    assert out[1] == out[2] == out[3] == "und" and out[4] == out[None] == "en"
    assert langid.languages(odd.limit(0)).count() == 0


def test_viterbi_equals_brute_force():
    from itertools import product

    rng = np.random.default_rng(1)
    sizes = [4, 0, 6, 1]
    first = np.append(0, np.cumsum(sizes))
    emit = rng.normal(0, 9, (sum(sizes), 3))
    label = langid.viterbi(emit, first)
    score = lambda e, p: sum(e[i, k] for i, k in enumerate(p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:], strict=False))
    for a, b in zip(first[:-1], first[1:], strict=True):
        e = emit[a:b]
        assert math.isclose(score(e, label[a:b]), max(score(e, p) for p in product(range(3), repeat=b - a)))


def test_many_languages_keep_their_numbers():
    emit = np.zeros((6, 200))
    emit[:3, 183], emit[3:, 20] = 50, 50
    assert langid.viterbi(emit, np.array([0, 6])).tolist() == [183] * 3 + [20] * 3
    labels = langid.viterbi(np.eye(128)[[127, 127]] * 99, np.array([0, 1, 2]))
    assert labels.tolist() == [127, 127]


def test_scripts_go_by_code_points():
    of = lambda s: max(langid.scripts(np.frombuffer(s.encode(), np.uint8)).tolist(), default=0)
    assert len({of(s) for s in ("việt", "ไทย", "हिंदी", "ქართული", "ελληνικά", "привет", "עברית", "عربي", "한국", "東京")}) == 10
    assert of("東京，") == of("東") and of("Ａ") == of("a") == of("ﬁ") and of("12！。") == 0


def test_language_scores_against_a_plain_model(spark):
    """Word scores, texts' labels and shares again, word by word."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")
    model = langid.fit(docs)
    at = {k: i for i, k in enumerate(model.langs)}

    def score(word, lang):
        folded = b" " + bytes(langid._FOLD[x] for x in word) + b" "
        codes = [((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for a, b, c in zip(folded, folded[1:], folded[2:], strict=False) if b != 0x20]
        script = max([int(x) for x in langid.scripts(np.frombuffer(word, np.uint8))], default=0)
        return sum(float(model.log[at[lang]][c]) for c in codes) + float(model.bar[at[lang]][script])

    rows = docs.select("doc_id", "text").where("length(text) < 400").limit(25).collect()
    got = {r.doc_id: r for r in langid.languages(docs).collect()}
    for r in rows:
        words = r.text.encode().split()
        best, back = {k: 0.0 for k in model.langs}, []
        for n, w in enumerate(words):
            top = max(model.langs, key=lambda k: (best[k], -at[k]))
            move = best[top] - langid.SWITCH if n else 0.0
            back.append({k: k if best[k] >= move or not n else top for k in model.langs})
            best = {k: max(best[k], move) + score(w, k) for k in model.langs}
        state, letters = max(model.langs, key=lambda k: (best[k], -at[k])), {}
        for w, b in zip(words[::-1], back[::-1], strict=True):
            letters[state] = letters.get(state, 0) + sum(langid._FOLD[x] != 0x20 for x in w)
            state = b[state]
        if letters and sum(letters.values()):
            want = max(letters, key=letters.get)
            assert got[r.doc_id].lang_pred == want and math.isclose(got[r.doc_id].score, letters[want] / sum(letters.values()), abs_tol=1e-6)


def test_quality_scores_against_plain_features(spark):
    """The linear score of features that are counted again letter by letter and word by word."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)

    def features(text):
        data = (text or "").encode()
        size = max(1, len(data))
        named = {b for k in quality._KINDS for b in k.encode()}
        shares = [math.log1p(200 * sum(b in k.encode() for b in data) / size) for k in quality._KINDS] + [math.log1p(200 * sum(b >= 0x80 for b in data) / size)]
        words = [w.lower() for w in data.split()]
        n = max(1, len(words))
        mean = sum(map(len, words)) / n
        assert not any(b >= 0x80 for b in named)
        return [*shares, math.log1p(20 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n), (len(words) - len(set(words))) / n, math.log1p(mean), math.log1p(sum(abs(len(w) - mean) for w in words) / n), math.log1p(len(words)), float(not words)]

    rows = docs.select("doc_id", "text").where("doc_id % 20 = 0").collect()
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    for r in rows:
        z = [max(-8, min(8, (x - m) / s)) for x, m, s in zip(features(r.text), model.mean, model.sd, strict=True)]
        s = sum(a * b for a, b in zip(z, model.w, strict=True)) - model.at + math.log(quality.CUT / (1 - quality.CUT))
        assert math.isclose(got[r.doc_id], 1 / (1 + math.exp(-s)), abs_tol=1e-9)


def test_fit_takes_one_text_of_a_repeated_id(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    again = docs.union(docs.where("doc_id % 3 = 0")).union(docs.where("doc_id % 3 = 0"))
    assert (quality.fit(again, labels).w == quality.fit(docs, labels).w).all()


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (12, 16))
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(0, 0.3, (3000, 16))
    x[200:600] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest(df).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and all(r.vec_id != q for r in mine)
        s = unit @ unit[q]
        assert all(abs(r.score - s[r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        s[q] = -2
        hits += len({r.vec_id for r in mine} & set(np.lexsort((np.arange(3000), -np.round(s, 12)))[:5].tolist()))
    assert hits >= 0.9 * 5 * 60 and len({r.query_id for r in out}) == 60
    assert [r.vec_id for r in sorted((r for r in out if r.query_id == 50), key=lambda r: r.rank)] == [200, 201, 202, 203, 204]
    assert ann.nearest(df.limit(0)).collect() == [] and ann.nearest(df.limit(1)).collect() == []


def test_quality_learns_from_every_label_and_pair(spark):
    """More documents of a label than a former sample took, against sums over all documents and a list of all pairs."""
    rng = random.Random(8)
    text = lambda good: " ".join(rng.choice(["spam", "spam", "#1", "now!"] if rng.random() < (0.2 if good else 0.5) else ["one", "longer", "sentence.", "Here"]) for _ in range(12))
    rows = [(k, text(k % 40 == 0), int(k % 40 == 0)) for k in range(8600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    model = quality.fit(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    used = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    y = np.array([r[2] for r in used])
    assert (y == 0).sum() > 6000
    data = [r[1].encode() for r in used]
    x = quality.features(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data])))
    assert np.allclose(model.mean, x.mean(0), atol=1e-5) and np.allclose(model.sd, x.std(0), atol=1e-5)
    z = np.clip((x - model.mean) / model.sd, -8, 8)

    def plain(w):
        s = z @ w
        lead = s[y == 1][:, None] - s[y == 0]
        wrong = 1 / (1 + np.exp(lead))
        return np.logaddexp(0, -lead).mean() + quality.DECAY / 2 * w @ w, (wrong.mean(0) @ z[y == 0] / (y == 0).sum() - wrong.mean(1) @ z[y == 1] / (y == 1).sum()) + quality.DECAY * w

    best, slope = plain(model.w)
    assert np.abs(slope).max() < 1e-3 and all(plain(model.w + d)[0] > best - 1e-6 for d in np.random.default_rng(1).normal(0, 0.02, (20, len(model.w))))
    s = z @ model.w
    gain = lambda c: (s[y == 1] >= c).mean() + (s[y == 0] < c).mean()
    assert gain(model.at) >= max(map(gain, s)) - 0.005

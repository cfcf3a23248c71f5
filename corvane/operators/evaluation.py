"""Agreement, relevance scores and their evaluation, all as aggregates and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import is_token, raw_tokens, tokens
from corvane.session import table


def kappa(rows: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Rows, accuracy and Cohen's kappa; NaN where chance agreement is 1."""
    by = by or []
    pairs = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, a, b).count()
    total = F.sum("count").over(Window.partitionBy(*[F.col(c) for c in by] or [F.lit(1)]))
    row = F.sum("count").over(Window.partitionBy(*by, a))
    side = pairs.withColumns({"n": total, "ra": row})
    margin_b = pairs.groupBy(*by, F.col(b).alias("_c")).agg(F.sum("count").alias("rb"))
    margin_a = side.groupBy(*by, F.col(a).alias("_c")).agg(F.first("ra").alias("ra"), F.first("n").alias("n"))
    chance = margin_a.join(margin_b, [*by, "_c"]).groupBy(*by).agg(F.sum(F.col("ra") * F.col("rb") / (F.col("n") * F.col("n"))).alias("pe"))
    same = pairs.groupBy(*by).agg(F.sum("count").alias("n_scored"), (F.sum(F.when(F.col(a) == F.col(b), F.col("count")).otherwise(0)) / F.sum("count")).alias("po"))
    out = same.join(chance, by, "left") if by else same.crossJoin(chance)  # one row with one row
    pe = F.coalesce("pe", F.lit(0.0))
    return out.select(*by, "n_scored", F.round("po", 6).alias("accuracy"), F.round(F.when(pe == 1, float("nan")).otherwise((F.col("po") - pe) / (1 - pe)), 6).alias("kappa"))


def weighted_sum(text: Column, lexicon: dict[str, float], exclude: dict[str, float], weight: float = 1.0) -> Column:
    """Sum of the weights of terms that are substrings of the text, less the absolute weights of excluded ones."""
    low = F.lower(text)
    plus = [F.when(low.contains(t), w).otherwise(0.0) for t, w in sorted(lexicon.items())]
    minus = [F.when(low.contains(t), abs(w)).otherwise(0.0) for t, w in sorted(exclude.items())]
    zero = F.lit(0.0)
    return sum(plus, zero) - F.lit(weight) * sum(minus, zero)


def matched_terms(text: Column, terms: list[str]) -> Column:
    """Those terms that the text holds anywhere, whole words or not; null text holds none."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.contains(t), t) for t in terms]))


def term_counts(docs: DataFrame, key: str, text: str, lemmas: Column | None = None) -> DataFrame:
    """(key, term, tf) of tokens, written once, as all that is derived from it reads it again. Each text is tokenised once."""
    words = docs.select(key, F.explode(raw_tokens(F.col(text))).alias("term")).where(is_token(F.col("term")))
    if lemmas is not None:
        words = words.withColumn("term", F.coalesce(F.try_element_at(lemmas, F.col("term")), "term"))
    return table(words.groupBy(key, "term").agg(F.count("*").alias("tf")), "terms")


def _times(query: list[str]) -> dict[str, int]:
    return {t: query.count(t) for t in sorted(set(query))}


def _held(counts: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """Per key the sum of all counts, and the counts of some terms (t0, t1...): one aggregate, no row for a term."""
    return counts.groupBy(key).agg(F.sum("tf").alias("len"), *[F.sum(F.when(F.col("term") == t, F.col("tf"))).alias(f"t{i}") for i, t in enumerate(terms)])


def bm25(docs: DataFrame, key: str, text: str, query: list[str], exclude: list[str] = (), weight: float = 1.0, k1: float = 1.5, b: float = 0.75, floor: float = 0.25) -> DataFrame:
    """Okapi BM25 of every document for a bag of query terms, less weight times that for the excluded ones; a repeated term counts again, a negative idf becomes floor times the mean idf."""
    counts, n = term_counts(docs, key, text), docs.count()
    df = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("all"))
    idf = F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    terms = sorted({*query, *exclude})
    row = df.withColumn("idf", idf).agg(F.sum("all").alias("all"), F.avg("idf").alias("mean"), *[F.max(F.when(F.col("term") == t, F.col("idf"))).alias(f"i{i}") for i, t in enumerate(terms)]).first()
    avg, mean = (row["all"] or 0) / max(n, 1) or 1.0, row["mean"] or 0.0
    sign = {t: query.count(t) - weight * list(exclude).count(t) for t in terms}
    score = F.lit(0.0)
    for i, t in enumerate(terms):
        if (x := row[f"i{i}"]) is not None:
            tf = F.coalesce(f"t{i}", F.lit(0))
            score = score + F.lit(sign[t] * (floor * mean if x < 0 else x)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.lit(avg)))
    scores = _held(counts, key, terms).select(key, score.alias("score"))
    return docs.select(key).join(scores, key, "left").select(key, F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"))


def tfidf_cosine(docs: DataFrame, key: str, text: str, query: list[str], exclude: list[str] = (), weight: float = 1.0) -> DataFrame:
    """Cosine of documents to a pseudo-document of the query terms, less weight times that to one of the excluded terms; fitted on all of them."""
    import math

    extra = [_times(list(q)) for q in (query, exclude) if q]
    n, counts = docs.count() + len(extra), term_counts(docs, key, text)
    terms = sorted({t for q in extra for t in q})
    more = sum((F.when(F.col("term").isin(*q), 1).otherwise(0) for q in extra), F.lit(0))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    idf = df.select("term", (F.log(F.lit(1.0 + n) / (1 + F.col("df") + more)) + 1).alias("idf"))
    seen = {r.term: r.idf for r in idf.where(F.col("term").isin(*terms)).collect()}  # at most a row a term
    of = lambda t: seen.get(t, math.log((1 + n) / (1 + sum(t in q for q in extra))) + 1)
    weights: dict[str, float] = {}
    for q, w in zip(extra, (1.0, -weight), strict=False):
        length = math.sqrt(sum((m * of(t)) ** 2 for t, m in q.items())) or 1.0
        for t, m in q.items():
            weights[t] = weights.get(t, 0.0) + w * m * of(t) / length
    part = F.create_map(*[x for t, v in sorted(weights.items()) for x in (F.lit(t), F.lit(v))])
    w = F.col("tf") * F.col("idf")
    s = counts.join(idf, "term").groupBy(key).agg(F.sum(F.coalesce(F.try_element_at(part, F.col("term")), F.lit(0.0)) * w).alias("dot"), F.sqrt(F.sum(w * w)).alias("norm"))
    return docs.select(key).join(s, key, "left").select(key, F.round(F.coalesce(F.col("dot") / F.col("norm"), F.lit(0.0)), 6).alias("score"))


def ngram_counts(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """(key, term, tf) of runs of 1 to most tokens."""
    t = docs.select(key, tokens(F.col(text)).alias("w"))
    runs = F.flatten(F.array(*map(_runs, range(1, most + 1))))
    return table(t.select(key, F.explode(runs).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf")), "ngrams")


def _runs(n: int) -> Column:
    joined = lambda i: F.array_join(F.slice("w", i, n), " ")
    return F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), joined)).otherwise(F.array().cast("array<string>"))


def discriminative_terms(docs: DataFrame, key: str, text: str, label: str, least: int = 3, most: float = 0.85, grams: int = 1, features: int | None = None) -> DataFrame:
    """Mean sublinear tf-idf of terms (runs of up to grams tokens) in documents of label 1 less that in label 0; of all terms only the features commonest ones, if given."""
    n, n1 = docs.agg(F.count("*"), F.count_if(F.col(label) == 1)).first()
    counts = ngram_counts(docs, key, text, grams) if grams > 1 else term_counts(docs, key, text)
    df = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("all")).where((F.col("df") >= least) & (F.col("df") <= most * n))
    if features is not None:
        df = df.orderBy(F.desc("all"), "term").limit(features)
    rows = counts.join(df.drop("all"), "term").withColumn("w", (1 + F.log("tf")) * (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1))
    norm = rows.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    w = rows.join(norm, key).join(docs.select(key, label), key).withColumn("w", F.col("w") / F.col("norm"))
    mean = lambda y, m: F.coalesce(F.sum(F.when(F.col(label) == y, F.col("w"))), F.lit(0.0)) / max(1, m)
    return w.groupBy("term").agg(F.first("df").alias("document_frequency"), F.round(mean(1, n1) - mean(0, n - n1), 6).alias("discriminative_score"))


def key_phrases(docs: DataFrame, candidates: DataFrame, key: str, k: int = 5, diversity: float = 0.5) -> DataFrame:
    """The k candidates of each document by maximal marginal relevance: like the document, unlike those already chosen.

    docs: key, vector; candidates: key, phrase, vector (those of one document are few; their vectors come from the caller's model).
    One fold for each document over the places 1 to k, in the JVM; ties go to the smaller phrase.
    """
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    unit = lambda v: F.transform(v, lambda x: x / F.sqrt(dot(v, v)))
    d = docs.select(key, F.col("vector").cast("array<double>").alias("_d"))
    c = candidates.select(key, "phrase", F.col("vector").cast("array<double>").alias("v")).join(d, key)
    own = c.select(key, F.struct("phrase", unit(F.col("v")).alias("v"), F.round(dot(unit(F.col("v")), unit(F.col("_d"))), 9).alias("like")).alias("c"))
    g = own.groupBy(key).agg(F.sort_array(F.collect_list("c")).alias("all"))
    start = F.slice("all", 1, 0)

    def choose(acc: Column, _: Column) -> Column:
        rest = F.filter("all", lambda c: ~F.exists(acc, lambda a: a["phrase"] == c["phrase"]))
        near = lambda c: F.coalesce(F.array_max(F.transform(acc, lambda a: dot(a["v"], c["v"]))), F.lit(0.0))
        graded = F.transform(rest, lambda c: F.struct(F.round(F.when(F.size(acc) == 0, c["like"]).otherwise((1 - diversity) * c["like"] - diversity * near(c)), 9).alias("mmr"), c.alias("c")))
        best = F.aggregate(graded, F.get(graded, F.lit(0)), lambda m, x: F.when(x["mmr"] > m["mmr"], x).otherwise(m))
        return F.when(F.size(rest) > 0, F.concat(acc, F.array(best["c"]))).otherwise(acc)

    chosen = F.aggregate(F.sequence(F.lit(1), F.lit(k)), start, choose)
    return g.select(key, F.posexplode(chosen).alias("place", "c")).select(key, (F.col("place") + 1).alias("place"), "c.phrase", F.col("c.like").alias("score"))


#: Corpus scorers by name: each takes (docs, key, text, query terms, excluded terms, weight) and returns key and score.
SCORERS = {
    "weighted_sum": lambda docs, key, text, query, exclude, weight: docs.select(key, F.round(weighted_sum(F.col(text), dict.fromkeys(query, 1.0), dict.fromkeys(exclude, 1.0), weight), 6).alias("score")),
    "bm25": bm25,
    "tfidf_cosine": tfidf_cosine,
}


def bake_off(docs: DataFrame, key: str, text: str, label: str, query: list[str], exclude: list[str], weight: float = 1.0, scorers: dict | None = None) -> DataFrame:
    """Each scorer's area under the curve, threshold and measures at it, correlation, and precision and recall at score quantiles."""
    from functools import reduce

    out = []
    for name, scorer in (scorers or SCORERS).items():
        rows = table(scorer(docs, key, text, query, exclude, weight).join(docs.select(key, label), key), "scored")
        best = auroc_youden(rows, "score", label)
        at = best.first()
        m = confusion(rows, F.col("score") >= (at.threshold if at.threshold is not None else float("inf")), label)
        one = best.crossJoin(m).crossJoin(rows.agg(F.round(F.corr("score", F.col(label).cast("double")), 6).alias("correlation")))  # one row each
        out.append(one.select(F.lit(name).alias("scorer"), "auroc", "threshold", "precision", "recall", "f1", "correlation"))
    return reduce(DataFrame.unionByName, out)


def at_quantiles(rows: DataFrame, score: str, label: str, quantiles: list[float]) -> DataFrame:
    """Precision and recall of score >= its quantile (interpolated); NaN where nothing is there to divide by."""
    cuts = rows.agg(F.percentile(score, F.array(*[F.lit(q) for q in quantiles]))).first()[0] or []
    n1 = F.sum(label)
    up = [F.coalesce(F.col(score) >= c, F.lit(False)) for c in cuts]
    aggs = [a for i, u in enumerate(up) for a in (F.count_if(u).alias(f"n{i}"), F.sum(F.when(u, F.col(label)).otherwise(0)).alias(f"p{i}"))]
    one = rows.agg(n1.alias("all"), *aggs)
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(float("nan")), 6)
    each = F.array(*[F.struct(F.lit(q).alias("quantile"), F.round(F.lit(c), 6).alias("cut"), F.col(f"n{i}").alias("n"), ratio(F.col(f"p{i}"), F.col(f"n{i}")).alias("precision"), ratio(F.col(f"p{i}"), F.col("all")).alias("recall")) for i, (q, c) in enumerate(zip(quantiles, cuts, strict=False))])
    return one.select(F.inline(each)) if cuts else rows.sparkSession.createDataFrame([], "quantile double, cut double, n long, precision double, recall double")


def roc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """One row for each distinct score from the highest down: cumulative true and false positive rates.

    Counts are aggregated to distinct (rounded) scores before the running sum, whose window has one partition by nature.
    """
    per = rows.groupBy(score).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("q"))
    w = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    total = per.agg(F.sum("p").alias("np"), F.sum("q").alias("nq"))
    cum = per.select(score, F.sum("p").over(w).alias("tp"), F.sum("q").over(w).alias("fp")).crossJoin(F.broadcast(total))  # one row
    return cum.select(score, "tp", "fp", "np", "nq", (F.col("tp") / F.nullif("np", F.lit(0))).alias("tpr"), (F.col("fp") / F.nullif("nq", F.lit(0))).alias("fpr"))


def auroc_youden(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve by trapezoids (ties halved) and the first threshold with the largest tpr - fpr."""
    c = roc(rows, score, label)
    w = Window.orderBy(F.desc(score))
    c = c.withColumns({"x0": F.coalesce(F.lag("fpr").over(w), F.lit(0.0)), "y0": F.coalesce(F.lag("tpr").over(w), F.lit(0.0))})
    return c.agg(
        F.round(F.sum((F.col("fpr") - F.col("x0")) * (F.col("tpr") + F.col("y0")) / 2), 6).alias("auroc"),
        F.round(F.max_by(score, F.struct(F.round(F.col("tpr") - F.col("fpr"), 12), F.col(score))), 6).alias("threshold"),
    )


def agreement(rows: DataFrame, label: str, verdict: str, labels: tuple[str, ...], error: str = "parse_error", open_: str = "undeterminable", by: list[str] | None = None) -> DataFrame:
    """All rows, scored ones, errors, the share of undetermined ones, accuracy among decided ones, and kappa over a fixed list of labels; NaN of nothing.

    Marginals are conditional counts, so all is one pass over the rows.
    """
    y, c, by = F.col(label), F.col(verdict), by or []
    ok = c != error
    aggs = [F.count("*").alias("n_total"), F.count_if(ok).alias("n_scored"), F.count_if(c == error).alias("n_parse_error"), F.count_if(ok & (c == open_)).alias("n_undetermined")]
    decided = ok & c.isin("positive", "negative")
    aggs += [F.count_if(decided).alias("n_decided"), F.count_if(decided & (y == c)).alias("_right"), F.count_if(ok & (y == c)).alias("_same")]
    aggs += [a for i, v in enumerate(labels) for a in (F.count_if(ok & (y == v)).alias(f"_y{i}"), F.count_if(ok & (c == v)).alias(f"_c{i}"))]
    g = rows.groupBy(*by).agg(*aggs)
    n = F.nullif(F.col("n_scored"), F.lit(0))
    nan = F.lit(float("nan"))
    pe = sum((F.col(f"_y{i}") * F.col(f"_c{i}") for i in range(len(labels))), F.lit(0)) / (n * n)
    po = F.col("_same") / n
    kept = F.when(pe == 1, nan).otherwise((po - pe) / F.when(pe != 1, 1 - pe))
    share = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), nan), 6)
    return g.select(*by, "n_total", "n_scored", "n_parse_error", share(F.col("n_undetermined"), F.col("n_scored")).alias("undetermined_rate"), "n_decided", share(F.col("_right"), F.col("n_decided")).alias("accuracy_among_decided"), F.round(F.coalesce(kept, nan), 6).alias("kappa"))


def confusion(rows: DataFrame, positive: Column, label: str) -> DataFrame:
    y = F.col(label) == 1
    c = rows.agg(*[F.count_if(x).alias(k) for k, x in (("tp", positive & y), ("fp", positive & ~y), ("fn", ~positive & y), ("tn", ~positive & ~y))])
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p, r = div(F.col("tp"), F.col("tp") + F.col("fp")), div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("tp", "fp", "fn", "tn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(div(2 * p * r, p + r), 6).alias("f1"))

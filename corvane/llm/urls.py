"""URL filters: rules by host and path, then logistic regression on hashed character n-grams.

Only DataFrame expressions: no Python, pandas, Arrow or RDD code touches a row. The model is fitted in one aggregate expression
over the labelled table, which is small and so one row of arrays; its weights go to the pages as a broadcast of that one row.
N-grams are hashed by MD5, so other engines can repeat the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIM, GRAMS, STEPS, RATE, DECAY, KEEP = 4096, (3, 4), 32, 20.0, 1e-4, 0.9

#: The rules of the query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Words of hosts and paths that the labelled table is made from: of sites to be blocked, and of others (some mean nothing, as names do).
BLOCKED = (
    "casino poker bets betting jackpot slots roulette pills viagra cheap adult xxx porn sex sexy cams escort nude warez crack keygen torrent spam ads "
    "adserver track tracker popup banner malware phish phishing payday bonus replica lottery win winner prize clickbait backlinks scam hoax giveaway free"
).split()
ALLOWED = (
    "library museum university school news journal science research weather travel recipes garden music history maps physics books forum docs wiki "
    "encyclopedia city sports film theatre college archive data code kitchen nature ocean planet river market hospital station airport hotel law health "
    "nation others author father listing meeting letter weather brother station thinking winter garden reading"
).split()
#: Syllables of made-up names, which most hosts have: these are allowed too.
SYLLABLES = "ta the ren sho lin ing ver mon dan ther sil or ha ble nor ti es nd".split()


def labelled_rows() -> list[tuple[str, int]]:
    """The small labelled URL table (url, 1 to block): each word in four urls that are made alike for both labels."""
    out, n = [], len(SYLLABLES)
    names = ["".join(SYLLABLES[x % n] for x in (k, 5 * k + 2, k * k + k // n)) for k in range(4 * n)]
    for words, y in ((BLOCKED, 1), (ALLOWED + names, 0)):
        for k, w in enumerate(words):
            other, lang, n = words[(7 * k + 3) % len(words)], ("en", "de", "fr", "es")[k % 4], 37 * k % 1000
            out += [(f"https://{w}.example.org/{lang}/{n}", y), (f"http://www.{w}-{other}.example.com/{lang}/{n}.html", y), (f"https://m.{w}.example.net/{lang}/{n}/", y), (f"https://blog.{other}{w}.example.com/{w}/{n}", y)]
    return out


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #; A-Z lower-cased. Empty if url is null or has no ://."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to the next ? or #."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def grams(host: Column, path: Column) -> Column:
    """Places in the weights of the distinct hashed n-grams of host and path, each marked with which of them it is from; in rising order."""

    def cut(kind: str, n: int):
        def run(letters: Column) -> Column:
            starts = F.when(F.size(letters) >= n, F.sequence(F.lit(0), F.size(letters) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.concat(F.lit(kind), *[F.get(letters, i + k) for k in range(n)]))

        return run

    def cuts(kind: str, text: Column) -> Column:
        letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")  # cut once: a substring would count letters from the start for each n-gram
        return bound(letters, lambda x: F.flatten(F.array(*[cut(kind, n)(x) for n in GRAMS])))

    distinct = F.array_distinct(F.concat(cuts("h", host), cuts("p", path)))
    return F.array_sort(F.array_distinct(F.transform(distinct, lambda g: F.pmod(F.conv(F.substring(F.md5(g.cast("binary")), 1, 4), 16, 10).cast("int"), F.lit(DIM)))))


def total(found: Column, weights: Column) -> Column:
    """Sum of the weights of grams."""
    return F.aggregate(found, F.lit(0.0), lambda acc, i: acc + F.get(weights, i))


def margin(found: Column, weights: Column) -> Column:
    """Sum of weights over the grams, by their root number, plus the last weight."""
    return total(found, weights) / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double")) + F.get(weights, F.lit(DIM))


def bound(x: Column, use) -> Column:
    """use(x), with x evaluated once."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def fit(labelled: DataFrame) -> DataFrame:
    """One row with weights, an array of DIM + 1, from labelled urls (url, label 0 or 1; a small table). Rows with other labels are left out; no row gives zeros.

    STEPS steps of gradient descent with momentum, as one aggregate over the step numbers.
    """
    rows = labelled.where("label in (0, 1)").select("url", F.col("label").cast("double").alias("y"), grams(host_of(F.col("url")), path_of(F.col("url"))).alias("g"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("url", "y", "g"))).alias("rows"))
    held = one.select(F.posexplode("rows").alias("row", "r")).select("row", F.explode("r.g").alias("i")).groupBy("i").agg(F.sort_array(F.collect_list("row")).alias("of"))
    axis = labelled.sparkSession.range(0, DIM, 1, 1).select(F.col("id").cast("int").alias("i")).join(held, "i", "left")
    holders = axis.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("of", F.array().cast("array<int>")).alias("of")))), lambda x: x["of"]).alias("holders"))
    n = F.greatest(F.size("rows"), F.lit(1)).cast("double")

    def step(acc: Column, _: Column) -> Column:
        w, v = acc["w"], acc["v"]
        miss = F.transform("rows", lambda r: 1.0 / (1 + F.exp(-margin(r["g"], w))) - r["y"])

        def slopes(m: Column) -> Column:
            part = F.zip_with(m, F.col("rows"), lambda x, r: x / F.sqrt(F.greatest(F.size(r["g"]), F.lit(1)).cast("double")))
            each = bound(part, lambda p: F.transform("holders", lambda of: F.aggregate(of, F.lit(0.0), lambda s, r: s + F.get(p, r))))
            return F.concat(each, F.array(F.aggregate(m, F.lit(0.0), lambda s, x: s + x)))

        speed = F.zip_with(F.zip_with(bound(miss, slopes), w, lambda s, x: s / n + DECAY * x), v, lambda s, x: KEEP * x - RATE * s)
        return bound(speed, lambda s: F.struct(F.zip_with(w, s, lambda x, y: F.round(x + y, 9)).alias("w"), s.alias("v")))

    zeros = F.array_repeat(F.lit(0.0), DIM + 1)
    return one.crossJoin(holders).select(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(zeros.alias("w"), zeros.alias("v")), step)["w"].alias("weights"))  # one row with one row


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does. rules is a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{u}', {y})" for u, y in labelled_rows())
    return spark.sql(f"select * from values {rows} as t(url, label)")


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """pages has page_id and url. Returns per row: page_id, host, path, rule, verdict, score (probability of a block).

    A null or malformed url has empty host and path, fits no rule and is judged by the model's intercept and its few grams.
    Rows, also repeated ones, are judged one by one; other columns are left out.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).crossJoin(F.broadcast(fit(labelled)))  # one row
    score = F.lit(1.0) / (1 + F.exp(-margin(grams(F.col("host"), F.col("path")), F.col("weights"))))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), F.round(score, 6).alias("score"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")

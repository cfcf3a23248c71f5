"""Reports about logs, verdicts and populations: each is one or two aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_runs(a: DataFrame, b: DataFrame, key: str, verdict: str, order: list[str]) -> DataFrame:
    """The latest verdict of each key in two logs, side by side; keys of one log only are left out."""

    def last(log: DataFrame, name: str) -> DataFrame:
        return log.groupBy(key).agg(F.max_by(verdict, F.struct(*order)).alias(name))

    x, y = f"{verdict}_a", f"{verdict}_b"
    return last(a, x).join(last(b, y), key).withColumn("agree", F.col(x) == F.col(y))


def tier_buckets(rows: DataFrame, first: str, second: str, third: str) -> DataFrame:
    """Which of three verdicts agree: counts of five buckets, empty ones as 0."""
    a, b, c = F.col(first), F.col(second), F.col(third)
    bucket = F.when(a.isNull() | b.isNull() | c.isNull(), "undecided").when((a == b) & (b == c), "all_agree").when(a == b, "first_two").when(b == c, "last_two").otherwise("outer_two")
    names = ["all_agree", "first_two", "last_two", "outer_two", "undecided"]
    one = rows.select(bucket.alias("bucket")).agg(*[F.count_if(F.col("bucket") == n).alias(n) for n in names])
    return one.unpivot([], names, "bucket", "n")


def coverage(rows: DataFrame, year: str, kept: Column, years: range) -> DataFrame:
    """Kept and all rows of every year of the axis, and the share in per cent; null where a year has no row."""
    counts = rows.groupBy(year).agg(F.count_if(kept).alias("kept"), F.count("*").alias("pool"))
    axis = rows.sparkSession.range(years.start, years.stop, 1, 1).select(F.col("id").cast("int").alias(year))
    n = F.coalesce("pool", F.lit(0))
    return axis.join(counts, year, "left").select(year, F.coalesce("kept", F.lit(0)).alias("kept"), n.alias("pool"), F.when(n > 0, F.round(100.0 * F.col("kept") / n, 4)).alias("coverage_pct"))


def duplicates(rows: DataFrame, key: str, verdict: str) -> DataFrame:
    """Rows, distinct ids, rows beyond the first of an id, and whether repeats say the same."""
    g = rows.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(verdict).alias("k"))
    return g.agg(F.sum("n").alias("rows"), F.count("*").alias("ids"), (F.sum("n") - F.count("*")).alias("excess"), F.count_if((F.col("n") > 1) & (F.col("k") == 1)).alias("repeated_same"), F.count_if(F.col("k") > 1).alias("repeated_other"), F.max("n").alias("most"))


def seed_share(rows: DataFrame, term: str, seed: list[str]) -> DataFrame:
    """Distinct terms and uses inside and outside a seed vocabulary."""
    kind = F.when(F.col(term).isin(*seed), "canonical").otherwise("novel")
    return rows.groupBy(kind.alias("kind")).agg(F.countDistinct(term).alias("terms"), F.count("*").alias("uses"))


def by_prefix(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Entries of a list column by what stands before their colon: how many, and of how many ids."""
    each = rows.select(key, F.explode(column).alias("entry"))
    return each.groupBy(F.substring_index("entry", ":", 1).alias("field")).agg(F.count("*").alias("n"), F.countDistinct(key).alias("ids"))


def spend(rows: DataFrame, actual: str, estimated: str, cap: float) -> DataFrame:
    """Money spent, the estimate standing in for a missing bill, and whether it is over the cap."""
    total = F.round(F.coalesce(F.sum(F.coalesce(actual, estimated, F.lit(0.0))), F.lit(0.0)), 4)
    return rows.agg(total.alias("spent")).withColumn("over_cap", F.col("spent") > cap)


def evidence(rows: DataFrame, key: str, text: str, rules: dict[str, str], enough: int, examples: int = 5) -> DataFrame:
    """For each named pattern the rows whose text matches it, whether they are enough, and the smallest ids. One pass; partial aggregates keep examples ids each."""
    hit = {n: F.coalesce(F.col(text).rlike(rx), F.lit(False)) for n, rx in rules.items()}
    hits = rows.select(key, F.explode(F.array_compact(F.array(*[F.when(h, n) for n, h in hit.items()]))).alias("name"))
    from pyspark.sql import Window

    first = hits.withColumn("_r", F.row_number().over(Window.partitionBy("name").orderBy(key))).where(F.col("_r") <= examples).groupBy("name").agg(F.array_sort(F.collect_list(key)).alias("examples"))
    names = rows.sparkSession.createDataFrame([(n,) for n in rules], "name string")
    n = F.coalesce("n", F.lit(0))
    out = names.join(hits.groupBy("name").agg(F.count("*").alias("n")), "name", "left").join(first, "name", "left")
    return out.select("name", n.alias("n"), (n >= enough).alias("enough"), F.coalesce("examples", F.array().cast(first.schema["examples"].dataType)).alias("examples"))


def tag_counts(rows: DataFrame, group: str, tags: str) -> DataFrame:
    """How many rows have no, one, two or more tags; null is none."""
    k = F.greatest(F.coalesce(F.size(tags), F.lit(0)), F.lit(0))
    return rows.groupBy(group).agg(*[F.count_if(k == i).alias(f"n{i}") for i in range(3)], F.count_if(k >= 3).alias("n3_up"))


def sweep(rows: DataFrame, thresholds: dict[str, tuple[str, list]]) -> DataFrame:
    """Rows left at each combination of thresholds (name -> column and its thresholds), in one pass."""
    from functools import reduce
    from itertools import product

    names = list(thresholds)
    grid = list(product(*[thresholds[n][1] for n in names]))
    test = lambda cut: reduce(Column.__and__, [F.col(thresholds[n][0]) >= c for n, c in zip(names, cut, strict=True)])
    one = rows.agg(*[F.count_if(test(cut)).alias(f"c{i}") for i, cut in enumerate(grid)])
    kind = lambda c: F.lit(c).cast("double" if isinstance(c, float) else "long")
    return one.select(F.inline(F.array(*[F.struct(*[kind(c).alias(n) for n, c in zip(names, cut, strict=True)], F.col(f"c{i}").alias("remaining")) for i, cut in enumerate(grid)])))


def list_agreement(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Of two list columns as sets: rows, equal ones, those both empty, and the mean Jaccard (1 for two empty ones)."""
    union = F.size(F.array_union(a, b))
    x = F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))
    return rows.agg(F.count("*").alias("n"), F.count_if(F.sort_array(F.array_distinct(a)) == F.sort_array(F.array_distinct(b))).alias("exact"), F.count_if(union == 0).alias("both_empty"), F.round(F.avg(x), 6).alias("mean_jaccard"))


def projection(rows: DataFrame, tokens: str, target: int, price: float) -> DataFrame:
    """Mean tokens of a calibration run, and what target records will cost at a price for each token."""
    mean = F.avg(tokens)
    return rows.agg(F.count("*").alias("n"), F.round(mean, 4).alias("mean_tokens"), F.round(mean * target * price, 4).alias("projected"))

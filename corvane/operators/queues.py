"""Work queues: what is left to review, in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def disagreements(rows: DataFrame, seen: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Rows with two different verdicts whose key isn't among the seen ones; a null verdict agrees with anything."""
    return rows.where(F.col(a) != F.col(b)).join(seen.select(key).distinct(), key, "left_anti")


def review(rows: DataFrame, decided: DataFrame, key: str, wanted: Column, order: list[Column], limit: int) -> DataFrame:
    """The first rows, in the order given, that are wanted and not yet decided."""
    return rows.where(wanted).join(decided.select(key).distinct(), key, "left_anti").orderBy(*order).limit(limit)


def placed(rows: DataFrame, column: str, order: list[str], name: str) -> DataFrame:
    """Adds the place of a value in a custom order, from 1; values that it lacks come after all others."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return rows.withColumn(name, F.when(at > 0, at).otherwise(len(order) + 1).cast("int"))


def done_and_next(rows: DataFrame, done: DataFrame, key: str, limit: int) -> DataFrame:
    """All rows that are done, and the first of the others by key."""
    marked = rows.join(done.select(key).distinct().withColumn("done", F.lit(True)), key, "left").withColumn("done", F.coalesce("done", F.lit(False)))
    following = marked.where("not done").orderBy(key).limit(limit)
    return marked.where("done").unionByName(following)


def numbered(rows: DataFrame, column: str, prefix: str, order: list[str]) -> DataFrame:
    """Fills missing ids of a small table with the prefix and the row's place among those without one."""
    place = F.row_number().over(Window.partitionBy(F.col(column).isNull()).orderBy(*order))
    return rows.withColumn(column, F.coalesce(F.col(column), F.concat(F.lit(prefix), place)))


def lexicon(first: DataFrame, second: DataFrame, seed: DataFrame) -> DataFrame:
    """Candidate terms of two extractions and a seed vocabulary, each with the '+'-joined names of those that have it."""
    from functools import reduce

    parts = [d.select("term").where("term is not null").distinct().withColumn("_n", F.lit(i)) for i, d in enumerate((first, second, seed))]
    g = reduce(DataFrame.union, parts).groupBy("term").agg(F.collect_set("_n").alias("_s"))
    names = ("tfidf", "phrases", "seed")
    return g.select("term", F.concat_ws("+", *[F.when(F.array_contains("_s", i), n) for i, n in enumerate(names)]).alias("source"))


def seeded(terms: DataFrame, seeds: DataFrame, term: str) -> DataFrame:
    """terms and those seed terms, lower-cased and trimmed, that it lacks."""
    new = seeds.select(F.lower(F.trim(term)).alias(term)).where(F.col(term) != "").distinct().join(terms.select(term), term, "left_anti")
    return terms.unionByName(new.withColumn("source", F.lit("seed")).select(*terms.columns))

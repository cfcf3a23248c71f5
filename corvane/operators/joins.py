"""Joins by several identifiers."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a table of terms that are matched as substrings, at most.
MOST_TERMS = 20_000


def flat_lookup(build: DataFrame, keys: list[str], payload: list[str], order: str) -> DataFrame:
    """One namespace of values from several key columns; of a repeated value the first key column and row wins."""
    pairs = [build.select(F.col(k).cast("string").alias("value"), F.lit(i).alias("turn"), F.col(order).alias("at"), F.struct(*payload).alias("p")) for i, k in enumerate(keys)]
    rows = reduce(DataFrame.union, pairs).where("value is not null")
    return rows.groupBy("value").agg(F.min_by("p", F.struct("turn", "at")).alias("p"))


def fallback_join(probe: DataFrame, lookup: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """The payload of the first key that hits. Equi-joins only; each can be broadcast or split by AQE."""
    out, hits = probe, []
    for i, k in enumerate(keys):
        side = lookup.select(F.col("value").alias(f"_k{i}"), F.col("p").alias(f"_p{i}"))
        out = out.join(side, F.col(k).cast("string") == F.col(f"_k{i}"), "left")
        hits.append(F.col(f"_p{i}"))
    hit = F.coalesce(*hits)
    which = F.coalesce(*[F.when(h.isNotNull(), F.lit(k)) for h, k in zip(hits, keys, strict=True)])
    return out.select(*probe.columns, *[hit[c].alias(c) for c in payload], which.alias("matched_by"))


def typed_lookup(build: DataFrame, keys: list[str], payload: list[str], order: str) -> DataFrame:
    pairs = [build.select(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value"), F.col(order).alias("at"), F.struct(*payload).alias("p")) for k in keys]
    rows = reduce(DataFrame.union, pairs).where("value is not null")
    return rows.groupBy("kind", "value").agg(F.min_by("p", "at").alias("p"))


def any_key_anti(rows: DataFrame, known: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows none of whose keys is known: chained anti joins, as an OR would be planned as a nested loop."""
    for k in keys:
        rows = rows.join(known.select(F.col(value).alias(k)).distinct(), k, "left_anti")
    return rows


def any_key_semi(rows: DataFrame, known: DataFrame, row_id: str, keys: list[str], value: str) -> DataFrame:
    found = rows.select(row_id, F.explode(F.array(*keys)).alias(value)).join(known.select(value).distinct(), value, "left_semi").select(row_id).distinct()
    return rows.join(found, row_id, "left_semi")


def fill_blank(rows: DataFrame, patch: DataFrame, key: str, columns: list[str], blank) -> DataFrame:
    """Blank cells are filled from the patch, others stay."""
    side = one_row_each(patch.select(key, *columns), key).select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(side, key, "left")
    return out.select(*[F.when(blank(F.col(c)), F.coalesce(f"_{c}", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def presence(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer union of keys with a '+'-joined list of the sides that have each."""
    rows = reduce(DataFrame.union, [d.select(key, F.lit(n).alias("side")).distinct() for n, d in sides.items()])
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("side")), "+").alias("source"))


def diff(old: DataFrame, new: DataFrame, key: list[str], column: str) -> DataFrame:
    """Rows of two builds side by side with what became of each."""
    a, b = old.select(*key, F.col(column).alias("old_value")), new.select(*key, F.col(column).alias("new_value"))
    j = a.join(b, key, "full_outer")
    state: Column = F.when(F.col("old_value").isNull(), "added").when(F.col("new_value").isNull(), "removed").when(F.col("old_value") == F.col("new_value"), "same").otherwise("changed")
    return j.withColumn("state", state)


def containing(rows: DataFrame, text: str, terms: DataFrame, term: str, key: str) -> DataFrame:
    """(key, term) for the terms of a table that are substrings of a text. The table is sent to all executors if it has at most MOST_TERMS rows, else ValueError: a larger one needs an index."""
    listed = [r[0] for r in terms.select(F.lower(F.trim(term))).where(F.trim(term) != "").distinct().orderBy(F.lower(F.trim(term))).limit(MOST_TERMS + 1).collect()]
    if len(listed) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    low = F.lower(text)
    hits = F.filter(F.from_json(F.lit(json.dumps(listed)), "array<string>"), lambda t: low.contains(t))
    return rows.select(key, F.explode(hits).alias(term))


def one_row_each(patch: DataFrame, key: str) -> DataFrame:
    """patch with one row for each key, so that it can't multiply what it is joined to."""
    rest = [c for c in patch.columns if c != key]
    return patch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*")


def known_holder(new: DataFrame, known: DataFrame, value: str, known_value: str, holder: str) -> DataFrame:
    """Each new row with the smallest existing holder of its value, upper and lower case alike, and whether there is none."""
    held = known.groupBy(F.lower(known_value).alias("_value")).agg(F.min(holder).alias("holder"))
    return new.join(held, F.lower(new[value]) == F.col("_value"), "left").drop("_value").withColumn("is_new", F.col("holder").isNull())

"""Filling, completing and extending tables from others, where a record is found by the first of several identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.ids import blank

LISTS = ("mesh_headings", "pub_types", "keywords_author")


def one_of_each(patch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each key that isn't null, the first by order, so that a repeated key can't multiply what it is joined to."""
    rest = [c for c in patch.columns if c != key]
    at = F.col(order) if order else F.struct(*rest)
    return patch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), at).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in rest])


def by_column(rows: DataFrame, lookup: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Each column by itself from the first key whose hit has a value, unlike a cascade that takes all of the first hit. lookup: value and columns."""
    out = rows
    one = one_of_each(lookup.select("value", *columns), "value")
    for i, k in enumerate(keys):
        side = one.select(F.col("value").alias(f"_v{i}"), *[F.col(c).alias(f"_{c}{i}") for c in columns])
        out = out.join(side, F.col(k) == F.col(f"_v{i}"), "left")
    return out.select(*rows.columns, *[F.coalesce(*[F.col(f"_{c}{i}") for i in range(len(keys))]).alias(f"existing_{c}") for c in columns])


def licences(rows: DataFrame, fetched: DataFrame, legacy: DataFrame) -> DataFrame:
    """rows (pmid, pmcid, doi) with license, epmc_is_open_access and license_checked: by typed key from fetched (kind, value, license, flag), else by pmid from legacy.

    A hit is a hit even if its licence is '': looked up, none disclosed. Without one license is null: never looked up.
    """
    if "license_checked" in rows.columns:
        raise ValueError("licences are joined already")
    out, hits = rows, []
    for i, (kind, value) in enumerate((("pmid", F.trim("pmid")), ("doi", F.lower(F.trim("doi"))), ("pmcid", F.trim("pmcid")))):
        side = one_of_each(fetched.where(F.col("kind") == kind).select("value", "license", "flag"), "value").select(F.col("value").alias(f"_v{i}"), F.struct("license", "flag").alias(f"_h{i}"))
        out = out.join(side, F.nullif(value, F.lit("")) == F.col(f"_v{i}"), "left")
        hits.append(F.col(f"_h{i}"))
    old = one_of_each(legacy.select(F.col("pmid").alias("_v3"), "license", "flag"), "_v3").select("_v3", F.struct("license", "flag").alias("_h3"))
    out = out.join(old, F.col("pmid") == F.col("_v3"), "left")
    hit = F.coalesce(*hits, F.col("_h3"))
    return out.select(*rows.columns, F.when(hit.isNotNull(), F.coalesce(hit["license"], F.lit(""))).alias("license"), hit["flag"].alias("epmc_is_open_access"), hit.isNotNull().alias("license_checked"))


def complete_ids(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Blank identifiers filled from the set found for the first identifier that a row has; none is replaced. found: query_id and keys."""
    one = one_of_each(found.select("query_id", *keys), "query_id")
    out, hits = rows, []
    for i, k in enumerate(keys):
        side = one.select(F.col("query_id").alias(f"_q{i}"), F.struct(*keys).alias(f"_h{i}"))
        out = out.join(side, F.trim(k) == F.col(f"_q{i}"), "left")
        hits.append(F.col(f"_h{i}"))
    hit = F.coalesce(*hits)
    return out.select(*[F.when(blank(F.col(c)), F.coalesce(hit[c], F.col(c))).otherwise(F.col(c)).alias(c) if c in keys else F.col(c) for c in rows.columns])


def fill(rows: DataFrame, patch: DataFrame, key: Column, columns: list[str], empties: tuple[str, ...] = (), only: Column | None = None) -> DataFrame:
    """Blank cells (also those of empties that are '[]') filled from patch (value and columns) by a key; only says in which rows."""
    one = one_of_each(patch.select("value", *columns), "value").select(F.col("value").alias("_patch key"), *[F.col(c).alias(f"_patch {c}") for c in columns])
    out = rows.join(one, key == F.col("`_patch key`"), "left")
    lacks = lambda c: blank(F.col(c)) | (F.trim(F.col(c)) == "[]") if c in empties else blank(F.col(c))
    may = F.coalesce(only, F.lit(False)) if only is not None else F.lit(True)
    return out.select(*[F.when(may & lacks(c), F.coalesce(f"`_patch {c}`", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def fill_cascade(rows: DataFrame, row_id: str, patch: DataFrame, keys: list[str], columns: list[str], empties: tuple[str, ...] = ()) -> DataFrame:
    """Each row is filled from the first of its identifiers that patch (value and columns) knows, and from that alone."""
    one = one_of_each(patch.select("value", *columns), "value")
    out, hits = rows, []
    for i, k in enumerate(keys):
        side = one.select(F.col("value").alias(f"_v{i}"), F.struct(*columns).alias(f"_h{i}"))
        out = out.join(side, F.trim(k) == F.col(f"_v{i}"), "left")
        hits.append(F.col(f"_h{i}"))
    hit = F.coalesce(*hits)
    lacks = lambda c: blank(F.col(c)) | (F.trim(F.col(c)) == "[]") if c in empties else blank(F.col(c))
    return out.select(*[F.when(lacks(c), F.coalesce(hit[c], F.col(c))).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def unknown_only(new: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """New rows none of whose identifiers a known row has in the same column; a null is in nobody's column."""
    for k in keys:
        new = new.join(known.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_anti").select(*new.columns)
    return new


def appended(known: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """known and one row of each new record (by its first identifier, the earliest row) that known lacks."""
    fresh = unknown_only(new, known, keys).withColumn("_id", F.coalesce(*[F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in keys]))
    rest = [c for c in new.columns]
    named = fresh.where("_id is not null").groupBy("_id").agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*[F.col("_r")[c].alias(c) for c in rest])
    return known.unionByName(named, allowMissingColumns=True).unionByName(fresh.where("_id is null").drop("_id"), allowMissingColumns=True)


def repaired(pool: DataFrame, steps: list[tuple[str, DataFrame, str, list[str]]]) -> tuple[DataFrame, DataFrame]:
    """Repair passes (name, patch with value and columns, key, columns) one after another, and per pass how many cells of each column it filled."""
    counts = []
    for name, patch, key, columns in steps:
        after = fill(pool, patch, F.trim(key), columns)
        counts.append(after.agg(*[F.count_if(~blank(F.col(c))).alias(c) for c in columns]).select(F.lit(name).alias("step"), F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "filled")))
        pool = after
    return pool, reduce(DataFrame.unionByName, counts)

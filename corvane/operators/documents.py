"""Nested documents, link blocks, guarded updates and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves of a schema."""
    out = []
    for f in schema.fields:
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        out += leaf_paths(kind, f"{prefix}{f.name}.") if isinstance(kind, T.StructType) else [prefix + f.name]
    return out


def open_access(own: Column, checked: Column, fetched: Column) -> Column:
    """A checked licence record overrides the row's own flag, unless it has none."""
    return F.when(checked & fetched.isNotNull(), fetched).otherwise(own)


def licence(value: Column, checked: Column) -> Column:
    """Null: never looked up; '': looked up, none disclosed."""
    return F.when(checked, F.coalesce(value, F.lit("")))


class Refused(ValueError):
    """An update that isn't allowed."""


def check_update(updates: DataFrame, key: str, allowed: set[str]) -> None:
    if bad := [c for c in updates.columns if c != key and c not in allowed]:
        raise Refused(f"columns that may not be set: {bad}")


def apply_update(target: DataFrame, updates: DataFrame, key: str, allowed: set[str]) -> DataFrame:
    """target with the updates' values and a flag changed, null-safe. Keys that target lacks change nothing; of a key that updates repeats the smallest row counts."""
    check_update(updates, key, allowed)
    columns = [c for c in updates.columns if c != key]
    updates = updates.groupBy(key).agg(F.min(F.struct(*columns)).alias("_r")).select(key, "_r.*")  # a repeated key sets once
    j = target.join(updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns]), key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return j.select(*[F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns], (hit & changed).alias("changed"))


def snapshot(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """What an update overwrites; applied as an update itself it rolls back."""
    return target.join(updates.select(key), key, "left_semi").select(key, *[c for c in updates.columns if c != key])


def upsert(target: DataFrame, rows: DataFrame, key: str, replace: bool = False) -> DataFrame:
    """Whole rows by key: new ones are added; differing ones replace their old form only if allowed. Column action says which."""
    body = lambda d, n: d.select(key, F.struct(*d.columns).alias(n))
    j = body(target, "old").join(body(rows.select(*target.columns), "new"), key, "full_outer")
    action = F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "inserted").when(F.col("old") == F.col("new"), "identical").otherwise("replaced" if replace else "refused")
    pick = F.when(action.isin("inserted", "replaced"), F.col("new")).otherwise(F.col("old"))
    return j.select(pick.alias("r"), action.alias("action")).select(*[F.col("r")[c].alias(c) for c in target.columns], "action")


def invariants(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Violations of each rule, all in one pass."""
    one = rows.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return one.select("rows", F.explode(F.create_map(*[x for n in checks for x in (F.lit(n), F.col(n))])).alias("rule", "violations"))

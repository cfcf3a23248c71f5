"""Loads into nested documents: row mappers, guarded updates with dry run and rollback, the load protocol, ledgers and releases.

An update is a row of a key and of structs (value, present): absent is not null. Tables are rewritten, never changed in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.ids import blank
from corvane.functions.text import truth
from corvane.operators.cascades import one_of_each
from corvane.operators.documents import Refused, leaf_paths

CLEAN = r"^[\x21-\x7e]+$"


def text_of(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def given(value: Column, present: Column | bool = True) -> Column:
    here = F.lit(present) if isinstance(present, bool) else F.coalesce(present, F.lit(False))
    return F.struct(F.when(here, value).alias("value"), here.alias("present"))


def some(c: str) -> Column:
    return F.nullif(text_of(c), F.lit(""))


def strict_list(c: str) -> Column:
    """A list from its JSON; blank is empty, malformed fails the job."""
    raw = some(c)
    listed = F.from_json(raw, "array<string>")
    return F.when(raw.isNull(), F.array().cast("array<string>")).when(listed.isNull(), F.raise_error(F.concat(F.lit(f"not a JSON list in {c}: "), raw)).cast("array<string>")).otherwise(listed)


def strict_object(c: str, schema: str) -> Column:
    """A struct from its JSON object; blank is null, what isn't an object fails the job."""
    raw = some(c)
    return F.when(raw.isNotNull() & F.json_object_keys(raw).isNull(), F.raise_error(F.concat(F.lit(f"not a JSON object in {c}: "), raw)).cast(schema)).otherwise(F.from_json(raw, schema))


def citations(rows: DataFrame) -> DataFrame:
    """pid and updates of citation counts; a blank count is no update at all."""
    n = F.floor(some("citation_count").cast("double")).cast("long")
    return rows.where((text_of("pid") != "") & some("citation_count").isNotNull()).select(text_of("pid").alias("pid"), given(n).alias("citation_count"), given(some("citation_count_updated")).alias("citation_count_updated"), given(some("citation_source")).alias("citation_source"))


def licences(rows: DataFrame) -> DataFrame:
    """'' is written as a licence (looked up, none disclosed); a blank flag leaves open_access alone. Refused without a licence column."""
    if "license" not in rows.columns:
        raise Refused("no license column")
    flag = truth(text_of("epmc_is_open_access"))
    return rows.where(text_of("pid") != "").select(text_of("pid").alias("pid"), given(text_of("license")).alias("license"), given(flag, flag.isNotNull()).alias("open_access"))


def preprints(rows: DataFrame) -> DataFrame:
    """Source and id together or not at all; a server only where one is named."""
    ok = (text_of("pid") != "") & some("epmc_id").isNotNull() & some("epmc_source").isNotNull()
    return rows.where(ok).select(text_of("pid").alias("pid"), given(text_of("epmc_id")).alias("epmc_id"), given(text_of("epmc_source")).alias("epmc_source"), given(some("preprint_server"), some("preprint_server").isNotNull()).alias("preprint_server"))


def data_links(rows: DataFrame) -> DataFrame:
    """has_data where it says Y or N, and the lists that the row carries ('[]' is an answer). A malformed list fails the job."""
    flag = truth(text_of("has_data"))
    made = [given(flag, flag.isNotNull()).alias("has_data")] + [given(strict_list(c), some(c).isNotNull()).alias(to) for c, to in (("data_links_tags", "tags"), ("accession_types", "accession_types"))]
    out = rows.where(text_of("pid") != "").select(text_of("pid").alias("pid"), *made)
    return out.where(F.col("has_data.present") | F.col("tags.present") | F.col("accession_types.present"))


def identifiers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Reserved identifiers that the row carries; '' is written. A value with white space or beyond ASCII fails the job."""
    checked = lambda c: F.when((text_of(c) != "") & ~text_of(c).rlike(CLEAN), F.raise_error(F.concat(F.lit("not a clean identifier: "), text_of(c))).cast("string")).otherwise(text_of(c))
    held = [c for c in columns if c in rows.columns]
    out = rows.where(text_of("pid") != "").select(text_of("pid").alias("pid"), *[given(checked(c), F.col(c).isNotNull()).alias(c) for c in held])
    return out.where(reduce(Column.__or__, [F.col(f"{c}.present") for c in held], F.lit(False)))


def fulltext(rows: DataFrame) -> DataFrame:
    """Whether either archive holds the text; a row with neither flag is no update."""
    a, b = text_of("in_epmc"), text_of("in_pmc")
    return rows.where((text_of("pid") != "") & ((a != "") | (b != ""))).select(text_of("pid").alias("pid"), given(F.coalesce(truth(a), F.lit(False)) | F.coalesce(truth(b), F.lit(False))).alias("fulltext_available"))


MAPPERS = {"citations": citations, "licences": licences, "preprints": preprints, "data_links": data_links, "fulltext": fulltext}


def allowed(updates: DataFrame, key: str, columns: set[str]) -> None:
    if bad := [c for c in updates.columns if c != key and c not in columns]:
        raise Refused(f"fields that may not be set: {bad}")


def planned(target: DataFrame, updates: DataFrame, key: str, columns: set[str]) -> DataFrame:
    """Each key's fields that an update would change: key, field, and whether the target has the key. The dry run of apply()."""
    allowed(updates, key, columns)
    fields = [c for c in updates.columns if c != key]
    one = one_of_each(updates, key)
    j = one.join(target.select(key, F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in fields]), key, "left")
    changed = F.array_compact(F.array(*[F.when(F.col(c)["present"] & ~F.col(c)["value"].eqNullSafe(F.col(f"_{c}")), c) for c in fields]))
    return j.select(key, F.coalesce("_there", F.lit(False)).alias("known"), F.when(F.col("_there"), changed).otherwise(F.array().cast("array<string>")).alias("changed"))


def applied(target: DataFrame, updates: DataFrame, key: str, columns: set[str], stamp: Column | None = None, modified: str = "record_modified") -> DataFrame:
    """target with present values set, and modified stamped where anything changed. Keys that target lacks change nothing."""
    allowed(updates, key, columns)
    fields = [c for c in updates.columns if c != key]
    one = one_of_each(updates, key).select(key, *[F.col(c).alias(f"_{c}") for c in fields])
    j = target.join(one, key, "left")
    sets = {c: F.coalesce(F.col(f"_{c}")["present"], F.lit(False)) for c in fields}
    changed = reduce(Column.__or__, [sets[c] & ~F.col(f"_{c}")["value"].eqNullSafe(F.col(c)) for c in fields], F.lit(False))
    out = {c: F.when(sets[c], F.col(f"_{c}")["value"]).otherwise(F.col(c)) for c in fields}
    if stamp is not None:
        out[modified] = F.when(changed, stamp).otherwise(F.col(modified)) if modified in target.columns else F.when(changed, stamp)
    kept = [out.pop(c).alias(c) if c in out else F.col(c) for c in target.columns]
    return j.select(*kept, *[x.alias(c) for c, x in out.items()])


def rollback(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates that undo others: the old value, or null (unset) where there was none, for the fields that they set."""
    fields = [c for c in updates.columns if c != key]
    one = one_of_each(updates, key).select(key, *[F.col(c)["present"].alias(f"_{c}") for c in fields])
    return target.join(one, key).select(key, *[given(F.col(c), F.col(f"_{c}")).alias(c) for c in fields])


def flips(target: DataFrame, updates: DataFrame, key: str, field: str) -> DataFrame:
    """How many rows a load sets, changes, and flips from one value that isn't null to another."""
    one = one_of_each(updates, key).select(key, F.col(field).alias("_u"))
    j = target.join(one, key).where("_u.present")
    new, old = F.col("_u")["value"], F.col(field)
    return j.agg(F.count("*").alias("rows"), F.count_if(~new.eqNullSafe(old)).alias("changed"), F.count_if(F.coalesce(old.isNotNull() & (new != old), F.lit(False))).alias("flipped"))


def coverage(before: DataFrame, after: DataFrame, leaves: list[str]) -> DataFrame:
    """How many rows have each leaf before and after a load."""
    count = lambda d, n: d.agg(*[F.count_if(F.col(c).isNotNull()).alias(c.replace(".", "_")) for c in leaves]).select(F.explode(F.create_map(*[x for c in leaves for x in (F.lit(c), F.col(c.replace(".", "_")))])).alias("leaf", n))
    return count(before, "before").join(count(after, "after"), "leaf")


def superseded(current: DataFrame, events: DataFrame, key: str, fields: list[str], pins: list[str]) -> DataFrame:
    """current with events' fields; where a pin (prompt, batch) differs the old fields go to the end of history, an array of structs."""
    new = one_of_each(events, key).select(key, *[F.col(c).alias(f"_{c}") for c in [*fields, *pins]], F.lit(True).alias("_hit"))
    j = current.join(new, key, "left")
    had = reduce(Column.__or__, [F.col(p).isNotNull() for p in pins])
    differs = reduce(Column.__or__, [~F.col(p).eqNullSafe(F.col(f"_{p}")) for p in pins])
    old = F.struct(*[F.col(c) for c in [*fields, *pins]])
    history = F.coalesce(F.col("history"), F.array()) if "history" in current.columns else F.array()
    past = F.when(F.col("_hit") & had & differs, F.concat(history, F.array(old))).otherwise(history) if "history" in current.columns else F.when(F.col("_hit") & had & differs, F.array(old)).otherwise(F.slice(F.array(old), 1, 0))
    keep = [c for c in current.columns if c not in (*fields, *pins, "history")]
    return j.select(*keep, *[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in [*fields, *pins]], past.alias("history"))


def load_plan(target: DataFrame, rows: DataFrame, key: str, malformed: Column, replace: bool = False) -> dict[str, int]:
    """The load protocol before anything is written: Refused for repeated or blank keys, malformed rows, and differing documents unless replace.

    Returns how many would be inserted, are identical and would be replaced.
    """
    n, ids, blanks, bad = rows.agg(F.count("*"), F.countDistinct(key), F.count_if(blank(F.col(key).cast("string"))), F.count_if(F.coalesce(malformed, F.lit(False)))).first()
    if blanks or ids < n - blanks:
        raise Refused(f"{blanks} blank and {n - blanks - ids} repeated keys")
    if bad:
        raise Refused(f"{bad} malformed documents")
    j = rows.select(key, F.struct(*target.columns).alias("new")).join(target.select(key, F.struct(*target.columns).alias("old")), key, "left")
    out = j.agg(F.count_if(F.col("old").isNull()).alias("inserted"), F.count_if(F.col("old") == F.col("new")).alias("identical"), F.count_if(F.col("old") != F.col("new")).alias("replaced")).first().asDict()
    if out["replaced"] and not replace:
        raise Refused(f"{out['replaced']} documents differ from those held")
    return out


def loaded(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """target with rows in place of, or beside, its own."""
    return target.join(rows.select(key), key, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def verified(before: DataFrame, after: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """What a load must hold: the count grew by the new keys, every loaded key is there, no key is there twice. One row a check."""
    new = rows.select(key).join(before.select(key), key, "left_anti").count()
    n, m = before.count(), after.count()
    absent = rows.select(key).join(after.select(key), key, "left_anti").count()
    twice = after.groupBy(key).count().where("count > 1").count()
    return after.sparkSession.createDataFrame([("count", m - n - new == 0, m - n), ("absent", absent == 0, absent), ("repeated", twice == 0, twice)], "check string, holds boolean, found long")


def deduplicated(rows: DataFrame, group: str, row_id: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """One document of each group, the smallest id, whose nulls are filled from the others by id; and the documents that go, as a snapshot to restore them from."""
    keep = F.min(row_id).alias(row_id)
    merged = rows.where(F.col(group).isNotNull()).groupBy(group).agg(keep, *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_id))).alias(c) for c in columns])
    rest = rows.where(F.col(group).isNull())
    gone = rows.join(merged.select(row_id), row_id, "left_anti").where(F.col(group).isNotNull())
    return merged.select(*rows.columns).unionByName(rest), gone.select(*rows.columns)


def restored(rows: DataFrame, snapshot: DataFrame, row_id: str) -> DataFrame:
    return rows.join(snapshot.select(row_id), row_id, "left_anti").select(*rows.columns).unionByName(snapshot.select(*rows.columns))


def laid_out(rows: DataFrame, path: str, partition: str, order: list[str]) -> None:
    """Rows as files that take the place of indexes: a folder for each value, sorted, so min and max let scans skip files."""
    rows.repartitionByRange(partition, *order).sortWithinPartitions(partition, *order).write.mode("overwrite").partitionBy(partition).parquet(path)


def schema_differences(authored: T.StructType, published: T.StructType) -> list[tuple[str, str]]:
    """Leaf paths that only one of two schemas has."""
    a, b = set(leaf_paths(authored)), set(leaf_paths(published))
    return sorted([(p, "authored only") for p in a - b] + [(p, "published only") for p in b - a])


def ledger(path: str, spark, step: str, inputs: list[str], outputs: dict[str, int], params: dict[str, str], at: str) -> None:
    """One row of provenance for a step, appended."""
    schema = "step string, inputs array<string>, outputs map<string, long>, params map<string, string>, finished_at string"
    spark.createDataFrame([(step, inputs, outputs, params, at)], schema).coalesce(1).write.mode("append").json(path)


def release(rows: DataFrame, version: str, klass: str, stamps: list[str], schema_version: str, previous: dict | None = None) -> dict:
    """A release's document: counts by class, newest stamps, whether anything changed since the previous one. Refused unless there is one schema version."""
    counts = {r[0]: r[1] for r in rows.groupBy(klass).count().collect()}  # a row for each class
    row = rows.agg(F.count("*").alias("n"), F.collect_set(schema_version).alias("versions"), *[F.max(s).cast("string").alias(s) for s in stamps]).first()
    if len(row.versions) != 1:
        raise Refused(f"schema versions: {sorted(row.versions)}")
    out = {"release": version, "schema_version": row.versions[0], "count": row.n, "classes": dict(sorted(counts.items(), key=str)), "newest": {s: row[s] for s in stamps}}
    out["unchanged"] = bool(previous) and all(previous.get(k) == out[k] for k in ("schema_version", "count", "classes", "newest"))
    return out

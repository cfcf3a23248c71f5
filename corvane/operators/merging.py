"""Choosing, merging and repairing records that describe one thing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_record(rows: DataFrame, key: str, rank: dict[str, int], source: str, citations: str, row_id: str) -> DataFrame:
    """The row of each key with the best source rank (unknown ones last), then most citations, then the smallest id."""
    place = reduce(lambda w, s: w.when(F.col(source) == s, rank[s]), rank, F.when(F.lit(False), 0)).otherwise(len(rank) + 1)
    names = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(place, -F.col(citations), F.col(row_id))).alias("_best"))
    return best.select(key, "_best.*")


def first_of_batches(rows: DataFrame, batches: str, key: str) -> tuple[DataFrame, DataFrame]:
    """rows has a map from batch to entries. Returns each id's first entry, in order of batch and place, and the entries without id."""
    flat = rows.select(F.posexplode(F.array_sort(F.map_entries(batches), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))).alias("_b", "_e"))
    flat = flat.select("_b", F.col("_e.key").alias("batch"), F.posexplode("_e.value").alias("_p", "entry"))
    has = flat["entry"][key].isNotNull() & (F.trim(flat["entry"][key].cast("string")) != "")
    found = flat.where(has).groupBy(F.col("entry")[key].alias("_k")).agg(F.min_by(F.struct("batch", "entry"), F.struct("_b", "_p")).alias("_f"))
    return found.select("_f.batch", "_f.entry.*"), flat.where(~F.coalesce(has, F.lit(False))).select("batch", "entry.*")


def merged_sources(rows: DataFrame, key: str, name: str, matched: str, order: str) -> DataFrame:
    """For each key its sources, the first row of every (name, matched), by name and matched. Partial aggregates keep one row of each."""
    one = rows.groupBy(key, name, matched).agg(F.min(order).alias("first"))
    return one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(name, matched, "first"))).alias("sources"))


def preferred_hosts(links: DataFrame, doc: str, link: str, host: str, precedence: list[str]) -> DataFrame:
    """links whose id has several hosts within a document all go to the host that comes first in precedence."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(h) for h in precedence]), F.col(host)), F.lit(0)), F.lit(len(precedence) + 1))
    w = Window.partitionBy(doc, F.upper(link))
    return links.withColumn(host, F.min(F.struct(place.alias("p"), F.col(host).alias("h"))).over(w)["h"])


def conflicts(rows: DataFrame, cluster: str, label: str) -> DataFrame:
    """The rows of clusters whose labels disagree, for people to decide; labels that are null don't count."""
    bad = rows.groupBy(cluster).agg(F.min(label).alias("_low"), F.max(label).alias("_high")).where("_low <> _high").select(cluster)
    return rows.join(bad, cluster, "left_semi")


def provenance(rows: DataFrame, key: str, passes: dict[str, DataFrame]) -> DataFrame:
    """Which repair passes touched a row, joined by ';' in the order given, and the first of them as primary."""
    for name, touched in passes.items():
        rows = rows.join(touched.select(F.col(key)).distinct().withColumn("_" + name, F.lit(name)), key, "left")
    marks = ["_" + n for n in passes]
    return rows.withColumn("touched", F.concat_ws(";", *marks)).withColumn("primary", F.coalesce(*marks)).drop(*marks)


def duplicate_plan(rows: DataFrame, group: str, row_id: str, columns: list[str]) -> DataFrame:
    """For groups of several rows: keeper (smallest id), losers, kind and the columns in dispute. No group is gathered.

    identical: nothing differs; mergeable: values differ from nulls only; conflicting: a column has two values.
    """
    aggs = [F.count("*").alias("n"), F.min(row_id).alias("keeper")]
    aggs += [a for c in columns for a in (F.min(c).alias(f"_low_{c}"), F.max(c).alias(f"_high_{c}"), F.count(c).alias(f"_n_{c}"))]
    g = rows.groupBy(group).agg(*aggs).where("n > 1")
    differs = F.array_compact(F.array(*[F.when(F.col(f"_low_{c}") != F.col(f"_high_{c}"), c) for c in columns]))
    gaps = reduce(Column.__or__, [(F.col(f"_n_{c}") > 0) & (F.col(f"_n_{c}") < F.col("n")) for c in columns], F.lit(False))
    kind = F.when(F.size(differs) > 0, "conflicting").when(gaps, "mergeable").otherwise("identical")
    return g.select(group, "keeper", (F.col("n") - 1).alias("losers"), kind.alias("kind"), F.array_join(differs, ";").alias("disputed"))


def clean_lexicon(terms: DataFrame, protected: list[str], least: int = 3) -> DataFrame:
    """terms has list, term and ord. Returns each row with an action: keep, or why it goes.

    Of equal terms of a list (case and outer spaces apart) the first stays; then short terms go; then single words that are
    a word of a longer phrase of their list, unless protected. A kept term that both lists have is a tension, kept in both.
    """
    t = terms.withColumn("norm", F.lower(F.trim("term")))
    one = t.groupBy("list", "norm").agg(F.min("ord").alias("first"))
    part = t.where(F.size(F.split("norm", " +")) > 1).select("list", F.explode(F.split("norm", " +")).alias("norm")).distinct().withColumn("_part", F.lit(True))
    both = t.groupBy("norm").agg((F.min("list") != F.max("list")).alias("_both"))
    j = t.join(one, ["list", "norm"], "left").join(part, ["list", "norm"], "left").join(both, "norm", "left")
    action = F.when(F.col("ord") != F.col("first"), "duplicate").when(F.length("norm") < least, "short")
    action = action.when(F.col("_part") & ~F.col("norm").isin(*protected or [""]), "subsumed").when(F.col("_both"), "tension").otherwise("keep")
    return j.select("list", "term", "ord", action.alias("action"))


def migrate(rows: DataFrame, doc: str, field: str, default: Column, version: tuple[str, str], reverse: bool = False) -> DataFrame:
    """Adds a field to a nested document and raises its schema_version, or undoes that. Documents of other versions stay."""
    old, new = version[::-1] if reverse else version
    d = F.col(doc)
    value = F.lit(None) if reverse else default
    moved = d.withField(field, F.when(d["schema_version"] == old, value).otherwise(d[field] if field in rows.schema[doc].dataType.names else F.lit(None)))
    return rows.withColumn(doc, moved.withField("schema_version", F.when(d["schema_version"] == old, F.lit(new)).otherwise(d["schema_version"])))

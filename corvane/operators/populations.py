"""Populations of records by rule: who is trusted, in scope, wanted, fit to be sent, and how they are sampled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.ids import blank
from corvane.operators.sampling import capped_sample, cohort_cap

# Confidence of labels that are trusted, and one that may be added.
TRUSTED, CANDIDATE, REGISTRY = ("human_curated", "registry_confirmed"), "heuristic_candidate", "registry_confirmed"
LABELS = ("positive", "negative")
BLINDED = ("title", "abstract", "journal", "year")
SUPPORTING, RESIDUAL = ("supporting_data", "related_data"), ("related_data",)
PREPRINT_TYPES = ("Preprint", "preprint")


class Refused(ValueError):
    """A population that may not be used."""


def document_text(title: Column, abstract: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(abstract, F.lit("")))


def worth_text(text: Column) -> Column:
    """Whether anything but dots and spaces is there."""
    return F.regexp_replace(text, "^[. ]+|[. ]+$", "") != ""


def trusted(rows: DataFrame, key: str, held_out: DataFrame | None = None, candidates: bool = False) -> DataFrame:
    """Rows with a trusted confidence (candidates add the heuristic one) and a definite label, without the held-out keys."""
    kinds = [*TRUSTED, *([CANDIDATE] if candidates else [])]
    pool = rows.where(F.col("label_confidence").isin(*kinds) & F.col("label").isin(*LABELS))
    return pool if held_out is None else pool.join(held_out.select(key).distinct(), key, "left_anti")


def staged(rows: DataFrame, key: str = "pid", needed: tuple[str, ...] = BLINDED) -> DataFrame:
    """Rows of a staged batch with an abstract. Refused if a column is missing or a key is blank or repeated: it could not be merged back."""
    if missing := [c for c in (key, *needed) if c not in rows.columns]:
        raise Refused(f"missing columns: {missing}")
    n, blanks, ids = rows.agg(F.count("*"), F.count_if(blank(F.col(key))), F.countDistinct(key)).first()
    if blanks:
        raise Refused(f"{blanks} rows without {key}")
    if ids < n:
        raise Refused(f"{n - ids} repeated {key}")
    return rows.where(~blank(F.col("abstract")))


def has_source(sources: Column, confidence: str) -> Column:
    """Whether a JSON list of sources holds one of this confidence; malformed: false."""
    entries = F.from_json(sources, "array<struct<source_label_confidence: string>>")
    return F.coalesce(F.exists(entries, lambda e: e["source_label_confidence"] == confidence), F.lit(False))


def original_cohort(rows: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Human-curated, definite, not yet reviewed, and from no registry."""
    pool = rows.where((F.col("label_confidence") == TRUSTED[0]) & F.col("label").isin(*LABELS) & ~has_source(F.col("sources"), REGISTRY))
    return pool.join(events.select(key).distinct(), key, "left_anti")


def exportable(rows: DataFrame, journals: list[str] | None, again: bool = False) -> DataFrame:
    """Positive records with title and abstract, of these journals, that no provider has enriched (again: whether or not)."""
    ok = (F.col("label") == "positive") & ~blank(F.col("title")) & ~blank(F.col("abstract"))
    ok = ok & F.col("journal").isin(*journals) if journals else ok
    return rows.where(ok if again else ok & F.col("provider").isNull())


def projected_cost(n: int, limit: int | None, per_thousand: float = 1.80, most: float | None = None) -> float:
    """What a run of n records, or limit if fewer, will cost; Refused above most."""
    cost = min(n, n if limit is None else limit) / 1000 * per_thousand
    if most is not None and cost > most:
        raise Refused(f"projected {cost:.2f} is above {most:.2f}")
    return cost


def is_preprint(flag: Column, pub_types: Column) -> Column:
    """The export's flag where it says so, else the publication types (a JSON list; malformed: no)."""
    low = F.lower(F.trim(F.coalesce(flag, F.lit(""))))
    types = F.coalesce(F.from_json(pub_types, "array<string>"), F.array().cast("array<string>"))
    return F.when(low.isin("true", "false"), low == "true").otherwise(F.exists(types, lambda t: t.isin(*PREPRINT_TYPES)))


def fetch_key(pmid: Column, pmcid: Column, doi: Column, preprint: Column) -> Column:
    """Struct of kind and value by which a record is fetched: a preprint by its DOI, others by pmid, else doi, else pmcid; null if it has none."""
    text = lambda x: F.nullif(F.trim(F.coalesce(x, F.lit(""))), F.lit(""))
    p, c, d = text(pmid), text(pmcid), F.lower(text(doi))
    key = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    return F.when(preprint & d.isNotNull(), key("ppr", d)).when(p.isNotNull(), key("pmid", p)).when(d.isNotNull(), key("doi", d)).when(c.isNotNull(), key("pmcid", c))


def route_wanted(has_data: Column, tags: Column, db_xrefs: Column, scope: str) -> Column:
    """Whether the link route is asked for a record. scope: all, supporting or residual; tags is a JSON list."""
    yes = lambda x: F.upper(F.trim(F.coalesce(x, F.lit("")))) == "Y"
    if scope == "all":
        return yes(has_data)
    wanted = SUPPORTING if scope == "supporting" else RESIDUAL
    listed = F.coalesce(F.from_json(tags, "array<string>"), F.array().cast("array<string>"))
    return yes(db_xrefs) | F.exists(listed, lambda t: t.isin(*wanted))


def targets(rows: DataFrame, key: Column, fresh: DataFrame, pid: str) -> DataFrame:
    """Distinct (kind, value) to fetch, without the fresh ones, each with the records it is fetched for (those of one key are few)."""
    each = rows.select(pid, key.alias("k")).where("k is not null").select(pid, "k.*")
    return each.join(fresh.select("kind", "value").distinct(), ["kind", "value"], "left_anti").groupBy("kind", "value").agg(F.array_sort(F.collect_set(pid)).alias("pids"))


def scope(name: str, rows: DataFrame, key: str, sample: DataFrame, pool: DataFrame) -> DataFrame:
    """A population by name: sample, all, all_plus_candidates, pool (without the curated) or staged."""
    made = {
        "sample": lambda: rows.join(sample.select(key).distinct(), key, "left_semi"),
        "all": lambda: trusted(rows, key, sample),
        "all_plus_candidates": lambda: trusted(rows, key, sample, True),
        "pool": lambda: pool.join(rows.select(key).distinct(), key, "left_anti"),
        "staged": lambda: staged(pool, key),
    }
    if name not in made:
        raise Refused(f"no scope {name}; there are {sorted(made)}")
    return made[name]()


def in_scope(keys: DataFrame, key: str, verdicts: DataFrame | None, name: str) -> DataFrame:
    """keys of a link build: all, or those whose latest verdict (their own classification if there are no verdicts) is positive."""
    if name == "all":
        return keys
    if verdicts is not None:
        return keys.join(verdicts.where("verdict = 'positive'").select(key).distinct(), key, "left_semi")
    if "classification" not in keys.columns:
        raise Refused("positives need a classification")
    return keys.where("classification = 'positive'")


def undetermined(sample: DataFrame, events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The sample's rows whose latest event is undeterminable."""
    last = events.groupBy(key).agg(F.max_by("classification", F.struct(*order)).alias("c")).where("c = 'undeterminable'")
    return sample.join(last.select(key), key, "left_semi")


def listed(ids: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """rows in the order of a list of ids; the job fails if one is absent."""
    mark = rows.withColumn("_there", F.lit(True))
    j = ids.select(key, order).join(mark, key, "left")
    return j.where(F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit("absent: "), F.col(key).cast("string")))).otherwise(F.lit(True))).drop("_there").orderBy(order)


def seeds(rows: DataFrame, column: str, order: str, marked: bool = False) -> DataFrame:
    """First row of each id of a seed list, whose headers may have any case; marked keeps those with a mark in 'use' only."""
    low = rows.toDF(*[c.strip().lower() for c in rows.columns])
    if column not in low.columns or (marked and "use" not in low.columns):
        raise Refused(f"no column {column}")
    use = low.where(~blank(F.col(column)))
    use = use.where(F.lower(F.trim("use")).isin("y", "yes", "x", "1", "true")) if marked else use
    return use.groupBy(F.trim(column).alias(column)).agg(F.min(F.col(order).cast("long")).alias(order))


def sample_cohort(rows: DataFrame, strata: list[str], size: int, key: str, seed: int = 0) -> DataFrame:
    """All rows if there are no more than size, else at most an equal part of each stratum."""
    n = rows.count()
    if n <= size:
        return rows
    return capped_sample(rows, strata, cohort_cap(size, rows.select(*strata).distinct().count()), key, seed)


def cursor(queue: DataFrame, order: list[Column], at: int, window: int = 1) -> DataFrame:
    """Rows around a place (from 0) of a queue: how far each is from it, and how many remain behind it. A top-k of at + window rows."""
    n = queue.count()
    top = queue.orderBy(*order).limit(at + window + 1)
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)) - 1
    return top.withColumn("step", (rank - at).cast("int")).where(F.abs("step") <= window).withColumn("remaining", F.lit(n) - F.col("step") - at - 1)


def domains(tree: DataFrame, cap: int, accepted: list[str] | None = None) -> DataFrame:
    """Leaves of a resource tree that cite papers, at most cap entries large, smallest first.

    tree has id, parent, entries and fields (array of struct of id, retrievable, cites). Only a leaf, a row that is nobody's parent, is a domain.
    """
    leaves = tree.join(tree.select(F.col("parent").alias("id")).where("id is not null").distinct(), "id", "left_anti")
    usable = F.filter("fields", lambda f: f["retrievable"])
    named = F.transform(F.filter(usable, lambda f: f["cites"] | F.upper(f["id"]).isin("PUBMED", "PMID", "PMCID", "DOI")), lambda f: f["id"])
    rows = leaves.select("id", "entries", F.when(F.exists(usable, lambda f: f["cites"]), named).alias("publication_fields")).where("publication_fields is not null").where(F.col("entries") <= cap)
    rows = rows.where(F.col("id").isin(*accepted)) if accepted is not None else rows
    return rows.orderBy("entries", "id")


def newest_stamp(logs: list[DataFrame], key: str, at: str) -> DataFrame:
    """The largest time of each record over several logs."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [log.select(key, at) for log in logs]).where(F.col(at).isNotNull()).groupBy(key).agg(F.max(at).alias(at))


def first_with_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each id; rows without an id are all kept."""
    rest = [c for c in rows.columns if c != key]
    some = rows.where(~blank(F.col(key))).groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return some.select(*rows.columns).unionByName(rows.where(blank(F.col(key))))


def resume(work: DataFrame, log: DataFrame, key: str, pinned: dict[str, str], again_truncated: bool = False) -> DataFrame:
    """Work without a finished event under exactly these settings. Errors are done again; an answer cut at its length only if asked."""
    same = log
    for c, v in pinned.items():
        same = same.where(F.col(c) == v)
    done = (F.col("status") != "parse_error") | (F.lit(not again_truncated) & (F.col("finish") == "length"))
    return work.join(same.where(done).select(key).distinct(), key, "left_anti")

"""Queries of loads on the test tables, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvane.operators import documents, loads
from corvane.plans.catalog import query
from corvane.session import read, shared_dir


def _shown(updates, *columns):
    """pid and, for each field, its value as text, or '-' where the update leaves it alone."""
    return updates.select("pid", *[F.when(F.col(c)["present"], F.coalesce(F.col(c)["value"].cast("string"), F.lit("null"))).otherwise("-").alias(c) for c in columns])


def _text(x):
    return x.cast("string")


@query("citation_updates", "select c_custkey::varchar pid, (c_custkey * 3)::varchar citation_count, case when c_custkey % 2 = 0 then '2024-01-01' else 'null' end citation_count_updated, 'epmc' citation_source from customer where c_custkey % 5 > 0")
def citation_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when(k % 5 > 0, F.concat(_text(k * 3), F.lit(".0"))).otherwise(" ").alias("citation_count"), F.when(k % 2 == 0, "2024-01-01").otherwise("").alias("citation_count_updated"), F.lit(" epmc").alias("citation_source"))
    return _shown(loads.citations(rows), "citation_count", "citation_count_updated", "citation_source")


@query("licence_updates", "select c_custkey::varchar pid, case when c_custkey % 3 = 0 then '' else 'cc-by' end license, case c_custkey % 4 when 0 then 'true' when 1 then 'false' else '-' end open_access from customer")
def licence_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when(k % 3 > 0, " cc-by ").alias("license"), F.when(k % 4 == 0, "Y").when(k % 4 == 1, "no").when(k % 4 == 2, "?").alias("epmc_is_open_access"))
    return _shown(loads.licences(rows), "license", "open_access")


@query("preprint_updates", "select c_custkey::varchar pid, 'e' || c_custkey epmc_id, 'PPR' epmc_source, case when c_custkey % 2 = 0 then 'server' else '-' end preprint_server from customer where c_custkey % 3 > 0 and c_custkey % 7 > 0")
def preprint_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when(k % 3 > 0, F.concat(F.lit("e"), k)).alias("epmc_id"), F.when(k % 7 > 0, "PPR").otherwise(" ").alias("epmc_source"), F.when(k % 2 == 0, "server").alias("preprint_server"))
    return _shown(loads.preprints(rows), "epmc_id", "epmc_source", "preprint_server")


@query("data_link_updates", "select c_custkey::varchar pid, case c_custkey % 3 when 0 then 'true' when 1 then 'false' else '-' end has_data, case c_custkey % 4 when 0 then '[]' when 1 then '[a, b]' else '-' end tags from customer where c_custkey % 3 < 2 or c_custkey % 4 < 2")
def data_link_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when(k % 3 == 0, "Y").when(k % 3 == 1, "n").alias("has_data"), F.when(k % 4 == 0, "[]").when(k % 4 == 1, '["a", "b"]').alias("data_links_tags"), F.lit("").alias("accession_types"))
    return _shown(loads.data_links(rows), "has_data", "tags")


@query("identifier_updates", "select c_custkey::varchar pid, case when c_custkey % 2 = 0 then '' else 'r' || c_custkey end registry from customer where c_custkey % 3 > 0")
def identifier_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when((k % 3 > 0) & (k % 2 == 0), " ").when(k % 3 > 0, F.concat(F.lit("r"), k)).alias("registry"))
    return _shown(loads.identifiers(rows, ["registry", "other"]), "registry")


@query("fulltext_updates", "select c_custkey::varchar pid, (c_custkey % 3 = 0 or c_custkey % 4 = 0)::varchar fulltext_available from customer where c_custkey % 3 < 2 or c_custkey % 4 = 0")
def fulltext_updates(spark, sf_dir):
    k = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").select(_text(k).alias("pid"), F.when(k % 3 == 0, "Y").when(k % 3 == 1, "N").alias("in_epmc"), F.when(k % 4 == 0, "y").alias("in_pmc"))
    return _shown(loads.fulltext(rows), "fulltext_available")


_FIELDS = {"c_mktsegment", "c_acctbal"}


def _updates(spark, sf_dir):
    k = F.col("c_custkey")
    some = read(spark, sf_dir, "customer").where(k % 3 == 0)
    made = some.select("c_custkey", loads.given(F.when(k % 2 == 0, F.lit(None)).otherwise("NEW"), k % 9 != 0).alias("c_mktsegment"), loads.given(F.col("c_acctbal") + (k % 2), k % 5 != 0).alias("c_acctbal"))
    return made.unionByName(made.limit(0)).unionByName(spark.range(1).select((F.col("id") - 7).alias("c_custkey"), loads.given(F.lit("X")).alias("c_mktsegment"), loads.given(F.lit(1.0)).alias("c_acctbal")))


_CHANGED = "case when c_custkey % 9 <> 0 then 'c_mktsegment' end a, case when c_custkey % 5 <> 0 and c_custkey % 2 = 1 then 'c_acctbal' end b"


@query("update_dry_run", f"select c_custkey, true known, array_to_string(list_filter([a, b], lambda x: x is not null), ',') changed from (select c_custkey, {_CHANGED} from customer where c_custkey % 3 = 0) union all select -7, false, ''")
def update_dry_run(spark, sf_dir):
    return loads.planned(read(spark, sf_dir, "customer"), _updates(spark, sf_dir), "c_custkey", _FIELDS).withColumn("changed", F.array_join("changed", ","))


@query("stamped_update", f"with c as (select *, {_CHANGED} from customer) select c_custkey, case when c_custkey % 3 = 0 and c_custkey % 9 <> 0 then case when c_custkey % 2 = 1 then 'NEW' end else c_mktsegment end c_mktsegment, case when c_custkey % 3 = 0 and c_custkey % 5 <> 0 then c_acctbal + c_custkey % 2 else c_acctbal end c_acctbal, case when c_custkey % 3 = 0 and (a is not null or b is not null) then '2024-02-01T00:00:00Z' end record_modified from c")
def stamped_update(spark, sf_dir):
    out = loads.applied(read(spark, sf_dir, "customer"), _updates(spark, sf_dir), "c_custkey", _FIELDS, F.lit("2024-02-01T00:00:00Z"))
    return out.select("c_custkey", "c_mktsegment", "c_acctbal", "record_modified")


@query("rollback_with_unset", "select c_custkey, c_mktsegment, c_acctbal from customer")
def rollback_with_unset(spark, sf_dir):
    c, u = read(spark, sf_dir, "customer"), _updates(spark, sf_dir)
    after = loads.applied(c, u, "c_custkey", _FIELDS)
    return loads.applied(after, loads.rollback(c, u, "c_custkey"), "c_custkey", _FIELDS).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("load_flips", "select count(*) filter (where c_custkey % 9 <> 0) \"rows\", count(*) filter (where c_custkey % 9 <> 0) changed, count(*) filter (where c_custkey % 9 <> 0 and c_custkey % 2 = 1) flipped from customer where c_custkey % 3 = 0")
def load_flips(spark, sf_dir):
    return loads.flips(read(spark, sf_dir, "customer"), _updates(spark, sf_dir), "c_custkey", "c_mktsegment")


@query("load_coverage", "select 'c_mktsegment' leaf, count(c_mktsegment) \"before\", count(*) filter (where not (c_custkey % 3 = 0 and c_custkey % 9 <> 0 and c_custkey % 2 = 0)) \"after\" from customer union all select 'c_acctbal', count(*), count(*) from customer")
def load_coverage(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return loads.coverage(c, loads.applied(c, _updates(spark, sf_dir), "c_custkey", _FIELDS), ["c_mktsegment", "c_acctbal"])


@query("enrichment_history", "with c as (select c_custkey, case when c_custkey % 3 > 0 then 'v1' end prompt from customer), e as (select user_id, 'v' || (1 + user_id % 2) prompt, min(event_type) tag from events where event_type <> 'error' group by 1, 2) select c_custkey, coalesce(e.prompt, c.prompt) prompt, case when e.prompt is null then 'old' else tag end tag, case when e.prompt is not null and c.prompt is not null and e.prompt <> c.prompt then 1 else 0 end::bigint history from c left join e on user_id = c_custkey")
def enrichment_history(spark, sf_dir):
    current = read(spark, sf_dir, "customer").select("c_custkey", F.lit("old").alias("tag"), F.when(F.col("c_custkey") % 3 > 0, "v1").alias("prompt"))
    e = read(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("event_type").alias("tag")).withColumn("prompt", F.concat(F.lit("v"), 1 + F.col("c_custkey") % 2))
    return loads.superseded(current, e, "c_custkey", ["tag"], ["prompt"]).select("c_custkey", "prompt", "tag", F.size("history").cast("long").alias("history"))


@query("load_protocol", "select 'absent' \"check\", true holds, 0::bigint found union all select 'repeated', true, 0 union all select 'count', true, count(*) from part where p_partkey % 10 = 1")
def load_protocol(spark, sf_dir):
    p, k = read(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_partkey") % 10
    target, rows = p.where(k != 1), p.where(k <= 2).withColumn("p_size", F.when(k == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    plan = loads.load_plan(target, rows, "p_partkey", F.col("p_size") < 0, replace=True)
    assert plan["inserted"] and plan["identical"] and plan["replaced"]
    return loads.verified(target, loads.loaded(target, rows, "p_partkey"), rows, "p_partkey")


@query("duplicates_resolved", "with g as (select p_name, min(p_partkey) p_partkey, arg_min(case when p_partkey % 3 > 0 then p_type end, p_partkey) filter (where p_partkey % 3 > 0) p_type from part group by 1), n as (select count(*) n from part) select p_partkey, p_name, p_type, n restored from g, n")
def duplicates_resolved(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("p_type"))
    kept, gone = loads.deduplicated(p, "p_name", "p_partkey", ["p_type"])
    return kept.withColumn("restored", F.lit(loads.restored(kept, gone, "p_partkey").count()))


@query("release_document", "select 'r1' release, '1.8.0' schema_version, count(*) n, count(*) filter (where event_type = 'purchase') purchases, false unchanged, true same_again from events")
def release_document(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("schema_version", F.lit("1.8.0"))
    one = loads.release(e, "r1", "event_type", ["ts"], "schema_version")
    again = loads.release(e, "r2", "event_type", ["ts"], "schema_version", one)
    return spark.createDataFrame([(one["release"], one["schema_version"], one["count"], one["classes"]["purchase"], one["unchanged"], again["unchanged"])], "release string, schema_version string, n long, purchases long, unchanged boolean, same_again boolean")


@query("schema_alignment", "select 'a.c' path, 'authored only' side union all select 'd.e', 'published only'")
def schema_alignment(spark, sf_dir):
    a = spark.createDataFrame([], "a struct<b: int, c: array<struct<x: int>>>, d struct<f: int>").schema
    b = spark.createDataFrame([], "a struct<b: int>, d struct<e: string, f: int>").schema
    return spark.createDataFrame([(p.removesuffix(".x"), s) for p, s in loads.schema_differences(a, b)], "path string, side string")


@query("provenance_ledger", "select 'load' step, count(*) n, 'v1' version from customer union all select 'score', count(*), 'v1' from orders")
def provenance_ledger(spark, sf_dir):
    at = f"{shared_dir(spark)}/corvane/ledger-{uuid.uuid4().hex}"
    for step, t in (("load", "customer"), ("score", "orders")):
        loads.ledger(at, spark, step, [t], {t: read(spark, sf_dir, t).count()}, {"version": "v1"}, "2024-01-01")
    rows = spark.read.schema("step string, inputs array<string>, outputs map<string, long>, params map<string, string>, finished_at string").json(at)
    return rows.select("step", F.element_at(F.map_values("outputs"), 1).alias("n"), F.col("params")["version"].alias("version"))


@query("partition_layout", "select o_orderstatus, count(*) n, min(o_orderkey) first_key from orders where o_orderstatus = 'F' and o_orderkey >= 100 group by 1")
def partition_layout(spark, sf_dir):
    at = f"{shared_dir(spark)}/corvane/layout-{uuid.uuid4().hex}"
    loads.laid_out(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), at, "o_orderstatus", ["o_orderkey"])
    return spark.read.schema("o_orderkey long, o_orderstatus string").parquet(at).where("o_orderstatus = 'F' and o_orderkey >= 100").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("access_states", "select c_custkey, case when c_custkey % 3 = 0 and c_custkey % 4 < 2 then c_custkey % 4 = 0 when c_custkey % 5 = 0 then true when c_custkey % 5 = 1 then false end open_access, case when c_custkey % 3 = 0 then case when c_custkey % 2 = 0 then 'cc-by' else '' end end license from customer")
def access_states(spark, sf_dir):
    from corvane.functions.text import truth

    k = F.col("c_custkey")
    own = truth(F.when(k % 5 == 0, " YES ").when(k % 5 == 1, "n").when(k % 5 == 2, "maybe"))
    fetched = truth(F.when(k % 4 == 0, "y").when(k % 4 == 1, "No"))
    return read(spark, sf_dir, "customer").select("c_custkey", documents.open_access(own, k % 3 == 0, fetched).alias("open_access"), documents.licence(F.when(k % 2 == 0, "cc-by"), k % 3 == 0).alias("license"))


@query("json_lists", "select c_custkey, case c_custkey % 4 when 0 then 'a|1' when 1 then '' when 2 then '' else '' end tolerant, case c_custkey % 4 when 0 then 'a|1' else '' end strict, case when c_custkey % 4 = 0 then 'x' end part from customer where c_custkey % 4 <> 3")
def json_lists(spark, sf_dir):
    from corvane.functions.text import json_list

    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, '["a", 1]').when(k % 4 == 1, " ").when(k % 4 == 3, "[broken")
    rows = read(spark, sf_dir, "customer").withColumns({"raw": raw, "obj": F.when(k % 4 == 0, '{"part": "x"}')}).where(k % 4 != 3)
    return rows.select("c_custkey", F.array_join(json_list(F.col("raw")), "|").alias("tolerant"), F.array_join(loads.strict_list("raw"), "|").alias("strict"), loads.strict_object("obj", "struct<part: string>")["part"].alias("part"))


@query("json_cells", "select c_custkey, '[\"' || c_name || '\",\"' || c_mktsegment || '\"]' names, '{\"a\":' || c_custkey || '}' detail, c_name back from customer")
def json_cells(spark, sf_dir):
    """Lists and structs as JSON cells of a flat table, and back."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.to_json(F.array("c_name", "c_mktsegment")).alias("names"), F.to_json(F.struct(F.col("c_custkey").alias("a"))).alias("detail"))
    return c.withColumn("back", F.from_json("names", "array<string>")[0])

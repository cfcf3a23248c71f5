"""Queries of sources and sinks: tables are written to the shared folder in each form and read back. Each has its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvane.plans.catalog import query
from corvane.session import read, shared_dir, ship
from corvane.sources import payloads, tables


def _at(spark, name: str) -> str:
    return f"{shared_dir(spark)}/corvane/{name}-{uuid.uuid4().hex}"


def _s(x):
    return x.cast("string")


@query("csv_scan", "select o_orderkey::varchar o_orderkey, case when o_orderkey % 3 > 0 then 'say \"' || o_orderpriority || '\",' || chr(10) || 'x' end note from orders")
def csv_scan(spark, sf_dir):
    at, k = _at(spark, "csv"), F.col("o_orderkey")
    note = F.when(k % 3 > 0, F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('",\nx')))
    tables.write_rows(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", note.alias("note")), at)
    return tables.strings_csv(spark, at, ["o_orderkey", "o_custkey", "note"], wanted=["o_orderkey", "note"])


@query("id_pair_scan", "select case when c_custkey % 3 > 0 then 'PMC' || c_custkey end pmcid, case when c_custkey % 4 > 0 then c_custkey::varchar end pmid from customer")
def id_pair_scan(spark, sf_dir):
    at, k = _at(spark, "pairs"), F.col("c_custkey")
    read(spark, sf_dir, "customer").select(F.when(k % 3 > 0, F.concat(F.lit("pmc"), k)).alias("PMCID"), F.when(k % 4 > 0, F.concat(k, F.lit(".0"))).otherwise("n/a").alias("PMID")).write.option("header", True).option("sep", "\t").csv(at)
    return tables.id_pairs(spark, at, "\t")


def _files(spark, sf_dir, layout: str):
    """A folder with a file for each nation, named by its number."""
    at, k = _at(spark, layout), F.col("n_nationkey")
    name = F.concat(F.lit("PMC"), k) if layout == "pmcid_subdir" else F.concat(F.lit("x"), k)
    read(spark, sf_dir, "nation").where("n_nationkey < 12").select(name.alias("part"), F.col("n_name").alias("value")).write.partitionBy("part").text(at)
    return at


@query("pdf_directory", "select 'PMC' || n_nationkey pmcid, true has_size from nation where n_nationkey < 12")
def pdf_directory(spark, sf_dir):
    at = _files(spark, sf_dir, "pmcid_subdir")
    tables.LAYOUTS.setdefault("partition_folder", r"/part=(PMC[^/]*)/[^/]+$")
    ids = tables.pdf_ids(spark, at, "partition_folder")
    sizes = tables.manifest(spark, {"gold": (at, "partition_folder"), "again": (at, "partition_folder")})
    return ids.join(sizes.where("source = 'gold'"), "pmcid").select("pmcid", (F.col("size") > 0).alias("has_size"))


@query("source_registry", "select c_custkey::varchar id, 'customers' source_name, 'records' side from customer where c_custkey % 4 > 0 union all select null, 'customers', 'unresolved' from customer where c_custkey % 4 = 0 union all select 'b' || n_nationkey, 'batches', 'records' from nation union all select null, 'batches', 'unresolved' from nation where n_nationkey % 2 = 0")
def source_registry(spark, sf_dir):
    a, b = _at(spark, "registry"), _at(spark, "batches")
    k = F.col("c_custkey")
    tables.write_rows(read(spark, sf_dir, "customer").select(F.when(k % 4 > 0, _s(k)).alias("id"), "c_name"), a)
    n = read(spark, sf_dir, "nation")
    entries = n.agg(F.collect_list(F.struct(F.concat(F.lit("b"), F.col("n_nationkey")).alias("_id"))).alias("x"), F.collect_list(F.when(F.col("n_nationkey") % 2 == 0, F.struct(F.lit(" ").alias("_id")))).alias("y"))
    entries.select(F.to_json(F.create_map(F.lit("2"), F.col("x"), F.lit("1"), F.concat("x", "y")))).write.text(b)
    records, rest = tables.load_sources(spark, [{"kind": "csv", "name": "customers", "path": a, "columns": ["id", "c_name"], "ids": ["id"], "label": "x"}, {"kind": "batches_json", "name": "batches", "path": b, "entry": "struct<_id: string>"}])
    shown = lambda d, side: d.select(F.nullif(F.trim(F.coalesce("id", "_id")), F.lit("")).alias("id"), "source_name", F.lit(side).alias("side"))
    return shown(records, "records").union(shown(rest, "unresolved"))


def _core(spark, sf_dir, lines: bool = False):
    """Captured search results made from orders, as JSON lines."""
    at, k = _at(spark, "core"), F.col("o_orderkey")
    pick = lambda m, x: F.when(k % m > 0, x)
    made = F.struct(
        _s(k).alias("id"), F.when(k % 5 == 0, "PPR").otherwise("MED").alias("source"), pick(3, _s(k)).alias("pmid"), pick(2, F.concat(F.lit("PMC"), k)).alias("pmcid"), F.when(k % 7 == 0, F.concat(F.lit("10.1/A"), k)).alias("doi"), F.concat(F.lit("T"), k).alias("title"), pick(4, F.lit("abs")).alias("abstractText"),
        _s(F.year("o_orderdate")).alias("pubYear"), F.struct(F.struct(pick(6, F.col("o_orderpriority")).alias("title")).alias("journal")).alias("journalInfo"), F.lit("J").alias("journalTitle"),
        F.struct(F.array(F.struct(F.lit("m1").alias("descriptorName")), F.struct(F.lit(None).cast("string").alias("descriptorName"))).alias("meshHeading")).alias("meshHeadingList"), F.when(k % 3 == 0, "Y").when(k % 3 == 1, "N").alias("isOpenAccess"), F.when(k % 2 == 0, "Y").alias("inPMC"),
        F.struct(F.lit("bioRxiv").alias("publisher")).alias("bookOrReportDetails"),
    )
    read(spark, sf_dir, "orders").select(F.to_json(made).alias("value")).write.option("compression", "gzip").text(at)
    return at


@query("core_records", "select case when o_orderkey % 2 > 0 then 'PMC' || o_orderkey end pmcid, case when o_orderkey % 3 > 0 then o_orderkey::varchar end pmid, case when o_orderkey % 7 = 0 then '10.1/a' || o_orderkey end doi, 'T' || o_orderkey title, case when o_orderkey % 6 > 0 then o_orderpriority end journal, year(o_orderdate)::int as \"year\", 'm1' mesh, case o_orderkey % 3 when 0 then true when 1 then false end is_open_access, o_orderkey % 2 = 0 fulltext_available from orders")
def core_records(spark, sf_dir):
    r = payloads.raw_records(tables.json_lines(spark, _core(spark, sf_dir), payloads.CORE), "bulk")
    return r.select("pmcid", "pmid", "doi", "title", "journal", "year", F.array_join("mesh_headings", "|").alias("mesh"), "is_open_access", "fulltext_available")


@query("incoming_rows", "select case when o_orderkey % 2 > 0 then 'PMC' || o_orderkey else '' end pmcid, case when o_orderkey % 3 > 0 then o_orderkey::varchar else '' end pmid, case when o_orderkey % 6 > 0 then o_orderpriority else 'J' end journal, '[\"m1\"]' mesh_headings, '[]' pub_types, case when o_orderkey % 4 > 0 then 'europepmc' else '' end abstract_source, case when o_orderkey % 5 = 0 then 'bioRxiv' else '' end preprint_server, length('x') * 36 pid_length from orders where o_orderkey % 6 > 0 or o_orderkey % 7 = 0")
def incoming_rows(spark, sf_dir):
    r = payloads.incoming(tables.json_lines(spark, _core(spark, sf_dir), payloads.CORE))
    return r.select("pmcid", "pmid", "journal", "mesh_headings", "pub_types", "abstract_source", "preprint_server", F.length("pid").alias("pid_length"))


@query("wanted_lines", "select l_orderkey id, count(*) n from lineitem where l_orderkey % 10 = 3 group by 1")
def wanted_lines(spark, sf_dir):
    at = _at(spark, "lines")
    li = read(spark, sf_dir, "lineitem")
    li.select(F.to_json(F.struct(F.lit("MED").alias("source"), _s(F.col("l_orderkey")).alias("id"), "l_quantity")).alias("value")).write.text(at)
    wanted = li.where("l_orderkey % 10 = 3").select(_s(F.col("l_orderkey")).alias("id"))
    rows = tables.wanted_json_lines(spark, at, r'^\{"source":"[^"]*","id":"([^"]*)"', wanted, "id", "id string, l_quantity double")
    return rows.groupBy(F.col("id").cast("long").alias("id")).agg(F.count("*").alias("n"))


@query("torn_lines", "select event_id from events")
def torn_lines(spark, sf_dir):
    at = _at(spark, "torn")
    e = read(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    e.union(spark.range(1).select(F.lit('{"event_id": 12, "event_ty').alias("value"))).write.text(at)
    return tables.whole_lines(spark, at, "event_id long, event_type string").select("event_id")


@query("textmined_bulk", "select case when p_partkey % 3 = 0 then 'MED' when p_partkey % 3 = 1 then 'PMC' end source, (p_partkey % 100)::varchar id, string_agg('A' || p_partkey, '|' order by 'A' || p_partkey) accessions from part where p_partkey % 3 < 2 group by 1, 2")
def textmined_bulk(spark, sf_dir):
    k = F.col("p_partkey")
    m = _s(k % 100)
    rows = read(spark, sf_dir, "part").select(F.concat(F.lit("A"), k).alias("accession"), F.when(k % 3 == 1, F.concat(F.lit("PMC"), m)).otherwise("PMCx").alias("pmcid"), F.when(k % 3 == 0, m).otherwise("none").alias("ext_id"), F.lit(" MED ").alias("source"))
    known = spark.range(100).select(F.lit("MED").alias("source"), _s(F.col("id")).alias("id"), F.lit("").alias("pmcid")).union(spark.range(100).select(F.lit("PMC"), _s(F.col("id")), F.concat(F.lit("PMC"), F.col("id"))))
    return payloads.textmined(rows, known, "geo").select("source", "id", F.array_join(F.transform("accessions", lambda a: a["accession"]), "|").alias("accessions"))


@query("annotation_payloads", "select c_custkey::varchar id, case when c_custkey % 3 > 0 then 'ok' else 'absent' end status, case when c_custkey % 3 > 0 then 'GSE' || c_custkey end exact, case when c_custkey % 3 > 0 then case when c_custkey % 2 = 0 then 'geo' else 'pdb' end end sub_type, case when c_custkey % 3 > 0 then 'Article' end section from customer")
def annotation_payloads(spark, sf_dir):
    at, k = _at(spark, "annotations"), F.col("c_custkey")
    c = read(spark, sf_dir, "customer")
    tag = F.array(F.struct(F.when(k % 2 == 0, "http://identifiers.org/geo:GSE1").otherwise("https://www.rcsb.org/x").alias("uri")))
    one = F.struct(F.concat(F.lit(" GSE"), k).alias("exact"), tag.alias("tags"), F.lit("Article (http://x.org/S)").alias("section"))
    c.where(k % 3 > 0).select(F.to_json(F.struct(F.lit("MED").alias("source"), _s(k).alias("extId"), F.array(one).alias("annotations"))).alias("value")).write.text(at)
    requested = c.select(F.lit("MED").alias("source"), _s(k).alias("id"))
    out = payloads.annotations(tables.json_lines(spark, at, payloads.ANNOTATIONS), requested, "2024-01-01")
    first = F.get("annotations", F.lit(0))
    return out.select("id", "status", first["exact"].alias("exact"), first["sub_type"].alias("sub_type"), first["section"].alias("section"))


@query("datalink_payloads", "select n_nationkey::bigint doc, 'id' || n_nationkey || '-' || l id, 'cat' category, case when l = 0 then 'own' else 'section' end obtained_by from nation, (select unnest([0, 1]) l) where n_nationkey % 4 > 0")
def datalink_payloads(spark, sf_dir):
    k = F.col("n_nationkey")
    link = lambda i: F.struct(F.when(F.lit(i == 0), "own").alias("ObtainedBy"), F.struct(F.struct((F.lit(" ") if i == 2 else F.concat(F.lit("id"), k, F.lit(f"-{i}"))).alias("ID")).alias("Identifier")).alias("Target"))
    section = F.struct(F.lit("section").alias("ObtainedBy"), F.struct(F.array(link(0), link(1), link(2)).alias("Link")).alias("Linklist"))
    body = F.when(k % 4 > 0, F.to_json(F.struct(F.struct(F.array(F.struct(F.lit("cat").alias("Name"), F.array(section).alias("Section"))).alias("Category")).alias("dataLinkList")))).otherwise("{}")
    rows = read(spark, sf_dir, "nation").select(k.cast("long").alias("doc"), F.from_json(body, payloads.SCHOLIX).alias("r")).select("doc", "r.*")
    return payloads.datalinks(rows).select("doc", "id", "category", "obtained_by")


@query("captured_answers", "select n_nationkey::varchar \"key\", case when n_nationkey % 2 = 0 then n_name end body, n_nationkey % 2 = 0 found from nation")
def captured_answers(spark, sf_dir):
    """A Python data source over captured files; the files are made from one small table."""
    from pathlib import Path

    ship(spark)
    at = _at(spark, "captured").removeprefix("file://").removeprefix("file:")
    Path(at).mkdir(parents=True)
    rows = read(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()  # 25 rows
    for r in rows:
        if r.n_nationkey % 2 == 0:
            (Path(at) / f"{r.n_nationkey}.json").write_text(r.n_name)
    spark.dataSource.register(tables.CapturedAnswers)
    return spark.read.format("captured_answers").option("path", at).option("keys", ",".join(str(r.n_nationkey) for r in rows)).option("chunk", "7").load()


@query("store_probe", "select distinct l_partkey p_partkey from lineitem where l_partkey in (select p_partkey from part where p_size > 25)")
def store_probe(spark, sf_dir):
    wanted = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return tables.existing(wanted, read(spark, sf_dir, "part").where("p_size > 25"), "p_partkey")


@query("store_scan", "select p_partkey, p_name from part where p_size > 45 order by p_partkey")
def store_scan(spark, sf_dir):
    return tables.scanned(read(spark, sf_dir, "part"), F.col("p_size") > 45, ["p_name"], "p_partkey")


@query("appended_log", "select event_id::varchar event_id, event_type from events")
def appended_log(spark, sf_dir):
    at, e = _at(spark, "log"), read(spark, sf_dir, "events").select("event_id", "event_type")
    for m in (0, 1):
        tables.append_log(e.where(F.col("event_id") % 2 == m), at, "csv")
    return tables.strings_csv(spark, at, ["event_id", "event_type"])


@query("corpus_export", "select c_custkey, c_name, (select count(*) from customer) \"rows\", true same_digest from customer")
def corpus_export(spark, sf_dir):
    at, c = _at(spark, "export"), read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    side = tables.export_corpus(c, at, "c_custkey")
    lines = spark.read.text(at)
    back = lines.select(F.from_json("value", "c_custkey long, c_name string").alias("r")).select("r.*")
    return back.withColumns({"rows": F.lit(side["rows"]), "same_digest": F.lit(tables.digest(lines, "value") == side)})


@query("key_export", "select distinct case when l_partkey % 2 = 0 then l_partkey::varchar end pmid, case when l_partkey % 3 = 0 then 'PMC' || l_partkey end pmcid from lineitem where l_partkey % 2 = 0 or l_partkey % 3 = 0")
def key_export(spark, sf_dir):
    at, k = _at(spark, "keys"), F.col("l_partkey")
    tables.write_keys(read(spark, sf_dir, "lineitem").select(F.when(k % 2 == 0, _s(k)).alias("pmid"), F.when(k % 3 == 0, F.concat(F.lit("PMC"), k)).alias("pmcid")), at, ["pmid", "pmcid"])
    return tables.strings_csv(spark, at, ["pmid", "pmcid"])


@query("chunked_export", "select c_custkey from customer")
def chunked_export(spark, sf_dir):
    at = _at(spark, "chunks")
    tables.write_chunks(read(spark, sf_dir, "customer").select("c_custkey"), at, ["c_custkey"], 100)
    back = tables.json_lines(spark, at, "c_custkey long").withColumn("file", F.input_file_name())
    assert back.groupBy("file").count().where("count > 100").count() == 0
    return back.select("c_custkey")


@query("spend_log", "select event_type step, round(sum(coalesce(case when event_id % 3 = 0 then value end, value / 2)), 4) usd from events group by 1")
def spend_log(spark, sf_dir):
    at, i = _at(spark, "spend"), F.col("event_id")
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("step"), (F.col("value") / 2).alias("estimated"), F.when(i % 3 == 0, F.col("value")).alias("actual"), "event_id")
    tables.append_log(e.where("event_id < 500"), at)
    tables.append_log(e.where("event_id >= 500"), at)
    log = spark.read.schema("step string, estimated double, actual double, event_id long").parquet(at)
    return log.groupBy("step").agg(F.round(F.sum(F.coalesce("actual", "estimated")), 4).alias("usd"))


@query("heterogeneous_union", "select c_custkey id, c_name as name, null::double price from customer union all select p_partkey, p_name, p_retailprice from part")
def heterogeneous_union(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = read(spark, sf_dir, "part").select(F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return tables.union_sources([a, b])

"""Queries of populations and identifier cascades on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import cascades, populations, reviews
from corvane.plans.catalog import query
from corvane.session import read

_REC = """with r as (select doc_id, case doc_id % 4 when 0 then 'human_curated' when 1 then 'registry_confirmed' when 2 then 'heuristic_candidate' else 'unscored' end label_confidence, case when quality = 1 then 'positive' when quality = 0 then 'negative' else 'unlabeled' end as label, source journal, n_chars, case doc_id % 5 when 0 then '[{"source_label_confidence": "registry_confirmed"}]' when 1 then '[{"source_label_confidence": "other"}, {}]' when 2 then 'broken [' end sources, case when doc_id % 6 > 0 then 'Title ' || doc_id end title, case when doc_id % 7 > 0 then left(text, 20) else ' ' end abstract, case when doc_id % 9 = 0 then 'p' end provider from documents left join labels using (doc_id)) """


def _records(spark, sf_dir):
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select(
        "doc_id", F.when(k % 4 == 0, "human_curated").when(k % 4 == 1, "registry_confirmed").when(k % 4 == 2, "heuristic_candidate").otherwise("unscored").alias("label_confidence"), F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").otherwise("unlabeled").alias("label"), F.col("source").alias("journal"), "n_chars",
        F.when(k % 5 == 0, '[{"source_label_confidence": "registry_confirmed"}]').when(k % 5 == 1, '[{"source_label_confidence": "other"}, {}]').when(k % 5 == 2, "broken [").alias("sources"), F.when(k % 6 > 0, F.concat(F.lit("Title "), k)).alias("title"), F.when(k % 7 > 0, F.left("text", F.lit(20))).otherwise(" ").alias("abstract"), F.when(k % 9 == 0, "p").alias("provider"),
    )


# ---- populations ----
@query("document_texts", _REC + ", t as (select doc_id, coalesce(title, '') || '. ' || coalesce(abstract, '') doc_text from r where label in ('positive', 'negative')) select * from t where regexp_replace(doc_text, '^[. ]+|[. ]+$', '', 'g') <> ''")
def document_texts(spark, sf_dir):
    r = _records(spark, sf_dir).where(F.col("label").isin(*populations.LABELS)).select("doc_id", populations.document_text(F.col("title"), F.col("abstract")).alias("doc_text"))
    return r.where(populations.worth_text(F.col("doc_text")))


@query("trusted_population", _REC + "select doc_id, label from r where label_confidence in ('human_curated', 'registry_confirmed') and label in ('positive', 'negative') and doc_id % 10 <> 3")
def trusted_population(spark, sf_dir):
    r = _records(spark, sf_dir)
    return populations.trusted(r, "doc_id", r.where("doc_id % 10 = 3")).select("doc_id", "label")


@query("staged_gate", _REC + "select doc_id::varchar pid, title from r where doc_id % 7 > 0 and trim(abstract) <> ''")
def staged_gate(spark, sf_dir):
    r = _records(spark, sf_dir).withColumns({"pid": F.col("doc_id").cast("string"), "year": F.lit(2020)})
    return populations.staged(r).select("pid", "title")


@query("original_cohort", _REC + "select doc_id from r where label_confidence = 'human_curated' and label in ('positive', 'negative') and doc_id % 5 <> 0 and doc_id not in (select user_id from events)")
def original_cohort(spark, sf_dir):
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"))
    return populations.original_cohort(_records(spark, sf_dir), events, "doc_id").select("doc_id")


@query("exportable_records", _REC + "select doc_id, journal from r where label = 'positive' and provider is null and trim(coalesce(title, '')) <> '' and trim(abstract) <> '' and journal in ('src0', 'src3')")
def exportable_records(spark, sf_dir):
    return populations.exportable(_records(spark, sf_dir), ["src0", "src3"]).select("doc_id", "journal")


@query("cost_guard", _REC + ", n as (select count(*) n from r where label = 'positive') select n, round(least(n, 50) / 1000 * 1.8, 4) projected, least(n, 50) / 1000 * 1.8 > 0.05 refused from n")
def cost_guard(spark, sf_dir):
    n = _records(spark, sf_dir).where("label = 'positive'").count()
    try:
        populations.projected_cost(n, 50, most=0.05)
        refused = False
    except populations.Refused:
        refused = True
    return spark.createDataFrame([(n, round(populations.projected_cost(n, 50), 4), refused)], "n long, projected double, refused boolean")


@query("population_scopes", _REC + "select 'sample' scope, count(*) n from r where doc_id % 10 = 3 union all select 'all', count(*) from r where label_confidence in ('human_curated', 'registry_confirmed') and label <> 'unlabeled' and doc_id % 10 <> 3 union all select 'all_plus_candidates', count(*) from r where label_confidence <> 'unscored' and label <> 'unlabeled' and doc_id % 10 <> 3 union all select 'pool', count(*) from events where event_id not in (select doc_id from documents)")
def population_scopes(spark, sf_dir):
    from functools import reduce

    r = _records(spark, sf_dir)
    pool = read(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"))
    found = [populations.scope(n, r, "doc_id", r.where("doc_id % 10 = 3"), pool).agg(F.count("*").alias("n")).select(F.lit(n).alias("scope"), "n") for n in ("sample", "all", "all_plus_candidates", "pool")]
    return reduce(lambda a, b: a.union(b), found)


_KEYED = "with k as (select o_orderkey, case when o_orderkey % 3 = 0 then ' ' || o_orderkey end pmid, case when o_orderkey % 4 = 0 then 'PMC' || o_orderkey end pmcid, case when o_orderkey % 2 = 0 then '10.1/X' || o_orderkey end doi, case o_orderkey % 5 when 0 then 'true' when 1 then 'False' end flag, case o_orderkey % 5 when 2 then '[\"Preprint\", \"x\"]' when 3 then 'oops' end types from orders) "


def _keyed(spark, sf_dir):
    k, s = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    return read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, F.concat(F.lit(" "), s)).alias("pmid"), F.when(k % 4 == 0, F.concat(F.lit("PMC"), s)).alias("pmcid"), F.when(k % 2 == 0, F.concat(F.lit("10.1/X"), s)).alias("doi"), F.when(k % 5 == 0, "true").when(k % 5 == 1, "False").alias("flag"), F.when(k % 5 == 2, '["Preprint", "x"]').when(k % 5 == 3, "oops").alias("types"))


_FETCH = _KEYED + ", f as (select *, flag = 'true' or (flag is null and o_orderkey % 5 = 2) pre from k), g as (select *, case when coalesce(pre, false) and doi is not null then 'ppr' when pmid is not null then 'pmid' when doi is not null then 'doi' when pmcid is not null then 'pmcid' end kind from f), h as (select *, case kind when 'ppr' then lower(doi) when 'doi' then lower(doi) when 'pmid' then trim(pmid) when 'pmcid' then pmcid end as val from g) "


def _fetch_key():
    return populations.fetch_key(F.col("pmid"), F.col("pmcid"), F.col("doi"), populations.is_preprint(F.col("flag"), F.col("types")))


@query("fetch_keys", _FETCH + "select o_orderkey, kind, val as \"value\" from h")
def fetch_keys(spark, sf_dir):
    return _keyed(spark, sf_dir).select("o_orderkey", _fetch_key().alias("k")).select("o_orderkey", "k.kind", "k.value")


@query("fetch_targets", _FETCH + "select kind, val as \"value\", array_to_string(list_sort(list(distinct o_orderkey)), ',') pids from h where kind is not null and not (kind = 'pmid' and o_orderkey % 6 = 0) group by all")
def fetch_targets(spark, sf_dir):
    k = _keyed(spark, sf_dir)
    fresh = k.where("o_orderkey % 6 = 0 and pmid is not null").select(F.lit("pmid").alias("kind"), F.trim("pmid").alias("value"))
    return populations.targets(k, _fetch_key(), fresh, "o_orderkey").withColumn("pids", F.array_join("pids", ","))


@query("route_targets", "select o_orderkey, o_orderkey % 3 = 0 wanted_all, o_orderkey % 4 = 1 or o_orderkey % 5 < 2 wanted_supporting, o_orderkey % 4 = 1 or o_orderkey % 5 = 1 wanted_residual from orders")
def route_targets(spark, sf_dir):
    k = F.col("o_orderkey")
    has, xref = F.when(k % 3 == 0, " y").otherwise("N"), F.when(k % 4 == 1, "Y")
    tags = F.when(k % 5 == 0, '["supporting_data"]').when(k % 5 == 1, '["x", "related_data"]').when(k % 5 == 2, "broken")
    return read(spark, sf_dir, "orders").select("o_orderkey", *[populations.route_wanted(has, tags, xref, s).alias(f"wanted_{s}") for s in ("all", "supporting", "residual")])


@query("positive_scope", "with v as (select user_id, arg_max(event_type, (ts, event_id)) t from events where event_type <> 'error' group by 1) select c_custkey from customer join v on user_id = c_custkey where t = 'purchase'")
def positive_scope(spark, sf_dir):
    last = read(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("t"))
    verdicts = last.select("c_custkey", F.when(F.col("t") == "purchase", "positive").otherwise("negative").alias("verdict"))
    return populations.in_scope(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", verdicts, "positives")


@query("undetermined_subset", "with v as (select user_id, arg_max(event_type, (ts, event_id)) t from events group by 1) select c_custkey from customer join v on user_id = c_custkey where t = 'error' and c_custkey % 2 = 0")
def undetermined_subset(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_type") == "error", "undeterminable").otherwise("positive").alias("classification"), "ts", "event_id")
    return populations.undetermined(read(spark, sf_dir, "customer").select("c_custkey").where("c_custkey % 2 = 0"), e, "c_custkey", ["ts", "event_id"])


@query("ids_in_list_order", "select p_partkey, row_number() over (order by p_retailprice desc, p_partkey)::int place, p_name from part where p_size = 7")
def ids_in_list_order(spark, sf_dir):
    from pyspark.sql import Window

    p = read(spark, sf_dir, "part")
    rank = F.row_number().over(Window.partitionBy("p_size").orderBy(F.desc("p_retailprice"), "p_partkey"))
    ids = p.where("p_size = 7").select("p_partkey", rank.alias("place"))
    return populations.listed(ids, p.select("p_partkey", "p_name"), "p_partkey", "place")


@query("seed_list", "select trim(l_partkey::varchar) pmid, min(l_orderkey * 10 + l_linenumber) ord from lineitem where l_returnflag = 'R' group by 1")
def seed_list(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), F.lit(" ")).alias("PMID"), F.when(F.col("l_returnflag") == "R", " Yes").alias(" Use"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Ord"))
    return populations.seeds(li, "pmid", "ord", True)


@query("domain_selection", "select n_nationkey + 100 id, n_nationkey * 10 entries, case when n_nationkey % 4 = 0 then 'DOI' else 'xref,PMID' end fields from nation where n_nationkey % 3 < 2 and n_nationkey * 10 <= 180 and n_nationkey <> 6 order by entries, id")
def domain_selection(spark, sf_dir):
    field = lambda i, r, c: F.struct(F.lit(i).alias("id"), F.lit(r).alias("retrievable"), c.alias("cites"))
    k = F.col("n_nationkey").cast("long")
    roots = read(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("parent"), F.lit(1).cast("long").alias("entries"), F.array(field("DOI", True, F.lit(True))).alias("fields"))
    cites = k % 3 < 2
    fields = F.when(k % 4 == 0, F.array(field("DOI", True, cites), field("PMCID", False, F.lit(True)))).otherwise(F.array(field("name", True, F.lit(False)), field("xref", True, cites), field("PMID", True, F.lit(False))))
    leaves = read(spark, sf_dir, "nation").select((k + 100).alias("id"), F.col("n_regionkey").cast("long").alias("parent"), (k * 10).alias("entries"), fields.alias("fields"))
    accepted = [100 + i for i in range(25) if i != 6]
    return populations.domains(roots.unionByName(leaves), 180, accepted).select("id", "entries", F.array_join("publication_fields", ",").alias("fields"))


@query("curation_timestamps", "select user_id, max(ts)::varchar ts from (select user_id, ts from events where event_id % 3 = 0 union all select user_id, ts from events where event_type = 'view') group by 1")
def curation_timestamps(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    last = populations.newest_stamp([e.where("event_id % 3 = 0"), e.where("event_type = 'view'")], "user_id", "ts")
    text = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return last.select("user_id", F.regexp_replace(text, r"\.?0*$", "").alias("ts"))


@query("first_with_id", "with e as (select event_id, case when event_type <> 'error' then user_id::varchar else ' ' end id, value from events) select arg_min(event_id, event_id) event_id, id, arg_min(value, event_id) as \"value\" from e where id <> ' ' group by id union all select event_id, id, value from e where id = ' '")
def first_with_id(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).otherwise(" ").alias("id"), "value")
    return populations.first_with_id(e, "id", "event_id")


@query("resume_pinned", "select c_custkey from customer where c_custkey not in (select user_id from events where event_type in ('view', 'error') and event_id % 2 = 0 and (event_type <> 'error' or event_id % 3 = 0))")
def resume_pinned(spark, sf_dir):
    log = read(spark, sf_dir, "events").where("event_type in ('view', 'error')").select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_id") % 2 == 0, "v2").otherwise("v1").alias("version"), F.lit("t").alias("tier"), F.when(F.col("event_type") == "error", "parse_error").otherwise("ok").alias("status"), F.when(F.col("event_id") % 3 == 0, "length").otherwise("stop").alias("finish"))
    return populations.resume(read(spark, sf_dir, "customer").select("c_custkey"), log, "c_custkey", {"version": "v2", "tier": "t"})


@query("cohort_sample", "with s as (select doc_id, source, row_number() over (partition by source order by md5(doc_id || ':3'), doc_id) r from documents), n as (select greatest(1, round_even(60.0 / count(distinct coalesce(source, '~')), 0)) cap from documents) select doc_id, source from s, n where r <= cap")
def cohort_sample(spark, sf_dir):
    return populations.sample_cohort(read(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], 60, "doc_id", 3)


@query("stratified_sample", "with t as (select source from documents where source is not null group by source order by count(*) desc, source limit 5), d as (select doc_id, coalesce(t.source, 'other') grp, lang from documents left join t using (source)), r as (select *, row_number() over (partition by grp, lang order by md5(doc_id || ':0'), doc_id) r from d) select doc_id, grp, lang from r where r <= 15")
def stratified_sample(spark, sf_dir):
    from corvane.operators import sampling

    d = sampling.top_or_other(read(spark, sf_dir, "documents"), "source", 5, "grp").select("doc_id", "grp", "lang")
    return sampling.capped_sample(d, ["grp", "lang"], 15, "doc_id")


@query("shuffled_queue", "select doc_id, row_number() over (order by md5(doc_id || ':7'), doc_id)::int place from documents where lang = 'en' order by place limit 40")
def shuffled_queue(spark, sf_dir):
    from pyspark.sql import Window

    top = read(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id").orderBy(reviews.draw("doc_id", 7), "doc_id").limit(40)  # a top-k report
    return top.select("doc_id", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(reviews.draw("doc_id", 7), "doc_id")).alias("place"))


@query("queue_cursor", "with q as (select p_partkey, row_number() over (order by p_retailprice desc, p_partkey) - 1 i, count(*) over () n from part) select p_partkey, (i - 30)::int step, n - i - 1 remaining from q where i between 28 and 32")
def queue_cursor(spark, sf_dir):
    return populations.cursor(read(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), [F.desc("p_retailprice"), F.col("p_partkey")], 30, 2).select("p_partkey", "step", "remaining")


@query("five_year_buckets", "select floor(year(o_orderdate) / 5)::int * 5 bucket, count(*) n from orders group by 1")
def five_year_buckets(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy((F.floor(F.year("o_orderdate") / 5) * 5).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


# ---- cascades ----
_LOOK = "with b as (select s_suppkey, case when s_suppkey % 3 <> 0 then 'p' || s_suppkey end pmcid, case when s_suppkey % 4 <> 0 then 'm' || s_suppkey end pmid, 'd' || s_suppkey doi, s_name as label, case when s_suppkey % 2 = 0 then 'c' || s_suppkey end confidence from supplier), p as (select c_custkey, case when c_custkey % 2 = 0 then 'p' || (c_custkey % 150) end pmcid, case when c_custkey % 3 = 0 then 'm' || (c_custkey % 140) end pmid, 'd' || (c_custkey % 130) doi, case when c_custkey % 5 = 0 then c_name when c_custkey % 5 = 1 then ' ' end title, case when c_custkey % 4 = 0 then '[]' when c_custkey % 4 = 1 then '[1]' end pub_types from customer) "


def _look(spark, sf_dir):
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    t = lambda a, x: F.concat(F.lit(a), x.cast("string"))
    b = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(s % 3 != 0, t("p", s)).alias("pmcid"), F.when(s % 4 != 0, t("m", s)).alias("pmid"), t("d", s).alias("doi"), F.col("s_name").alias("label"), F.when(s % 2 == 0, t("c", s)).alias("confidence"))
    p = read(spark, sf_dir, "customer").select("c_custkey", F.when(c % 2 == 0, t("p", c % 150)).alias("pmcid"), F.when(c % 3 == 0, t("m", c % 140)).alias("pmid"), t("d", c % 130).alias("doi"), F.when(c % 5 == 0, F.col("c_name")).when(c % 5 == 1, " ").alias("title"), F.when(c % 4 == 0, "[]").when(c % 4 == 1, "[1]").alias("pub_types"))
    return b, p


def _flat(b, *columns):
    return b.select(F.explode(F.array("pmcid", "pmid", "doi")).alias("value"), *columns).where("value is not null")


@query("label_by_column", _LOOK + "select c_custkey, coalesce(x.label, y.label, z.label) existing_label, coalesce(x.confidence, y.confidence, z.confidence) existing_confidence from p left join b x on x.pmcid = p.pmcid left join b y on y.pmid = p.pmid left join b z on z.doi = p.doi")
def label_by_column(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    return cascades.by_column(p.select("c_custkey", "pmcid", "pmid", "doi"), _flat(b, "label", "confidence"), ["pmcid", "pmid", "doi"], ["label", "confidence"]).select("c_custkey", "existing_label", "existing_confidence")


@query("licence_cascade", _LOOK + "select c_custkey, case when y.pmid is not null then case when y.s_suppkey % 2 = 0 then '' else 'cc-by' end when z.doi is not null then 'cc0' when p.pmid is not null and c_custkey % 6 = 0 then 'old' end license, case when y.pmid is not null then 'Y' when z.doi is not null then 'N' when p.pmid is not null and c_custkey % 6 = 0 then 'Y' end epmc_is_open_access, y.pmid is not null or z.doi is not null or (p.pmid is not null and c_custkey % 6 = 0) license_checked from p left join b y on y.pmid = p.pmid left join (select * from b where s_suppkey < 50) z on z.doi = p.doi")
def licence_cascade(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    fetched = b.where("pmid is not null").select(F.lit("pmid").alias("kind"), F.col("pmid").alias("value"), F.when(F.col("s_suppkey") % 2 == 0, "").otherwise("cc-by").alias("license"), F.lit("Y").alias("flag")).union(b.where("s_suppkey < 50").select(F.lit("doi"), "doi", F.lit("cc0"), F.lit("N")))
    legacy = p.where("c_custkey % 6 = 0 and pmid is not null").select("pmid", F.lit("old").alias("license"), F.lit("Y").alias("flag"))
    out = cascades.licences(p.select("c_custkey", "pmid", "pmcid", "doi"), fetched, legacy)
    return out.select("c_custkey", "license", "epmc_is_open_access", "license_checked")


@query("id_completion", _LOOK + ", f as (select coalesce(pmid, pmcid) q, pmid, pmcid, doi from b where s_suppkey % 5 > 0) select c_custkey, coalesce(p.pmid, x.pmid, y.pmid) pmid, coalesce(p.pmcid, case when x.q is null then y.pmcid else x.pmcid end) pmcid from (select c_custkey, pmid, pmcid from p) p left join f x on x.q = p.pmid left join f y on y.q = p.pmcid")
def id_completion(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    found = b.where("s_suppkey % 5 > 0").select(F.coalesce("pmid", "pmcid").alias("query_id"), "pmid", "pmcid")
    return cascades.complete_ids(p.select("c_custkey", "pmid", "pmcid"), found, ["pmid", "pmcid"])


@query("doi_fill", _LOOK + "select c_custkey, case when trim(coalesce(title, '')) = '' then coalesce(b.label, title) else title end title from p left join b on b.doi = p.doi")
def doi_fill(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    patch = b.select(F.col("doi").alias("value"), F.col("label").alias("title"))
    return cascades.fill(p.select("c_custkey", "doi", "title"), patch, F.trim("doi"), ["title"]).select("c_custkey", "title")


@query("canonical_enrichment", _LOOK + "select c_custkey, case when trim(coalesce(title, '')) = '' then coalesce(case when x.pmcid is not null then x.label when y.pmid is not null then y.label else z.label end, title) else title end title, case when trim(coalesce(pub_types, '')) in ('', '[]') then coalesce(case when x.pmcid is not null then x.confidence when y.pmid is not null then y.confidence else z.confidence end, pub_types) else pub_types end pub_types from p left join b x on x.pmcid = p.pmcid left join b y on y.pmid = p.pmid left join b z on z.doi = p.doi")
def canonical_enrichment(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    patch = _flat(b, F.col("label").alias("title"), F.col("confidence").alias("pub_types"))
    return cascades.fill_cascade(p, "c_custkey", patch, ["pmcid", "pmid", "doi"], ["title", "pub_types"], ("pub_types",)).select("c_custkey", "title", "pub_types")


@query("append_new_candidates", _LOOK + ", n as (select * from p where (pmcid is null or pmcid not in (select pmcid from b where pmcid is not null)) and (pmid is null or pmid not in (select pmid from b where pmid is not null)) and doi not in (select doi from b)), o as (select coalesce('pmcid:' || pmcid, 'pmid:' || pmid, 'doi:' || doi) k, min(c_custkey) c_custkey from n group by 1) select doi, null::bigint c_custkey from b union all select doi, c_custkey from o join p using (c_custkey)")
def append_new_candidates(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    keys = ["pmcid", "pmid", "doi"]
    known = b.select(*keys, F.lit(None).cast("long").alias("c_custkey"))
    return cascades.appended(known, p.select(*keys, "c_custkey"), keys, "c_custkey").select("doi", "c_custkey")


@query("pool_repairs", _LOOK + ", one as (select c_custkey, case when trim(coalesce(title, '')) = '' then coalesce(b.label, title) else title end title, pub_types, p.pmid from p left join b on b.doi = p.doi), two as (select c_custkey, one.title, case when trim(coalesce(pub_types, '')) = '' then coalesce(b.confidence, pub_types) else pub_types end pub_types from one left join b on b.pmid = one.pmid) select 'doi' step, 'title' as \"column\", count(*) filter (where trim(coalesce(title, '')) <> '') filled from one union all select 'pmid', 'pub_types', count(*) filter (where trim(coalesce(pub_types, '')) <> '') from two")
def pool_repairs(spark, sf_dir):
    b, p = _look(spark, sf_dir)
    first = b.select(F.col("doi").alias("value"), F.col("label").alias("title"))
    second = b.where("pmid is not null").select(F.col("pmid").alias("value"), F.col("confidence").alias("pub_types"))
    return cascades.repaired(p, [("doi", first, "doi", ["title"]), ("pmid", second, "pmid", ["pub_types"])])[1]

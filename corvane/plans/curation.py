"""Queries of reviews, merges and repairs on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text
from corvane.operators import merging, reviews
from corvane.plans.catalog import query
from corvane.session import read


# ---- reviews ----
@query("second_review", "with e as (select user_id doc_id, arg_max(event_type, (ts, event_id)) a, arg_max(v, (ts, event_id)) filter (where v is not null) b from (select *, case when value >= 20 then value end v from events) group by 1) select l.doc_id, quality, a second_event_type, b second_v from labels l left join e using (doc_id)")
def second_review(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("v", F.when(F.col("value") >= 20, F.col("value"))).withColumnRenamed("user_id", "doc_id")
    return reviews.second_review(read(spark, sf_dir, "labels").select("doc_id", "quality"), e, "doc_id", ["ts", "event_id"], ["event_type", "v"])


@query("resolution_override", "with r as (select user_id doc_id, arg_max(case event_type when 'purchase' then 1 when 'error' then 0 end, (ts, event_id)) x from events where event_type in ('purchase', 'error') group by 1) select doc_id, coalesce(x, quality)::int quality, coalesce(x <> quality, false) overridden from labels left join r using (doc_id)")
def resolution_override(spark, sf_dir):
    verdict = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", 0)
    r = read(spark, sf_dir, "events").withColumn("verdict", verdict).where("verdict is not null").groupBy(F.col("user_id").alias("doc_id")).agg(F.max_by("verdict", F.struct("ts", "event_id")).alias("verdict"))
    return reviews.resolved(read(spark, sf_dir, "labels").select("doc_id", "quality"), r, "doc_id", "quality", "verdict")


_DECISIONS = {"A": "lexicon", "R": "exclusionary"}


@query("term_decisions", "with d as (select l_suppkey, arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber, l_returnflag)) d from lineitem group by 1) select s_name, case d when 'A' then 'lexicon' when 'R' then 'exclusionary' end list, case when d in ('A', 'R') then 'decided' else 'pending' end review_status from supplier left join d on s_suppkey = l_suppkey")
def term_decisions(spark, sf_dir):
    log = read(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    s = reviews.term_status(read(spark, sf_dir, "supplier"), log, "s_suppkey", "l_returnflag", ["l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag"], _DECISIONS)
    return s.select("s_name", "list", "review_status")


@query("decision_counts", "select l_returnflag decision, count(*) n from lineitem group by 1")
def decision_counts(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("decision")).agg(F.count("*").alias("n"))


@query("blind_sample", "with r as (select doc_id, quality, row_number() over (partition by quality order by md5(doc_id || ':7'), doc_id) r from labels) select doc_id, quality from r where (quality = 1 and r <= 20) or (quality = 0 and r <= 15)")
def blind_sample(spark, sf_dir):
    """A sampling operator: 20 rows of one label and 15 of the other, in an order both engines draw alike."""
    return reviews.blind_sample(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality", {1: 20, 0: 15}, 7)


@query("diversified_pool", "with d as (select doc_id, source, lang, md5(doc_id || ':3') h from documents), n as (select ceil(60.0 / count(*)) cap from (select distinct source, lang from d)), r as (select *, row_number() over (partition by source, lang order by h, doc_id) r from d) select doc_id, source, lang from r, n where r <= cap order by h, doc_id limit 60")
def diversified_pool(spark, sf_dir):
    return reviews.diversified(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["source", "lang"], 60, "doc_id", 3)


@query("verdict_cache", "with l as (select user_id, arg_max(event_type, (ts, event_id)) = 'purchase' found, arg_max(ts, (ts, event_id)) seen from events group by 1), c as (select max(ts) - interval 5 day cut from events) select user_id, found from l, c where found or seen >= cut")
def verdict_cache(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    newest = e.agg(F.max("ts").alias("newest"))
    e = e.crossJoin(F.broadcast(newest))  # one row
    # the age counts, so that one cutoff serves all rows
    aged = e.withColumn("age", -(F.unix_micros(F.col("newest").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))))
    return reviews.live_verdicts(aged, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", "age", F.lit(-5 * 86_400_000_000))


@query("run_status", "with e as (select event_type, epoch_us(ts) / 1e6 t from events), m as (select max(t) now from e) select event_type, count(*) done, count(*) filter (where t > now - 86400) recent, round(greatest(2000 - count(*), 0) * 86400 / 60.0 / nullif(count(*) filter (where t > now - 86400), 0), 3) minutes_left, any_value(now) - max(t) > 180 stalled from e, m group by event_type")
def run_status(spark, sf_dir):
    return reviews.run_status(read(spark, sf_dir, "events"), "event_type", "ts", 2000, window=86400)


@query("fetch_completeness", "with f as (select year(o_orderdate)::int y, count(*) n, count(k) m from orders left join (select distinct l_orderkey k from lineitem) on o_orderkey = k group by 1) select y as \"year\", n expected, m fetched, round(abs(m - n) / n, 6) gap, abs(m - n) / n <= 0.002 complete from f")
def fetch_completeness(spark, sf_dir):
    have = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("have", F.lit(1))
    f = read(spark, sf_dir, "orders").join(have, "o_orderkey", "left").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("expected"), F.count("have").alias("fetched"))
    return reviews.incomplete(f, "fetched", "expected")


# ---- merges ----
_RANK = {"N": 1, "R": 2}


@query("best_record", "select l_orderkey, arg_min(l_linenumber, (p, -l_extendedprice, id)) l_linenumber, arg_min(l_extendedprice, (p, -l_extendedprice, id)) l_extendedprice from (select *, case l_returnflag when 'N' then 1 when 'R' then 2 else 3 end p, (l_linenumber, l_partkey, l_suppkey) id from lineitem) group by 1")
def best_record(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_extendedprice", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("id"))
    return merging.best_record(li, "l_orderkey", _RANK, "l_returnflag", "l_extendedprice", "id").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("source_union", "with o as (select user_id, event_type, (value >= 20)::int m, min(event_id) f from events group by all) select user_id, string_agg(event_type || ':' || m || '@' || f, ';' order by event_type, m) sources from o group by 1")
def source_union(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("m", (F.col("value") >= 20).cast("int"))
    s = merging.merged_sources(e, "user_id", "event_type", "m", "event_id")
    one = F.transform("sources", lambda x: F.concat(x["event_type"], F.lit(":"), x["m"], F.lit("@"), x["first"]))
    return s.select("user_id", F.array_join(one, ";").alias("sources"))


@query("preferred_hosts", "with l as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'id' || (l_partkey % 3) link, l_returnflag host from lineitem), p as (select *, case host when 'R' then 1 when 'N' then 2 else 3 end p from l) select l_orderkey, l_linenumber, l_partkey, l_suppkey, arg_min(host, (p, host)) over (partition by l_orderkey, upper(link)) host from p")
def preferred_hosts(spark, sf_dir):
    k = F.col("l_partkey") % 3
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.when(F.col("l_linenumber") > 3, "ID").otherwise("id"), k).alias("link"), F.col("l_returnflag").alias("host"))
    return merging.preferred_hosts(li, "l_orderkey", "link", "host", ["R", "N"]).drop("link")


@query("conflict_rows", "with c as (select doc_id, quality, n_chars from labels join documents using (doc_id)) select * from c where n_chars in (select n_chars from c group by 1 having min(quality) <> max(quality))")
def conflict_rows(spark, sf_dir):
    c = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", "quality", "n_chars")
    return merging.conflicts(c, "n_chars", "quality")


@query("repair_provenance", "with o as (select distinct o_custkey k from orders where o_orderpriority = '1-URGENT'), e as (select distinct user_id k from events where event_type = 'purchase'), j as (select c_custkey, case when o.k is not null then 'urgent' end a, case when e.k is not null then 'bought' end b from customer left join o on o.k = c_custkey left join e on e.k = c_custkey) select c_custkey, concat_ws(';', a, b) touched, coalesce(a, b) as \"primary\" from j")
def repair_provenance(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    e = read(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    return merging.provenance(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", {"urgent": o, "bought": e})


@query("duplicate_plan", "with g as (select md5(lower(text)) k, count(*) n, min(doc_id) keeper, min(lang) <> max(lang) a, min(source) <> max(source) b, count(lang) x, count(source) y from documents group by 1 having count(*) > 1) select k, keeper, n - 1 losers, case when coalesce(a, false) or coalesce(b, false) then 'conflicting' when (x > 0 and x < n) or (y > 0 and y < n) then 'mergeable' else 'identical' end kind, concat_ws(';', case when a then 'lang' end, case when b then 'source' end) disputed from g")
def duplicate_plan(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5(F.lower("text")).alias("k"))
    return merging.duplicate_plan(d, "k", "doc_id", ["lang", "source"])


@query("lexicon_cleanup", """with p as (select distinct p_name, p_type from part), t as (select 'positive' list, p_name term, 'a' || p_name ord from p union select 'positive', upper(p_name), 'b' || p_name from p union select 'positive', split_part(p_name, ' ', 1), 'c' || split_part(p_name, ' ', 1) from p union select 'negative', split_part(p_name, ' ', 2), 'd' || split_part(p_name, ' ', 2) from p union select 'negative', split_part(p_name, ' ', 1), 'e' || split_part(p_name, ' ', 1) from p union select 'negative', left(p_type, 2), 'f' || left(p_type, 2) from p),
n as (select *, lower(trim(term)) norm, min(ord) over (partition by list, lower(trim(term))) first from t), w as (select distinct list, unnest(string_split(norm, ' ')) norm from n where contains(norm, ' ')), b as (select norm, min(list) <> max(list) both_lists from n group by 1)
select list, term, ord, case when ord <> first then 'duplicate' when length(norm) < 3 then 'short' when norm <> 'small' and (list, norm) in (select (list, norm) from w) then 'subsumed' when both_lists then 'tension' else 'keep' end as action from n join b using (norm)""")
def lexicon_cleanup(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    one, two = (F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2))
    made = [("positive", F.col("p_name"), "a", F.col("p_name")), ("positive", F.upper("p_name"), "b", F.col("p_name")), ("positive", one, "c", one), ("negative", two, "d", two), ("negative", one, "e", one), ("negative", F.left("p_type", F.lit(2)), "f", F.left("p_type", F.lit(2)))]
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("list"), t.alias("term"), F.concat(F.lit(o), k).alias("ord")) for a, t, o, k in made]))
    return merging.clean_lexicon(p.select(rows.alias("t")).select("t.*").distinct(), ["small"])


@query("schema_migration", "select c_custkey, case when c_custkey % 2 = 0 then '1.1' else '0.9' end as version, case when c_custkey % 2 = 0 then 'unknown' end licence from customer")
def schema_migration(spark, sf_dir):
    version = F.when(F.col("c_custkey") % 2 == 0, "1.0").otherwise("0.9")
    c = read(spark, sf_dir, "customer").select("c_custkey", F.struct("c_name", version.alias("schema_version")).alias("doc"))
    return merging.migrate(c, "doc", "licence", F.lit("unknown"), ("1.0", "1.1")).select("c_custkey", F.col("doc.schema_version").alias("version"), F.col("doc.licence").alias("licence"))


# ---- reports and text ----
@query("licence_coverage", "select source, count(*) n, count(quality) looked_up, round(100.0 * count(quality) / count(*), 4) coverage_pct, count(*) filter (where quality = 1) open from documents left join labels using (doc_id) group by 1")
def licence_coverage(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count("quality").alias("looked_up"), F.round(100.0 * F.count("quality") / F.count("*"), 4).alias("coverage_pct"), F.count_if(F.col("quality") == 1).alias("open"))


@query("ledger_cross_check", "select y::int as \"year\" from (select unnest(range(1990, 2000)) y) where y not in (select year(o_orderdate) from orders)")
def ledger_cross_check(spark, sf_dir):
    ledger = spark.range(1990, 2000, 1, 1).select(F.col("id").cast("int").alias("year"))
    return ledger.join(read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct(), "year", "left_anti")


@query("batch_predicate", "select p_partkey, p_brand from part where p_brand = 'Brand#7' or starts_with(p_brand, 'Brand#1')")
def batch_predicate(spark, sf_dir):
    return read(spark, sf_dir, "part").where(text.in_batch(F.col("p_brand"), ["Brand#7"], ["Brand#1"])).select("p_partkey", "p_brand")


@query("blinded_rows", "select doc_id, text, lang from documents")
def blinded_rows(spark, sf_dir):
    """What a reviewer may see: neither source nor any label."""
    return read(spark, sf_dir, "documents").select("doc_id", "text", "lang")


@query("excluded_kinds", "select user_id, array_to_string(list_sort(list_filter(list(distinct upper(event_type)), lambda v: lower(v) in ('error', 'purchase'))), ';') hits from events group by 1")
def excluded_kinds(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.upper("event_type")).alias("kinds"))  # a handful of kinds
    return e.select("user_id", F.array_join(F.array_sort(text.members(F.col("kinds"), ["Error", "Purchase"])), ";").alias("hits"))


@query("prompt_digest", "select doc_id, md5('Title: ' || coalesce(source, '') || chr(10) || 'Language: ' || coalesce(lang, '') || chr(10) || coalesce(text, '')) digest from documents")
def prompt_digest(spark, sf_dir):
    prompt = text.rendered("Title: {source}\nLanguage: {lang}\n{text}", source=F.col("source"), lang=F.col("lang"), text=F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(prompt).alias("digest"))


@query("rationale", "select doc_id, concat_ws('; ', 'from ' || source, case when quality = 1 then 'confirmed by a curator' when quality = 0 then 'rejected by a curator' end, case when toxic = 1 then 'flagged' end) why from documents left join labels using (doc_id)")
def rationale(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    verdict = F.when(F.col("quality") == 1, "confirmed by a curator").when(F.col("quality") == 0, "rejected by a curator")
    return d.select("doc_id", F.concat_ws("; ", F.concat(F.lit("from "), "source"), verdict, F.when(F.col("toxic") == 1, "flagged")).alias("why"))

"""Queries of reports, queues, repairs and link rules on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.operators import audits, joins, queues
from corvane.plans.catalog import query
from corvane.session import read

_SCREEN = "case when n_chars >= 2000 then 1 when n_chars >= 300 then 0 end"


def _screen():
    """A second opinion on quality; null where it abstains."""
    return F.when(F.col("n_chars") >= 2000, 1).when(F.col("n_chars") >= 300, 0)


def _opinions(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", "quality", "toxic", "n_chars", _screen().alias("other"))


_OPINIONS = f"with o as (select d.doc_id, d.source, l.quality, l.toxic, d.n_chars, {_SCREEN} other from documents d join labels l using (doc_id)) "


# ---- joins of verdicts ----
@query("run_comparison", "with a as (select user_id, arg_max(event_type, (ts, event_id)) x from events where event_id % 2 = 0 group by user_id), b as (select user_id, arg_max(event_type, (ts, event_id)) x from events where event_id % 2 = 1 group by user_id) select user_id, a.x class_a, b.x class_b, a.x = b.x agree from a join b using (user_id)")
def run_comparison(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("class"), "ts", "event_id")
    return audits.compare_runs(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "class", ["ts", "event_id"])


@query("disagreement_queue", _OPINIONS + "select doc_id, quality, other from o where other is not null and other <> quality and doc_id % 10 <> 3")
def disagreement_queue(spark, sf_dir):
    o = _opinions(spark, sf_dir)
    seen = o.where("doc_id % 10 = 3").select("doc_id")
    return queues.disagreements(o, seen, "doc_id", "quality", "other").select("doc_id", "quality", "other")


@query("cross_tier_buckets", _OPINIONS + ", c as (select case when other is null then 'undecided' when quality = other and other = 1 - toxic then 'all_agree' when quality = other then 'first_two' when other = 1 - toxic then 'last_two' else 'outer_two' end bucket from o), b as (select unnest(['all_agree', 'first_two', 'last_two', 'outer_two', 'undecided']) bucket) select bucket, count(c.bucket) n from b left join c using (bucket) group by bucket")
def cross_tier_buckets(spark, sf_dir):
    o = _opinions(spark, sf_dir).withColumn("third", 1 - F.col("toxic"))
    return audits.tier_buckets(o, "quality", "other", "third")


@query("known_identifier_split", "select p_partkey, s_suppkey holder, s_suppkey is null is_new from part left join (select lower(s_name) k, min(s_suppkey) s_suppkey from supplier group by 1) on k = lower('Supplier#' || lpad(p_partkey::varchar, 9, '0'))")
def known_identifier_split(spark, sf_dir):
    new = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("SUPPLIER#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("name"))
    return joins.known_holder(new, read(spark, sf_dir, "supplier"), "name", "s_name", "s_suppkey").select("p_partkey", "holder", "is_new")


@query("star_join", "with e as (select user_id, arg_max(event_type, (ts, event_id)) filter (where event_type <> 'error') last_type from events group by user_id), o as (select o_custkey, count(*) n_orders, max(o_orderdate) last_order from orders group by 1) select c_custkey, n_name, last_type, coalesce(n_orders, 0) n_orders, last_order from customer join nation on c_nationkey = n_nationkey left join e on user_id = c_custkey left join o on o_custkey = c_custkey")
def star_join(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.join(e, "c_custkey", "left").join(o, "c_custkey", "left").select("c_custkey", "n_name", "last_type", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "last_order")


# ---- reports ----
@query("coverage_by_year", "with c as (select year(o_orderdate)::int y, count(*) filter (where o_orderkey % 3 = 0) kept, count(*) pool from orders group by 1), y as (select unnest(range(1990, 2002))::int y) select y as \"year\", coalesce(kept, 0) kept, coalesce(pool, 0) pool, round(100.0 * kept / pool, 4) coverage_pct from y left join c using (y)")
def coverage_by_year(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 3 == 0).alias("kept"))
    return audits.coverage(o, "year", F.col("kept"), range(1990, 2002))


@query("duplicate_audit", "with g as (select user_id, count(*) n, count(distinct event_type) k from events group by 1) select sum(n)::bigint as \"rows\", count(*) ids, (sum(n) - count(*))::bigint excess, count(*) filter (where n > 1 and k = 1) repeated_same, count(*) filter (where k > 1) repeated_other, max(n) most from g")
def duplicate_audit(spark, sf_dir):
    return audits.duplicates(read(spark, sf_dir, "events"), "user_id", "event_type")


@query("repeat_distribution", "select n repeats, count(*) ids from (select count(*) n from events group by user_id) group by n")
def repeat_distribution(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("repeats")).groupBy("repeats").agg(F.count("*").alias("ids"))


@query("positive_rate_comparison", _OPINIONS + "select source = 'src0' as population, count(*) n, round(avg(quality), 6) rate from o group by 1")
def positive_rate_comparison(spark, sf_dir):
    return _opinions(spark, sf_dir).groupBy((F.col("source") == "src0").alias("population")).agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("rate"))


@query("canonical_or_novel", "select case when event_type in ('click', 'view', 'purchase') then 'canonical' else 'novel' end as kind, count(distinct event_type) as terms, count(*) as uses from events group by 1")
def canonical_or_novel(spark, sf_dir):
    return audits.seed_share(read(spark, sf_dir, "events"), "event_type", ["click", "view", "purchase"])


@query("violation_stats", "with v as (select user_id, unnest(list_filter([case when value is null or value < 10 then 'value:low' end, case when event_type = 'error' then 'type:error' end, case when value > 90 then 'value:high' end], lambda x: x is not null)) x from events) select split_part(x, ':', 1) field, count(*) n, count(distinct user_id) users from v group by 1")
def violation_stats(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    v = F.array_compact(F.array(F.when(F.col("value").isNull() | (F.col("value") < 10), "value:low"), F.when(F.col("event_type") == "error", "type:error"), F.when(F.col("value") > 90, "value:high")))
    return audits.by_prefix(e.withColumn("violations", v), "violations", "user_id").withColumnRenamed("ids", "users")


@query("spend_check", "select round(sum(coalesce(case when event_id % 3 = 0 then value end, case when event_id % 3 = 1 then value end, 0)), 4) spent, round(sum(coalesce(case when event_id % 3 = 0 then value end, case when event_id % 3 = 1 then value end, 0)), 4) > 1000 over_cap from events")
def spend_check(spark, sf_dir):
    i, v = F.col("event_id") % 3, F.col("value")
    return audits.spend(read(spark, sf_dir, "events").select(F.when(i == 0, v).alias("actual"), F.when(i == 1, v).alias("estimated")), "actual", "estimated", 1000)


@query("token_profile", "select event_type, count(*) n, round(avg(value), 3) mean_tokens, greatest(round(arg_max(value, (ts, event_id)), 4), 50.0) planning_rate from events group by 1")
def token_profile(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    last = F.greatest(F.round(F.max_by("value", F.struct("ts", "event_id")), 4), F.lit(50.0))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 3).alias("mean_tokens"), last.alias("planning_rate"))


@query("score_band_summary", _OPINIONS + "select floor(n_chars / 500)::bigint as band, min(n_chars) lo, max(n_chars) hi, count(*) total, count(*) filter (where quality = 1) confirmed from o group by 1")
def score_band_summary(spark, sf_dir):
    return _opinions(spark, sf_dir).groupBy(F.floor(F.col("n_chars") / 500).alias("band")).agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"), F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("confirmed"))


@query("confirmed_diversity", _OPINIONS + "select quality, count(distinct source) sources, count(*) n, min(source) first_source from o group by 1")
def confirmed_diversity(spark, sf_dir):
    return _opinions(spark, sf_dir).groupBy("quality").agg(F.countDistinct("source").alias("sources"), F.count("*").alias("n"), F.min("source").alias("first_source"))


@query("release_figures", "select count(*) n, count(*) filter (where event_type = 'purchase') purchases, max(ts)::varchar last_ts, count(distinct event_type) kinds from events")
def release_figures(spark, sf_dir):
    last = F.date_format(F.max("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    micro = F.regexp_replace(F.date_format(F.max("ts").cast("timestamp_ntz"), ".SSSSSS"), r"\.?0*$", "")
    return read(spark, sf_dir, "events").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.concat(last, micro).alias("last_ts"), F.countDistinct("event_type").alias("kinds"))


@query("provenance_category", "select case when source in ('src0', 'src1') then 'registry' when lang is null then 'unknown' when doc_id % 5 = 0 then 'curated' else 'bulk' end category, count(*) n from documents group by 1")
def provenance_category(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    category = F.when(F.col("source").isin("src0", "src1"), "registry").when(F.col("lang").isNull(), "unknown").when(F.col("doc_id") % 5 == 0, "curated").otherwise("bulk")
    return d.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


# ---- queues ----
@query("review_queue", "select p_partkey, p_size, p_retailprice from part where (p_size >= 40 or p_retailprice >= 1500 or p_size <= 2) and p_partkey not in (select l_partkey from lineitem where l_quantity = 50) order by p_size desc, p_partkey limit 25")
def review_queue(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    decided = read(spark, sf_dir, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return queues.review(p, decided, "p_partkey", (F.col("p_size") >= 40) | (F.col("p_retailprice") >= 1500) | (F.col("p_size") <= 2), [F.desc("p_size"), F.asc("p_partkey")], 25)


@query("custom_order", "select event_type, count(*) n, coalesce(array_position(['purchase', 'view', 'click'], event_type), 4)::int place from events group by 1")
def custom_order(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return queues.placed(e, "event_type", ["purchase", "view", "click"], "place").orderBy("place", "event_type")


@query("done_aware_limit", "with w as (select c_custkey, c_custkey in (select o_custkey from orders) done from customer), r as (select *, row_number() over (partition by done order by c_custkey) r from w) select c_custkey, done from r where done or r <= 30")
def done_aware_limit(spark, sf_dir):
    done = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return queues.done_and_next(read(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey", 30)


@query("winner_per_group", "select p_brand, arg_max(p_partkey, (p_size, p_retailprice, -p_partkey)) winner from part group by 1")
def winner_per_group(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct("p_size", "p_retailprice", -F.col("p_partkey"))).alias("winner"))


@query("history_append", "with r as (select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) before from events) select user_id, count(*) filter (where before is not null and before <> event_type) superseded, max(event_id) last_event from r group by 1")
def history_append(spark, sf_dir):
    """Earlier states are kept as array elements where the next state differs."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, sf_dir, "events").withColumn("before", F.lag("event_type").over(w))
    kept = F.collect_list(F.when(F.col("before") != F.col("event_type"), F.struct("ts", F.col("before").alias("state"))))
    doc = e.groupBy("user_id").agg(F.sort_array(kept).alias("history"), F.max("event_id").alias("last_event"))
    return doc.select("user_id", F.size("history").cast("long").alias("superseded"), "last_event")


# ---- records ----
@query("freshness", "select event_id, ts < timestamp '2024-01-15' stale from events where event_type = 'error'")
def freshness(spark, sf_dir):
    return read(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", (F.col("ts").cast("timestamp_ntz") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).alias("stale"))


@query("content_digests", "select page_id, sha256(html) digest, length(html) chars from pages where html is not null")
def content_digests(spark, sf_dir):
    return read(spark, sf_dir, "pages").where("html is not null").select("page_id", F.sha2("html", 256).alias("digest"), F.length("html").cast("long").alias("chars"))

"""Queries of the record-curation operators on the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import ids, text
from corvane.operators import clusters, documents, evaluation, joins, latest, parsers, sampling
from corvane.plans.catalog import query
from corvane.session import read, table
from corvane.streaming.log import recent_rate

# ---- lexicon of the scoring queries ----
LEXICON = {"tion": 1.0, "ing": 0.75, "ment": 0.5, "sch": 0.5, "the": 0.25}
EXCLUDE = {"%%%": 1.5, "|": -0.5, "!!": 1.0}
QUERY = ["inthe", "reing", "reing", "ment", "hated", "toing", "esand"]

_SCORE_SQL = (
    "round("
    + " + ".join(f"case when contains(lower(text), '{t}') then {w} else 0.0 end" for t, w in sorted(LEXICON.items()))
    + " - 1.0 * ("
    + " + ".join(f"case when contains(lower(text), '{t}') then {abs(w)} else 0.0 end" for t, w in sorted(EXCLUDE.items()))
    + "), 6)"
)
_STOP = ", ".join(f"'{w}'" for w in text.STOPWORDS)
_TOKENS_SQL = f"list_filter(string_split_regex(lower(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[^a-zA-Z \\t\\n-]', ' ', 'g')), '[ \\t\\n]+'), lambda w: length(w) >= 3 and w not in ({_STOP}))"


def _scored(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", "source", F.round(evaluation.weighted_sum(F.col("text"), LEXICON, EXCLUDE), 6).alias("score"))


def _labelled(spark, sf_dir):
    return _scored(spark, sf_dir).join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


_LABELLED_SQL = f"with s as (select d.doc_id, d.source, {_SCORE_SQL} score, l.quality from documents d join labels l using (doc_id)) "


@query("relevance_flagship", _LABELLED_SQL + """, g as (select score, sum(quality) p, sum(1 - quality) q from s group by score),
c as (select score, sum(p) over w tp, sum(q) over w fp, (select sum(p) from g) np, (select sum(q) from g) nq from g window w as (order by score desc rows unbounded preceding)),
t as (select score threshold from c order by round(tp * 1.0 / np - fp * 1.0 / nq, 12) desc, score desc limit 1)
select source, count(*) n, count(*) filter (where score >= threshold) predicted, count(*) filter (where score >= threshold and quality = 1) tp, round(avg(score), 6) mean_score from s, t group by source""")
def relevance_flagship(spark, sf_dir):
    rows = table(_labelled(spark, sf_dir), "scored")  # read for the threshold and again for the counts
    t = evaluation.auroc_youden(rows, "score", "quality").select("threshold")
    up = F.col("score") >= F.col("threshold")
    j = rows.crossJoin(F.broadcast(t))  # one row
    return j.groupBy("source").agg(F.count("*").alias("n"), F.count_if(up).alias("predicted"), F.count_if(up & (F.col("quality") == 1)).alias("tp"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("weighted_sum", f"select doc_id, {_SCORE_SQL} score from documents")
def weighted_sum(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "score")


@query("matched_terms", "select doc_id, array_to_string(list_filter(['" + "', '".join(sorted(LEXICON)) + "'], lambda t: contains(lower(text), t)), ' ') terms from documents")
def matched_terms(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(evaluation.matched_terms(F.col("text"), sorted(LEXICON)), " ").alias("terms"))


_COUNTS_SQL = f"with d as (select doc_id, {_TOKENS_SQL} t from documents), z as (select doc_id, len(t) n from d), c as (select doc_id, term, count(*) tf from (select doc_id, unnest(t) term from d) group by all), df as (select term, count(*) df from c group by term), q as (select unnest({QUERY!r}) term), m as (select term, count(*) m from q group by term) "


@query("bm25", _COUNTS_SQL + """, i as (select term, ln((select count(*) from z) - df + 0.5) - ln(df + 0.5) idf from df), a as (select avg(idf) mean from i),
h as (select c.doc_id, sum(m * (case when idf < 0 then 0.25 * mean else idf end) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * z.n / (select avg(n) from z)))) score from c join m using (term) join i using (term) join z using (doc_id), a group by c.doc_id)
select z.doc_id, round(coalesce(score, 0.0), 6) score from z left join h using (doc_id)""")
def bm25(spark, sf_dir):
    return evaluation.bm25(read(spark, sf_dir, "documents"), "doc_id", "text", QUERY)


@query("tfidf_cosine", _COUNTS_SQL + """, n as (select count(*) + 1 n from z), i as (select df.term, ln((1.0 + n) / (1 + df + (case when m is null then 0 else 1 end))) + 1 idf from df left join m using (term), n),
w as (select term, m * coalesce(idf, ln((1.0 + n) / 2) + 1) w from m left join i using (term), n), l as (select sqrt(sum(w * w)) l from w),
s as (select c.doc_id, sum(coalesce(w.w / l, 0) * tf * idf) dot, sqrt(sum(tf * idf * tf * idf)) norm from c join i using (term) left join w using (term), l group by c.doc_id)
select z.doc_id, round(coalesce(dot / norm, 0.0), 6) score from z left join s using (doc_id)""")
def tfidf_cosine(spark, sf_dir):
    return evaluation.tfidf_cosine(read(spark, sf_dir, "documents"), "doc_id", "text", QUERY)


@query("discriminative_terms", f"""with d as (select doc_id, quality, {_TOKENS_SQL} t from documents join labels using (doc_id)), c as (select doc_id, term, count(*) tf from (select doc_id, unnest(t) term from d) group by all),
k as (select count(*) n, count(*) filter (where quality = 1) n1 from d), f as (select term, count(*) df from c group by term having count(*) >= 3 and count(*) <= 0.85 * (select n from k)),
w as (select doc_id, term, df, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) w from c join f using (term), k), m as (select doc_id, sqrt(sum(w * w)) m from w group by doc_id)
select term, any_value(df) document_frequency, round(coalesce(sum(case when quality = 1 then w / m end), 0.0) / any_value(greatest(1, n1)) - coalesce(sum(case when quality = 0 then w / m end), 0.0) / any_value(greatest(1, n - n1)), 6) discriminative_score
from w join m using (doc_id) join d using (doc_id), k group by term""")
def discriminative_terms(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return evaluation.discriminative_terms(d, "doc_id", "text", "quality")


@query("auroc_youden", _LABELLED_SQL + """, g as (select score, sum(quality) p, sum(1 - quality) q from s group by score), t as (select sum(p) np, sum(q) nq from g),
c as (select score, sum(p) over w / np tpr, sum(q) over w / nq fpr from g, t window w as (order by score desc rows unbounded preceding)),
e as (select *, coalesce(lag(fpr) over (order by score desc), 0) x0, coalesce(lag(tpr) over (order by score desc), 0) y0 from c)
select round(sum((fpr - x0) * (tpr + y0) / 2), 6) auroc, round(arg_max(score, (round(tpr - fpr, 12), score)), 6) threshold from e""")
def auroc_youden(spark, sf_dir):
    return evaluation.auroc_youden(_labelled(spark, sf_dir), "score", "quality")


@query("confusion_metrics", _LABELLED_SQL + """, c as (select count(*) filter (where score >= 1.5 and quality = 1) tp, count(*) filter (where score >= 1.5 and quality = 0) fp, count(*) filter (where score < 1.5 and quality = 1) fn, count(*) filter (where score < 1.5 and quality = 0) tn from s),
p as (select *, coalesce(tp / nullif(tp + fp, 0), 0) p, coalesce(tp / nullif(tp + fn, 0), 0) r from c) select tp, fp, fn, tn, round(p, 6) "precision", round(r, 6) recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) f1 from p""")
def confusion_metrics(spark, sf_dir):
    return evaluation.confusion(_labelled(spark, sf_dir), F.col("score") >= 1.5, "quality")


@query("score_label_correlation", _LABELLED_SQL + "select round(corr(score, quality), 6) r, round(avg(score), 6) mean from s")
def score_label_correlation(spark, sf_dir):
    return _labelled(spark, sf_dir).agg(F.round(F.corr("score", F.col("quality").cast("double")), 6).alias("r"), F.round(F.avg("score"), 6).alias("mean"))


# ---- logs ----
@query("latest_row_per_key", "select user_id, arg_max(event_id, (ts, event_id)) event_id, arg_max(event_type, (ts, event_id)) event_type from events group by user_id")
def latest_row_per_key(spark, sf_dir):
    return latest.latest_row(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("latest_nonnull_per_column", "select user_id, arg_max(event_type, (ts, event_id)) event_type, arg_max(v, (ts, event_id)) filter (where v is not null) v from (select *, case when event_type <> 'error' then value end v from events) group by user_id")
def latest_nonnull_per_column(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return latest.latest_values(e, "user_id", ["ts", "event_id"], ["event_type", "v"])


@query("latest_valid_by_ordinal", "select user_id, max(event_id) event_id, arg_max(event_type, event_id) event_type from events where event_type <> 'error' group by user_id")
def latest_valid_by_ordinal(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return latest.latest_valid(e, "user_id", ["event_id"], F.col("event_type") != "error")


@query("latest_then_drop_errors", "select * from (select user_id, arg_max(event_type, (ts, event_id)) event_type from events group by user_id) where event_type <> 'error'")
def latest_then_drop_errors(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return latest.latest_row(e, "user_id", ["ts", "event_id"]).where("event_type <> 'error'").select("user_id", "event_type")


@query("first_row_per_key", "select user_id, min(event_id) event_id, arg_min(value, event_id) value from events group by user_id")
def first_row_per_key(spark, sf_dir):
    return latest.first_row(read(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", ["event_id"])


@query("retry_audit", "select user_id, count(*) n_events, count(*) filter (where event_type = 'error') n_errors, bool_or(event_type = 'error') ever_failed, arg_max(event_type = 'error', event_id) still_failed from events group by user_id")
def retry_audit(spark, sf_dir):
    return latest.retry_audit(read(spark, sf_dir, "events"), "user_id", ["event_id"], F.col("event_type") == "error")


@query("resume_anti_join", "select c_custkey from customer where c_custkey not in (select user_id from events where event_type = 'purchase')")
def resume_anti_join(spark, sf_dir):
    done = read(spark, sf_dir, "events").withColumnRenamed("user_id", "c_custkey")
    return latest.not_done(read(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey", F.col("event_type") == "purchase")


@query("round_summary", "select event_type, date_trunc('day', ts)::date as day, count(*) n, round(sum(value), 4) total, min(event_id) first_id, max(event_id) last_id from events group by all")
def round_summary(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("conversation_latest_turn", "select conv_id, max(turn) turn, arg_max(role, turn) \"role\", arg_max(length(text), turn) n from conversations group by conv_id")
def conversation_latest_turn(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))
    return latest.latest_row(c, "conv_id", ["turn"])


@query("sliding_recent_rate", "select s as start, count(*) n from (select unnest(generate_series(date_trunc('minute', ts) - interval 4 minute, date_trunc('minute', ts), interval 1 minute)) s from events) group by s")
def sliding_recent_rate(spark, sf_dir):
    return recent_rate(read(spark, sf_dir, "events"), "ts").select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("peak_hours", "select event_id, ((hour(ts) >= 1 and hour(ts) < 4) or (hour(ts) >= 6 and hour(ts) < 10)) and isodow(ts) < 6 peak, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') stamp from events")
def peak_hours(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select("event_id", text.peak(F.col("ts")).alias("peak"), text.stamp(F.col("ts")).alias("stamp"))


# ---- joins ----
_KEYS_SQL = "with b as (select s_suppkey ord, case when s_suppkey % 3 <> 0 then s_suppkey * 10 end k1, case when s_suppkey % 4 <> 0 then s_suppkey * 10 + 1 end k2, case when s_suppkey % 5 <> 0 then s_suppkey * 10 + 2 end k3, round(s_acctbal, 2) bal from supplier), p as (select c_custkey, case when c_custkey % 2 = 0 then c_custkey end k1, case when c_custkey % 3 = 0 then c_custkey + 1 end k2, c_custkey + 2 k3 from customer) "


def _key_tables(spark, sf_dir):
    s, c = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    b = s.select(F.col("s_suppkey").alias("ord"), *[F.when(F.col("s_suppkey") % m != 0, F.col("s_suppkey") * 10 + i).alias(f"k{i + 1}") for i, m in enumerate((3, 4, 5))], F.round("s_acctbal", 2).alias("bal"))
    p = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("k1"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") + 1).alias("k2"), (F.col("c_custkey") + 2).alias("k3"))
    return b, p


@query("fallback_join_flat", _KEYS_SQL + ", v as (select value, arg_min(bal, (turn, ord)) bal from (select k1 as value, 0 turn, ord, bal from b union all select k2, 1, ord, bal from b union all select k3, 2, ord, bal from b) where value is not null group by value) select c_custkey, coalesce(v1.bal, v2.bal, v3.bal) bal, case when v1.bal is not null then 'k1' when v2.bal is not null then 'k2' when v3.bal is not null then 'k3' end matched_by from p left join v v1 on p.k1 = v1.value left join v v2 on p.k2 = v2.value left join v v3 on p.k3 = v3.value")
def fallback_join_flat(spark, sf_dir):
    b, p = _key_tables(spark, sf_dir)
    return joins.fallback_join(p, joins.flat_lookup(b, ["k1", "k2", "k3"], ["bal"], "ord"), ["k1", "k2", "k3"], ["bal"]).select("c_custkey", "bal", "matched_by")


@query("fallback_join_typed", _KEYS_SQL + "select c_custkey, coalesce(a.bal, c.bal, d.bal) bal from p left join b a on p.k1 = a.k1 left join b c on p.k2 = c.k2 left join b d on p.k3 = d.k3")
def fallback_join_typed(spark, sf_dir):
    b, p = _key_tables(spark, sf_dir)
    look = joins.typed_lookup(b, ["k1", "k2", "k3"], ["bal"], "ord")
    out = p
    for k in ("k1", "k2", "k3"):
        side = look.where(F.col("kind") == k).select(F.col("value").cast("long").alias(k), F.col("p.bal").alias(f"bal_{k}"))
        out = out.join(side, k, "left")
    return out.select("c_custkey", F.coalesce("bal_k1", "bal_k2", "bal_k3").alias("bal"))


@query("single_key_join", _KEYS_SQL + "select c_custkey, b.bal from (select c_custkey, coalesce(k1, k2, k3) k from p) p left join (select coalesce(k1, k2, k3) k, bal from b) b using (k)")
def single_key_join(spark, sf_dir):
    b, p = _key_tables(spark, sf_dir)
    k = F.coalesce("k1", "k2", "k3").alias("k")
    return p.select("c_custkey", k).join(b.select(k, "bal"), "k", "left").select("c_custkey", "bal")


@query("or_anti_join", _KEYS_SQL + ", v as (select unnest([k1, k2, k3]) v from b) select c_custkey from p where coalesce(k1 not in (select v from v where v is not null), true) and coalesce(k2 not in (select v from v where v is not null), true) and k3 not in (select v from v where v is not null)")
def or_anti_join(spark, sf_dir):
    b, p = _key_tables(spark, sf_dir)
    known = b.select(F.explode(F.array("k1", "k2", "k3")).alias("v")).where("v is not null")
    return joins.any_key_anti(p, known, ["k1", "k2", "k3"], "v").select("c_custkey")


@query("or_semi_join", _KEYS_SQL + ", v as (select distinct unnest([k1, k2, k3]) v from b) select c_custkey from p where exists (select 1 from v where v = k1 or v = k2 or v = k3)")
def or_semi_join(spark, sf_dir):
    b, p = _key_tables(spark, sf_dir)
    known = b.select(F.explode(F.array("k1", "k2", "k3")).alias("v")).where("v is not null")
    return joins.any_key_semi(p, known, "c_custkey", ["k1", "k2", "k3"], "v").select("c_custkey")


@query("fill_blank_merge", "select doc_id, case when lang is null or source = 'src1' then coalesce(case when doc_id % 2 = 0 then 'patched' end, case when source = 'src1' then '' else lang end) else lang end lang from documents")
def fill_blank_merge(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") == "src1", "").otherwise(F.col("lang")).alias("lang"))
    patch = read(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id", F.lit("patched").alias("lang"))
    return joins.fill_blank(d, patch, "doc_id", ["lang"], ids.blank)


@query("outer_presence_source", "select k, array_to_string(list_sort(list(distinct side)), '+') source from (select o_custkey k, 'orders' side from orders union all select user_id, 'events' from events union all select c_custkey, 'customer' from customer) group by k")
def outer_presence_source(spark, sf_dir):
    side = lambda t, c: read(spark, sf_dir, t).select(F.col(c).alias("k"))
    return joins.presence({"orders": side("orders", "o_custkey"), "events": side("events", "user_id"), "customer": side("customer", "c_custkey")}, "k")


@query("full_outer_build_diff", "with a as (select l_orderkey k, round(sum(l_quantity), 2) old_value from lineitem where l_returnflag <> 'R' group by 1), b as (select l_orderkey k, round(sum(l_quantity), 2) new_value from lineitem where l_linestatus = 'F' group by 1) select k, old_value, new_value, case when old_value is null then 'added' when new_value is null then 'removed' when old_value = new_value then 'same' else 'changed' end state from a full join b using (k)")
def full_outer_build_diff(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    build = lambda c: li.where(c).groupBy(F.col("l_orderkey").alias("k")).agg(F.round(F.sum("l_quantity"), 2).alias("v"))
    return joins.diff(build("l_returnflag <> 'R'"), build("l_linestatus = 'F'"), ["k"], "v")


@query("range_bucket", "with n as (select source, count(*) c from documents group by source) select case when c <= 40 then '1-40' when c <= 48 then '41-48' when c <= 60 then '49-60' else '61+' end bucket, count(*) sources, sum(c)::bigint docs from n group by 1")
def range_bucket(spark, sf_dir):
    n = read(spark, sf_dir, "documents").groupBy("source").count()
    b = F.when(F.col("count") <= 40, "1-40").when(F.col("count") <= 48, "41-48").when(F.col("count") <= 60, "49-60").otherwise("61+")
    return n.groupBy(b.alias("bucket")).agg(F.count("*").alias("sources"), F.sum("count").alias("docs"))


# ---- clusters ----
_CLUSTER_SQL = "with recursive r as (select c_custkey id, 'a' || (c_custkey // 3) a, case when c_custkey % 7 < 2 then 'b' || (c_custkey // 14) end b from customer), e as (select x.id i, y.id j from r x join r y on x.a = y.a or x.b = y.b), t as (select id, id as c from r union select t.id, e.j from t join e on e.i = t.c), m as (select id, min(c) cluster_id from t group by id) "


def _cluster_rows(spark, sf_dir):
    c = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(c.alias("id"), F.concat(F.lit("a"), F.floor(c / 3).cast("string")).alias("a"), F.when(c % 7 < 2, F.concat(F.lit("b"), F.floor(c / 14).cast("string"))).alias("b"), "c_name", "c_mktsegment", "c_acctbal")


@query("connected_components", _CLUSTER_SQL + "select id, cluster_id from m")
def connected_components(spark, sf_dir):
    return clusters.connected(_cluster_rows(spark, sf_dir), "id", ["a", "b"]).select("id", F.col("cluster").alias("cluster_id"))


@query("consolidate_clusters", _CLUSTER_SQL + "select cluster_id, count(*) n_rows, arg_min(c_name, id) c_name, array_to_string(list_sort(list(distinct c_mktsegment)), '|') segments, case when bool_or(c_acctbal > 5000) and bool_or(c_acctbal < 0) then 'conflict' when bool_or(c_acctbal > 5000) then 'positive' when bool_or(c_acctbal < 0) then 'negative' else 'unlabelled' end merged_label from m join customer on id = c_custkey group by cluster_id")
def consolidate_clusters(spark, sf_dir):
    rows = _cluster_rows(spark, sf_dir)
    rows = rows.join(clusters.connected(rows, "id", ["a", "b"]), "id").withColumnRenamed("cluster", "cluster_id")
    rows = rows.withColumns({"segments": F.array("c_mktsegment"), "label": F.when(F.col("c_acctbal") > 5000, "positive").when(F.col("c_acctbal") < 0, "negative")})
    one = clusters.consolidate(rows, "cluster_id", "id", ["c_name"], [], ["segments"])
    return one.withColumn("segments", F.array_join("segments", "|")).join(clusters.merged_label(rows, "cluster_id", "label"), "cluster_id")


@query("duplicate_groups", "select md5(lower(text)) \"key\", count(*) n, min(doc_id) keeper from documents group by 1 having count(*) > 1")
def duplicate_groups(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.md5(F.lower("text").cast("binary")).alias("h"))
    return clusters.duplicate_groups(d, "doc_id", "h")


# ---- agreement and profiles ----
@query("label_histogram", "select source, quality, count(*) n from documents left join labels using (doc_id) group by all")
def label_histogram(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left").groupBy("source", "quality").agg(F.count("*").alias("n"))


@query("kappa_agreement", "with s as (select quality a, case when toxic = 1 then 0 else 1 end b from labels where quality is not null and toxic is not null), n as (select count(*) n, avg(case when a = b then 1.0 else 0.0 end) po from s), x as (select sum(p * q) pe from (select a v, count(*) / any_value(n) p from s, n group by a) join (select b v, count(*) / any_value(n) q from s, n group by b) using (v)) select n n_scored, round(po, 6) accuracy, round((po - pe) / (1 - pe), 6) kappa from n, x")
def kappa_agreement(spark, sf_dir):
    lab = read(spark, sf_dir, "labels").select(F.col("quality").alias("a"), F.when(F.col("toxic") == 1, 0).otherwise(1).alias("b"))
    return evaluation.kappa(lab, "a", "b")


@query("kappa_by_source", "with s as (select source, quality a, case when n_chars > 1000 then 1 else 0 end b from labels join documents using (doc_id) where quality is not null), n as (select source, count(*) n, avg(case when a = b then 1.0 else 0.0 end) po from s group by source), x as (select source, sum(p * q) pe from (select source, a v, count(*) / any_value(n) p from s join n using (source) group by source, a) join (select source, b v, count(*) / any_value(n) q from s join n using (source) group by source, b) using (source, v) group by source) select source, n n_scored, round(po, 6) accuracy, round(case when coalesce(pe, 0) = 1 then 'nan'::double else (po - coalesce(pe, 0)) / (1 - coalesce(pe, 0)) end, 6) kappa from n left join x using (source)")
def kappa_by_source(spark, sf_dir):
    d = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id").select("source", F.col("quality").alias("a"), (F.col("n_chars") > 1000).cast("int").alias("b"))
    return evaluation.kappa(d, "a", "b", ["source"])


@query("crosstab", "select event_type, count(*) filter (where b = 'high') high, count(*) filter (where b = 'low') low from (select event_type, case when value > 10 then 'high' else 'low' end b from events) group by event_type")
def crosstab(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("b", F.when(F.col("value") > 10, "high").otherwise("low"))
    return e.groupBy("event_type").pivot("b", ["high", "low"]).count().na.fill(0, ["high", "low"])


@query("disagreement_breakdown", "select quality a, toxic b, count(*) n from labels where quality <> toxic group by all")
def disagreement_breakdown(spark, sf_dir):
    return read(spark, sf_dir, "labels").where("quality <> toxic").groupBy(F.col("quality").alias("a"), F.col("toxic").alias("b")).agg(F.count("*").alias("n"))


@query("reversal_buckets", "with o as (select unnest(['Reversed', 'Upheld', 'Neither']) bucket), c as (select case when quality = 1 and toxic = 1 then 'Reversed' when quality = 1 then 'Upheld' else 'Neither' end bucket, count(*) n from labels group by 1) select bucket, coalesce(n, 0) n from o left join c using (bucket)")
def reversal_buckets(spark, sf_dir):
    b = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "Reversed").when(F.col("quality") == 1, "Upheld").otherwise("Neither")
    names = spark.createDataFrame([("Reversed",), ("Upheld",), ("Neither",)], "bucket string")
    return names.join(read(spark, sf_dir, "labels").groupBy(b.alias("bucket")).agg(F.count("*").alias("n")), "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


@query("source_confirmation_rates", "select source, count(*) n, count(*) filter (where quality = 1) confirmed, round(avg(quality), 6) rate from documents join labels using (doc_id) group by source")
def source_confirmation_rates(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("confirmed"), F.round(F.avg("quality"), 6).alias("rate"))


@query("dense_year_pivot", "with y as (select unnest(range(1993, 2004)) y), c as (select year(o_orderdate) y, count(*) filter (where o_orderstatus = 'F') f, count(*) filter (where o_orderstatus = 'O') o, count(*) n from orders group by 1) select y::int as \"year\", coalesce(f, 0) f, coalesce(o, 0) o, round(f * 100.0 / nullif(n, 0), 6) pct_f from y left join c using (y)")
def dense_year_pivot(spark, sf_dir):
    c = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o"), F.count("*").alias("n"))
    spine = spark.range(1993, 2004, 1, 1).select(F.col("id").cast("int").alias("year"))
    return spine.join(c, "year", "left").select("year", F.coalesce("f", F.lit(0)).alias("f"), F.coalesce("o", F.lit(0)).alias("o"), F.round(F.col("f") * 100.0 / F.nullif(F.col("n"), F.lit(0)), 6).alias("pct_f"))


@query("quartile_accuracy_with_total", _LABELLED_SQL + ", e as (select list_distinct(quantile_cont(score, [0.25, 0.5, 0.75])) e from s), b as (select len(list_filter(e, lambda x: score > x))::int band, quality, score from s, e) select case when grouping(band) = 1 then 'All' else 'Q' || (band + 1) end quartile, count(*) n, round(avg(case when (score >= 1.5) = (quality = 1) then 1.0 else 0.0 end), 6) accuracy from b group by rollup (band)")
def quartile_accuracy_with_total(spark, sf_dir):
    b = sampling.quantile_bands(_labelled(spark, sf_dir), "score")
    right = ((F.col("score") >= 1.5) == (F.col("quality") == 1)).cast("double")
    return b.rollup("band").agg(F.grouping("band").alias("g"), F.count("*").alias("n"), F.round(F.avg(right), 6).alias("accuracy")).select(F.when(F.col("g") == 1, "All").otherwise(F.concat(F.lit("Q"), (F.col("band") + 1).cast("string"))).alias("quartile"), "n", "accuracy")


@query("strata_report", "with t as (select source from documents where source is not null group by source order by count(*) desc, source limit 5), e as (select list_distinct(quantile_cont(n_chars, [0.25, 0.5, 0.75])) e from documents), s as (select coalesce(t.source, 'other') grp, len(list_filter(e, lambda x: n_chars > x))::int band from documents d left join t using (source), e) select grp, band, count(*) available, least(count(*), 15) sampled from s group by all")
def strata_report(spark, sf_dir):
    d = sampling.quantile_bands(sampling.top_or_other(read(spark, sf_dir, "documents"), "source", 5, "grp"), "n_chars")
    return sampling.strata_report(d, ["grp", "band"], 15)


@query("value_frequencies", f"select term, count(*) n from (select unnest({_TOKENS_SQL}) term from documents) group by term order by n desc, term limit 25")
def value_frequencies(spark, sf_dir):
    t = read(spark, sf_dir, "documents").select(F.explode(text.tokens(F.col("text"))).alias("term"))
    return t.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(25)


@query("prefix_frequencies", "select split_part(o_orderpriority, '-', 1) prefix, count(*) n from orders group by 1")
def prefix_frequencies(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("prefix")).agg(F.count("*").alias("n"))


@query("completeness_report", "select count(*) n, count(*) filter (where text is null or trim(text) = '') blank_text, count(*) filter (where lang is null) no_lang, count(*) filter (where source = 'src0' and n_chars > 100) large_src0 from documents")
def completeness_report(spark, sf_dir):
    return read(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.count_if(ids.blank(F.col("text"))).alias("blank_text"), F.count_if(F.col("lang").isNull()).alias("no_lang"), F.count_if((F.col("source") == "src0") & (F.col("n_chars") > 100)).alias("large_src0"))


@query("set_jaccard", f"with t as (select doc_id, list_distinct({_TOKENS_SQL}) t from documents) select a.doc_id, round(case when len(a.t) + len(b.t) = 0 then 1.0 else len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) end, 6) jaccard from t a join t b on b.doc_id = a.doc_id + 1")
def set_jaccard(spark, sf_dir):
    t = read(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return t.join(t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u")), "doc_id").select("doc_id", F.round(text.jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"))


@query("offset_page", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey offset 40 limit 20")
def offset_page(spark, sf_dir):
    return sampling.page(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 40, 20)


# ---- strings ----
@query("clean_text", f"select doc_id, array_to_string({_TOKENS_SQL}, ' ') cleaned from documents")
def clean_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("html_to_text", "select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n]+', ' ', 'g'), ' ') plain from pages")
def html_to_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace(text.strip_tags(F.col("html")), "[ \t\n]+", " ")).alias("plain"))


@query("identifier_keys", "with k as (select o_orderkey, case when o_orderkey % 3 = 0 then 'PMC' || o_orderkey end pmcid, case when o_orderkey % 2 = 0 then '10.1000/x' || o_orderkey end doi, o_orderkey::varchar pmid from orders) select o_orderkey, coalesce('PMCID:' || pmcid, 'DOI:' || doi, 'PMID:' || pmid) \"key\", sha1(coalesce('PMCID:' || pmcid, 'DOI:' || doi, 'PMID:' || pmid)) record_id from k")
def identifier_keys(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, k.cast("string")).alias("pmcid"), F.when(k % 2 == 0, F.concat(F.lit("https://doi.org/10.1000/X"), k)).alias("doi"), F.concat(k, F.lit(".0")).alias("pmid"))
    key = ids.canonical_key(ids.clean_pmcid(F.col("pmcid")), ids.clean_doi(F.col("doi")), ids.clean_pmid(F.col("pmid")))
    return raw.select("o_orderkey", key.alias("key"), ids.record_id(key).alias("record_id"))


@query("year_parse", "select o_orderkey, year(o_orderdate)::int as \"year\" from orders")
def year_parse(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", text.year(F.concat(F.year("o_orderdate"), F.lit(".0"))).alias("year"))


@query("json_props", "select event_id, json_extract(props, '$.k')::int k from events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("answer_parser", "select event_id, case when event_id % 5 = 4 then 'parse_error' when event_type = 'error' then 'negative' else 'positive' end label from events")
def answer_parser(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    word = F.when(F.col("event_type") == "error", "negative").otherwise("positive")
    full = F.concat(F.lit('{"classification": "'), word, F.lit('"}'))
    i = F.col("event_id") % 5
    raw = F.when(i == 0, full).when(i == 1, F.concat(F.lit("<think>maybe undeterminable</think> "), full)).when(i == 2, F.concat(F.lit("Sure: "), full, F.lit(" done"))).when(i == 3, F.concat(F.lit("I say "), word, F.lit("."))).otherwise("no idea")
    return e.select("event_id", parsers.classification(raw).alias("label"))


# ---- documents and updates ----
@query("nested_document", "select o_orderkey, c_name as name, count(*) n_items, round(sum(l_extendedprice), 2) total, max(l_shipdate) last_ship from orders join customer on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey group by o_orderkey, c_name")
def nested_document(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_shipdate"))).alias("items"))
    docs = read(spark, sf_dir, "orders").join(items, "o_orderkey").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.struct("c_custkey", F.col("c_name").alias("name")).alias("customer"), "items")
    return docs.select("o_orderkey", "customer.name", F.size("items").cast("long").alias("n_items"), F.round(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["l_extendedprice"]), 2).alias("total"), F.array_max(F.transform("items", lambda x: x["l_shipdate"])).alias("last_ship"))


@query("conflict_fold", "with e as (select user_id doc_id, arg_max(case when event_type = 'purchase' then 1 when event_type = 'error' then 0 end, (ts, event_id)) filter (where event_type in ('purchase', 'error')) d from events group by user_id) select l.doc_id, case when d is null then quality::varchar when d = quality then quality::varchar else 'conflict' end label from labels l left join e using (doc_id)")
def conflict_fold(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", 0).alias("d"), "ts", "event_id")
    last = latest.latest_valid(e, "doc_id", ["ts", "event_id"], F.col("d").isNotNull()).select("doc_id", "d")
    q = F.col("quality").cast("string")
    return read(spark, sf_dir, "labels").join(last, "doc_id", "left").select("doc_id", F.when(F.col("d").isNull() | (F.col("d") == F.col("quality")), q).otherwise("conflict").alias("label"))


def _updates(spark, sf_dir):
    return read(spark, sf_dir, "customer").where("c_custkey % 7 = 0").select("c_custkey", F.upper("c_mktsegment").alias("c_mktsegment"), F.when(F.col("c_custkey") % 14 != 0, F.round(F.col("c_acctbal") + 1, 2)).otherwise(F.col("c_acctbal")).alias("c_acctbal"))


@query("allowlisted_update", "select c_custkey, case when c_custkey % 7 = 0 and c_custkey % 14 <> 0 then round(c_acctbal + 1, 2) else c_acctbal end c_acctbal, c_custkey % 7 = 0 and c_custkey % 14 <> 0 changed from customer")
def allowlisted_update(spark, sf_dir):
    return documents.apply_update(read(spark, sf_dir, "customer"), _updates(spark, sf_dir), "c_custkey", {"c_mktsegment", "c_acctbal"}).select("c_custkey", "c_acctbal", "changed")


@query("rollback_replay", "select c_custkey, c_name, c_mktsegment, c_acctbal from customer")
def rollback_replay(spark, sf_dir):
    target, allowed = read(spark, sf_dir, "customer"), {"c_mktsegment", "c_acctbal"}
    before = documents.snapshot(target, _updates(spark, sf_dir), "c_custkey")
    after = documents.apply_update(target, _updates(spark, sf_dir), "c_custkey", allowed).drop("changed")
    return documents.apply_update(after, before, "c_custkey", allowed).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("upsert_documents", "select p_partkey, case when p_partkey % 10 = 0 then 'refused' when p_partkey % 10 = 1 then 'inserted' when p_partkey % 10 = 2 then 'identical' else 'kept' end as action, p_size from part")
def upsert_documents(spark, sf_dir):
    p, k = read(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("p_partkey") % 10
    rows = p.where(k <= 2).withColumn("p_size", F.when(k == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return documents.upsert(p.where(k != 1), rows, "p_partkey")


@query("invariants", "select count(*) as rows, 'known_segment' as \"rule\", count(*) filter (where c_mktsegment not in ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')) violations from customer union all select count(*), 'positive_balance', count(*) filter (where not c_acctbal >= 0) from customer")
def invariants(spark, sf_dir):
    return documents.invariants(read(spark, sf_dir, "customer"), {"known_segment": F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"), "positive_balance": F.col("c_acctbal") >= 0})


# ---- sets ----
@query("set_difference", "select o_custkey k from orders except select user_id from events")
def set_difference(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).subtract(read(spark, sf_dir, "events").select("user_id"))


@query("set_intersection", "select o_custkey k from orders intersect select user_id from events")
def set_intersection(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).intersect(read(spark, sf_dir, "events").select("user_id"))


@query("covered_years", "select unnest(range(1990, 2005))::int as \"year\" except select year(o_orderdate)::int from orders")
def covered_years(spark, sf_dir):
    return spark.range(1990, 2005, 1, 1).select(F.col("id").cast("int").alias("year")).subtract(read(spark, sf_dir, "orders").select(F.year("o_orderdate")))

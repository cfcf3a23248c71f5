"""Queries of measures, text, windows, streams and user functions on the test tables, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvane.functions import ids, text
from corvane.operators import audits, evaluation, graphs, joins, queues, steps, vectors, windows
from corvane.plans.catalog import query
from corvane.plans.records import _COUNTS_SQL, _LABELLED_SQL, _TOKENS_SQL, QUERY, _labelled
from corvane.session import read, shared_dir, table
from corvane.streaming import log

EXCLUDED = ["theing", "und", "und"]
LEMMAS = {"ment": "men", "tions": "tion", "the": "a", "ing": "in"}


# ---- text ----
def _decoded(x: str) -> str:
    """SQL of one pass over the entities that the pages have."""
    for entity, sign in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{entity};?', '{sign}', 'g')"
    return x


def _passes(x: str, n: int) -> str:
    return x if not n else _passes(f"case when regexp_matches({x}, '&(#[0-9]+|[A-Za-z][A-Za-z0-9]*);') then {_decoded(x)} else {x} end", n - 1)


@query("html_unescaped_titles", f"with t as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) t0 from pages), a as (select page_id, {_passes('t0', 1)} t1 from t), b as (select page_id, {_passes('t1', 1)} t2 from a) select page_id, {_passes('t2', 1)} title from b")
def html_unescaped_titles(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.unescape(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("uuid5_keys", "with h as (select o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('PMID:' || o_orderkey)) h from orders) select o_orderkey, concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], printf('%02x', ((('0x' || h[17:18])::int & 63) | 128)) || h[19:20], h[21:32]) pid from h")
def uuid5_keys(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", ids.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.concat(F.lit("PMID:"), F.col("o_orderkey"))).alias("pid"))


_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({}, ''), lambda c: ord(c)::bigint)), lambda acc, c: list_reduce(list_prepend(xor(acc, c), list_transform(range(8), lambda i: i::bigint)), lambda a, i: case when a & 1 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end)), 4294967295::bigint)"


@query("crc_shards", f"select o_orderkey, {_CRC.format('o_orderkey::varchar')} % 8 shard from orders")
def crc_shards(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", text.shard_of(F.col("o_orderkey").cast("string"), 8).alias("shard"))


@query("strip_formatting", "select p_partkey, case p_partkey % 9 when 0 then 'a ' || p_name || ' z' when 1 then 'a ' || p_name || ' z' when 2 then 'snake_case_name ' || p_name when 3 then 'x ' || p_name when 4 then 'Head ' || p_name || chr(10) || 'see ' || p_name when 5 then 'quote' || chr(10) || p_name when 6 then 'x < ' || p_name || ' & y' when 7 then 'meta analysis 2  3  4' else '' end plain from part")
def strip_formatting(spark, sf_dir):
    n, c = F.col("p_name"), F.concat
    made = [c(F.lit("a **"), n, F.lit("** z")), c(F.lit("a *"), n, F.lit("* z")), c(F.lit("snake_case_name _"), n, F.lit("_")), c(F.lit("x `"), n, F.lit("`")), c(F.lit("## Head "), n, F.lit("\nsee ["), n, F.lit("](http://x.y)")), c(F.lit("> quote\n>"), n), c(F.lit("x &lt; "), n, F.lit(" &amp; y")), F.lit("meta-analysis 2 * 3 * 4"), F.lit(None).cast("string")]
    raw = F.get(F.array(*made), (F.col("p_partkey") % 9).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", text.strip_formatting(raw).alias("plain"))


@query("jats_text", "select p_partkey, case p_partkey % 4 when 0 then p_name || ' < 5' when 1 then 'Background ' || p_name end abstract from part")
def jats_text(spark, sf_dir):
    n = F.col("p_name")
    raw = F.get(F.array(F.concat(F.lit("<jats:p>"), n, F.lit("</jats:p>\n  &lt; 5")), F.concat(F.lit("<jats:title>Background</jats:title><p>"), n, F.lit("</p>")), F.lit("<b> Abstract </b>"), F.lit(None).cast("string")), (F.col("p_partkey") % 4).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", text.jats_text(raw).alias("abstract"))


_LEMMA_SQL = "case " + " ".join(f"when w = '{a}' then '{b}'" for a, b in LEMMAS.items()) + " else w end"


@query("clean_text_lemmas", f"select doc_id, array_to_string(list_transform({_TOKENS_SQL}, lambda w: {_LEMMA_SQL}), ' ') cleaned from documents")
def clean_text_lemmas(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text"), lemma=text.dictionary(LEMMAS)).alias("cleaned"))


_NOUN = "case when regexp_matches(w, '(ss|us|is)$') then w when regexp_matches(w, '(sses|shes|ches|xes|zes)$') then w[:-3] when regexp_matches(w, '[^aeiou]ies$') then w[:-4] || 'y' when regexp_matches(w, 'yses$') then w[:-3] || 'is' when regexp_matches(w, '[a-z]{2,}s$') then w[:-2] else w end"
_VERB = "case when regexp_matches(w, '[^aeiou]ied$') then w[:-4] || 'y' when regexp_matches(w, '[a-z]{3,}ed$') then w[:-3] when regexp_matches(w, '[a-z]{3,}ing$') then w[:-4] else w end"
_LEMMA_TOKENS = f"list_transform(list_filter(regexp_extract_all(lower(coalesce({{}}, '')), '[\\p{{{{L}}}}\\p{{{{N}}}}_]+'), lambda w: regexp_matches(w, '^[a-z]+$')), lambda w: case when ({_NOUN}) <> w then {_NOUN} else {_VERB} end)".replace("{2,}", "{{2,}}").replace("{3,}", "{{3,}}")


@query("lemma_tokens", f"select conv_id, turn, md5(array_to_string({_LEMMA_TOKENS.format('text')}, ' ')) lemmas from conversations")
def lemma_tokens(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.array_join(text.lemma_tokens(F.col("text")), " ").cast("binary")).alias("lemmas"))


@query("non_methods_flags", f"with t as (select doc_id, ' ' || array_to_string({_LEMMA_TOKENS.format('text')}, ' ') || ' ' w, case when doc_id % 4 = 0 then 'review' when doc_id % 4 = 1 then 'editorial' end kind from documents) select doc_id, contains(w, ' of the ') or contains(w, ' the ') or coalesce(kind = 'editorial', false) flagged, concat_ws('|', case when contains(w, ' of the ') then 'of the' end, case when contains(w, ' the ') then 'the' end) text_hits, case when kind = 'editorial' then 'Editorial' else '' end type_hits from t")
def non_methods_flags(spark, sf_dir):
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents").withColumns({"w": text.lemma_tokens(F.col("text")), "types": F.when(k % 4 == 0, F.array(F.lit("Article"))).when(k % 4 == 1, F.array(F.lit("Editorial"), F.lit(None).cast("string")))})
    hits = F.array_compact(F.array(*[F.when(text.contains_sequence(F.col("w"), p), p) for p in ("of the", "the", "no such phrase")]))
    kinds = text.members(F.col("types"), ["editorial", "letter"])
    return d.select("doc_id", hits.alias("h"), kinds.alias("t")).select("doc_id", ((F.size("h") > 0) | (F.size("t") > 0)).alias("flagged"), F.array_join("h", "|").alias("text_hits"), F.array_join("t", "|").alias("type_hits"))


_NAMES = "with t as (select distinct lower(trim(string_split(text, ' ')[2])) term from benchmark where trim(string_split(text, ' ')[2]) <> '') "


@query("substring_theta_match", _NAMES + "select term, count(*) n, min(doc_id) first_id from documents join t on contains(lower(text), term) group by term")
def substring_theta_match(spark, sf_dir):
    terms = read(spark, sf_dir, "benchmark").select(F.get(F.split("text", " "), F.lit(1)).alias("term"))
    hits = joins.containing(read(spark, sf_dir, "documents"), "text", terms, "term", "doc_id")
    return hits.groupBy("term").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("regex_evidence", "with p as (select unnest(['email', 'phone', 'url', 'never']) as name, unnest(['[a-z0-9.]+@[a-z0-9.]+', '[(][0-9]{3}[)] [0-9]{3}-[0-9]{4}', 'https?://', 'zzzzzz']) rx), h as (select name, doc_id from documents, p where regexp_matches(text, rx)) select name, count(doc_id) n, count(doc_id) >= 10 enough, coalesce(array_to_string(list_sort(list(doc_id))[1:5], ','), '') examples from p left join h using (name) group by name")
def regex_evidence(spark, sf_dir):
    rules = {"email": "[a-z0-9.]+@[a-z0-9.]+", "phone": "[(][0-9]{3}[)] [0-9]{3}-[0-9]{4}", "url": "https?://", "never": "zzzzzz"}
    return audits.evidence(read(spark, sf_dir, "documents"), "doc_id", "text", rules, 10).withColumn("examples", F.array_join("examples", ","))


@query("tag_count_buckets", "with c as (select event_type, case when json_extract_string(props, '$.k')::int % 5 = 0 then 0 else least(json_extract_string(props, '$.k')::int % 5, 3) end b from events) select event_type, count(*) filter (where b = 0) n0, count(*) filter (where b = 1) n1, count(*) filter (where b = 2) n2, count(*) filter (where b = 3) n3_up from c group by 1")
def tag_count_buckets(spark, sf_dir):
    k = F.from_json("props", "k int")["k"] % 5
    e = read(spark, sf_dir, "events").select("event_type", F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>")).alias("tags"))
    return audits.tag_counts(e, "event_type", "tags")


@query("threshold_sweep", "with t as (select unnest([0, 1000, 5000]) a, b from (select unnest([0.0, 0.5, 1.0]) b)) select a::bigint min_chars, b::double min_quality, count(*) filter (where n_chars >= a and quality >= b) remaining from documents join labels using (doc_id), t group by all")
def threshold_sweep(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return audits.sweep(d, {"min_chars": ("n_chars", [0, 1000, 5000]), "min_quality": ("quality", [0.0, 0.5, 1.0])})


# ---- agreement ----
_SEEN = "with r as (select event_id, user_id id, case when event_type = 'error' then 'parse_error' when value > 20 then 'undeterminable' when event_type in ('purchase', 'click') then 'positive' else 'negative' end verdict, case when quality = 1 then 'positive' when quality = 0 then 'negative' else 'undeterminable' end \"label\", case when event_id % 2 = 0 then 'first' else 'second' end tier, year(ts)::int yr, event_type source, toxic from events join labels on doc_id = user_id) "


def _seen(spark, sf_dir):
    e = read(spark, sf_dir, "events").join(read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "user_id"), "user_id")
    kind = F.col("event_type")
    verdict = F.when(kind == "error", "parse_error").when(F.col("value") > 20, "undeterminable").when(kind.isin("purchase", "click"), "positive").otherwise("negative")
    label = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").otherwise("undeterminable")
    return e.select("event_id", F.col("user_id").alias("id"), verdict.alias("verdict"), label.alias("label"), F.when(F.col("event_id") % 2 == 0, "first").otherwise("second").alias("tier"), F.year("ts").alias("yr"), kind.alias("source"), "toxic")


def _kappa_sql(rows: str, label: str) -> str:
    return f"(select tier, count(*) n_total, count(*) filter (where verdict <> 'parse_error') n_scored, count(*) filter (where verdict = 'parse_error') n_parse_error, count(*) filter (where verdict = 'undeterminable') u, count(*) filter (where verdict in ('positive', 'negative')) n_decided, count(*) filter (where verdict in ('positive', 'negative') and verdict = {label}) r, count(*) filter (where verdict <> 'parse_error' and verdict = {label}) s, " + ", ".join(f"count(*) filter (where verdict <> 'parse_error' and {label} = '{v}') * count(*) filter (where verdict = '{v}') {v}" for v in ("positive", "negative", "undeterminable")) + f" from {rows} group by tier)"


_MEASURED = "n_total, n_scored, n_parse_error, round(u / n_scored, 6) undetermined_rate, n_decided, round(r / n_decided, 6) accuracy_among_decided, round((s / n_scored - (positive + negative + undeterminable) / (n_scored * n_scored)) / (1 - (positive + negative + undeterminable) / (n_scored * n_scored)), 6) kappa"


@query("agreement_by_tier", _SEEN + f"select tier, {_MEASURED} from {_kappa_sql('r', chr(34) + 'label' + chr(34))}")
def agreement_by_tier(spark, sf_dir):
    return evaluation.agreement(_seen(spark, sf_dir), "label", "verdict", ("positive", "negative", "undeterminable"), by=["tier"])


@query("kappa_before_after_review", _SEEN + ", q as (select *, case when toxic = 1 then 'negative' else \"label\" end final from r) select 'original' stage, tier, kappa from (select tier, " + _MEASURED + f" from {_kappa_sql('q', chr(34) + 'label' + chr(34))}) union all select 'reviewed', tier, kappa from (select tier, {_MEASURED} from {_kappa_sql('q', 'final')})")
def kappa_before_after_review(spark, sf_dir):
    r = _seen(spark, sf_dir)
    after = r.withColumn("label", F.when(F.col("toxic") == 1, "negative").otherwise(F.col("label")))
    one = lambda d, s: evaluation.agreement(d, "label", "verdict", ("positive", "negative", "undeterminable"), by=["tier"]).select(F.lit(s).alias("stage"), "tier", "kappa")
    return one(r, "original").union(one(after, "reviewed"))


@query("prior_criteria_hash", "select 'h1' prior")
def prior_criteria_hash(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.lit("t").alias("tier"), F.when(F.col("event_type") == "error", "check").otherwise("primary").alias("mode"), F.when(F.col("event_type") == "error", "h0").when(F.col("event_id") % 2 == 0, "h1").otherwise("h2").alias("hash"))
    return spark.createDataFrame([(steps.prior_hash(e, read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id", "t", "h2"),)], "prior string")


@query("population_run_join", _SEEN + ", l as (select id, arg_max(verdict, event_id) verdict, any_value(\"label\") as \"label\" from r where tier = 'first' group by id) select \"label\", verdict, count(*) n from l group by all")
def population_run_join(spark, sf_dir):
    """The population with its latest verdict of one tier."""
    last = _seen(spark, sf_dir).where("tier = 'first'").groupBy("id").agg(F.max_by("verdict", "event_id").alias("verdict"), F.first("label").alias("label"))
    return last.groupBy("label", "verdict").agg(F.count("*").alias("n"))


@query("fallback_accuracy", _SEEN + "select count(*) n, round(avg(case when verdict = \"label\" then 1.0 else 0.0 end), 6) accuracy from r where source = 'view' and verdict <> 'parse_error'")
def fallback_accuracy(spark, sf_dir):
    r = _seen(spark, sf_dir).where("source = 'view' and verdict <> 'parse_error'")
    return r.agg(F.count("*").alias("n"), F.round(F.avg((F.col("verdict") == F.col("label")).cast("double")), 6).alias("accuracy"))


@query("population_report", _SEEN + ", w as (select id, \"label\", max(verdict) filter (where tier = 'first') a, max(verdict) filter (where tier = 'second') b from r group by all), s as (select source, count(distinct id) n, round(avg(case when \"label\" = verdict then 1.0 else 0.0 end), 6) rate from r group by 1) select 'labels' as \"table\", \"label\" as \"key\", count(distinct id) n from r group by all union all select 'years', yr || '|' || \"label\", count(distinct id) from r group by all union all select 'disagreements', tier || '|' || \"label\" || '|' || verdict, count(*) from r where \"label\" <> verdict group by all union all select 'consensus', case when a = b and a = \"label\" then 'all_agree' when a = b then 'tiers_agree' when a is null or b is null then 'one_tier' else 'tiers_differ' end, count(*) from w group by 2 union all select 'agreement', tier, count(*) from r group by tier union all select 'sources', source, n from s")
def population_report(spark, sf_dir):
    report = steps.population_report(_seen(spark, sf_dir), "label", "verdict", "tier", "yr", "source")
    report["agreement"] = report["agreement"].select("tier", "n_total")
    report["sources"] = report["sources"].drop("rate")
    return steps.long_form(report)


@query("enrichment_agreement", f"with t as (select doc_id, list_distinct({_TOKENS_SQL}) t from documents), p as (select a.t a, b.t b from t a join t b on b.doc_id = a.doc_id + 1), j as (select len(a) + len(b) = 0 both_empty, list_sort(a) = list_sort(b) same, case when len(a) + len(b) = 0 then 1.0 else len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) end x from p) select count(*) n, count(*) filter (where same) exact, count(*) filter (where both_empty) both_empty, round(avg(x), 6) mean_jaccard from j")
def enrichment_agreement(spark, sf_dir):
    t = read(spark, sf_dir, "documents").select("doc_id", F.array_distinct(text.tokens(F.col("text"))).alias("a"))
    pairs = t.join(t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b")), "doc_id")
    return audits.list_agreement(pairs, "a", "b")


@query("score_distribution", "select doc_id, score from (select doc_id, case when doc_id % 3 = 0 then 'x' when doc_id % 3 = 1 then (n_chars / 2.0)::varchar end s, try_cast(case when doc_id % 3 = 0 then 'x' when doc_id % 3 = 1 then (n_chars / 2.0)::varchar end as double) score from documents) where score is not null")
def score_distribution(spark, sf_dir):
    k = F.col("doc_id")
    raw = F.when(k % 3 == 0, "x").when(k % 3 == 1, (F.col("n_chars") / 2.0).cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", raw.try_cast("double").alias("score")).where("score is not null")


@query("cost_projection", "with c as (select avg(value) tokens, count(*) n from events where event_type = 'view') select n, round(tokens, 4) mean_tokens, round(tokens * 1000 * 0.002, 4) projected from c")
def cost_projection(spark, sf_dir):
    return audits.projection(read(spark, sf_dir, "events").where("event_type = 'view'"), "value", 1000, 0.002)


@query("round_rollup", "with g as (select event_type, (ts::date) as d, case when event_id % 2 = 0 then 'm1' else 'm2' end m, count(*) n, min(ts) lo, max(ts) hi from events group by all) select event_type, sum(n)::bigint n, count(distinct d) as days, array_to_string(list_sort(list(distinct m)), '+') models, sum(n) filter (where m = 'm1')::bigint n_m1 from g group by 1")
def round_rollup(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumns({"d": F.to_date("ts"), "m": F.when(F.col("event_id") % 2 == 0, "m1").otherwise("m2")})
    g = e.groupBy("event_type", "d", "m").agg(F.count("*").alias("n"))
    return g.groupBy("event_type").agg(F.sum("n").alias("n"), F.countDistinct("d").alias("days"), F.array_join(F.array_sort(F.collect_set("m")), "+").alias("models"), F.sum(F.when(F.col("m") == "m1", F.col("n"))).alias("n_m1"))


@query("candidate_lexicon", "with a as (select distinct p_type term from part), b as (select distinct p_brand term from part where p_size > 25 union select 'ECONOMY'), s as (select unnest(['ECONOMY', 'SMALL', 'seed only']) term), j as (select coalesce(a.term, b.term) term, a.term is not null x, b.term is not null y from a full join b using (term)) select term, concat_ws('+', case when x then 'tfidf' end, case when y then 'phrases' end, case when s.term is not null then 'seed' end) source from j left join s using (term) union all select term, 'seed' from s where term not in (select term from j)")
def candidate_lexicon(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    seed = spark.createDataFrame([("ECONOMY",), ("SMALL",), ("seed only",)], "term string")
    second = p.where("p_size > 25").select(F.col("p_brand").alias("term")).union(seed.where("term = 'ECONOMY'"))
    return queues.lexicon(p.select(F.col("p_type").alias("term")), second, seed)


# ---- scores ----
@query("quantile_precision", _LABELLED_SQL + ", t as (select unnest([0.5, 0.75, 0.9]) quantile, unnest(quantile_cont(score, [0.5, 0.75, 0.9])) cut from s) select quantile, round(cut, 6) cut, count(*) filter (where score >= cut) n, round(avg(case when score >= cut then quality end), 6) \"precision\", round(sum(case when score >= cut then quality else 0 end) / sum(quality), 6) recall from s, t group by quantile, cut")
def quantile_precision(spark, sf_dir):
    return evaluation.at_quantiles(_labelled(spark, sf_dir), "score", "quality", [0.5, 0.75, 0.9])


_MINUS = _COUNTS_SQL.replace("with d as", f"with ex as (select unnest({EXCLUDED!r}) term), xm as (select term, count(*) x from ex group by term), d as", 1)


@query("bm25_with_exclusions", _MINUS + """, i as (select term, ln((select count(*) from z) - df + 0.5) - ln(df + 0.5) idf from df), a as (select avg(idf) mean from i), u as (select term, coalesce(m, 0) - 0.5 * coalesce(x, 0) m from m full join xm using (term)),
h as (select c.doc_id, sum(u.m * (case when idf < 0 then 0.25 * mean else idf end) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * z.n / (select avg(n) from z)))) score from c join u using (term) join i using (term) join z using (doc_id), a group by c.doc_id)
select z.doc_id, round(coalesce(score, 0.0), 6) score from z left join h using (doc_id)""")
def bm25_with_exclusions(spark, sf_dir):
    return evaluation.bm25(read(spark, sf_dir, "documents"), "doc_id", "text", QUERY, EXCLUDED, 0.5)


@query("tfidf_two_documents", _MINUS + """, n as (select count(*) + 2 n from z), i as (select df.term, ln((1.0 + n) / (1 + df + (case when m is null then 0 else 1 end) + (case when x is null then 0 else 1 end))) + 1 idf from df left join m using (term) left join xm using (term), n),
w as (select term, m * coalesce(idf, ln((1.0 + n) / (2 + (case when xm.term is null then 0 else 1 end))) + 1) w from m left join i using (term) left join xm using (term), n), l as (select sqrt(sum(w * w)) l from w),
v as (select term, x * coalesce(idf, ln((1.0 + n) / (2 + (case when m.term is null then 0 else 1 end))) + 1) v from xm left join i using (term) left join m using (term), n), k as (select sqrt(sum(v * v)) k from v),
s as (select c.doc_id, sum((coalesce(w.w / l, 0) - 0.5 * coalesce(v.v / k, 0)) * tf * idf) dot, sqrt(sum(tf * idf * tf * idf)) norm from c join i using (term) left join w using (term) left join v using (term), l, k group by c.doc_id)
select z.doc_id, round(coalesce(dot / norm, 0.0), 6) score from z left join s using (doc_id)""")
def tfidf_two_documents(spark, sf_dir):
    return evaluation.tfidf_cosine(read(spark, sf_dir, "documents"), "doc_id", "text", QUERY, EXCLUDED, 0.5)


@query("discriminative_ngrams", f"""with d as (select doc_id, quality, {_TOKENS_SQL} t from documents join labels using (doc_id)), g as (select doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]), list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) term from d), c as (select doc_id, term, count(*) tf from g group by all),
k as (select count(*) n, count(*) filter (where quality = 1) n1 from d), f as (select term, count(*) df, sum(tf) a from c group by term having count(*) >= 3 and count(*) <= 0.85 * (select n from k) order by a desc, term limit 1500),
w as (select doc_id, term, df, (1 + ln(tf)) * (ln((1.0 + n) / (1 + df)) + 1) w from c join f using (term), k), m as (select doc_id, sqrt(sum(w * w)) m from w group by doc_id)
select term, any_value(df) document_frequency, round(coalesce(sum(case when quality = 1 then w / m end), 0.0) / any_value(greatest(1, n1)) - coalesce(sum(case when quality = 0 then w / m end), 0.0) / any_value(greatest(1, n - n1)), 6) discriminative_score
from w join m using (doc_id) join d using (doc_id), k group by term""")
def discriminative_ngrams(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return evaluation.discriminative_terms(d, "doc_id", "text", "quality", grams=3, features=1500)


def _bake(name: str, scored: str) -> str:
    return f"""select '{name}' scorer, b.*, round(p, 6) "precision", round(r, 6) recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) f1, round(c, 6) correlation from
(with s as ({scored}), g as (select score, sum(quality) p, sum(1 - quality) q from s group by score), t as (select sum(p) np, sum(q) nq from g), c as (select score, sum(p) over w / np tpr, sum(q) over w / nq fpr from g, t window w as (order by score desc rows unbounded preceding)), e as (select *, coalesce(lag(fpr) over (order by score desc), 0) x0, coalesce(lag(tpr) over (order by score desc), 0) y0 from c) select round(sum((fpr - x0) * (tpr + y0) / 2), 6) auroc, round(arg_max(score, (round(tpr - fpr, 12), score)), 6) threshold from e) b,
(select corr(score, quality) c from ({scored})) k, lateral (select count(*) filter (where score >= threshold and quality = 1) / nullif(count(*) filter (where score >= threshold), 0) p, count(*) filter (where score >= threshold and quality = 1) / nullif(count(*) filter (where quality = 1), 0) r from ({scored})) m"""


@query("scorer_bake_off", _MINUS + """, j as (select doc_id, text, quality from documents join labels using (doc_id)), i0 as (select 1), ws as (select doc_id, quality, round((select sum(case when contains(lower(text), term) then 1.0 else 0.0 end) from m) - 0.5 * (select sum(case when contains(lower(text), term) then 1.0 else 0.0 end) from xm), 6) score from j) """ + _bake("weighted_sum", "select * from ws"))
def scorer_bake_off(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return evaluation.bake_off(d, "doc_id", "text", "quality", QUERY, EXCLUDED, 0.5, {"weighted_sum": evaluation.SCORERS["weighted_sum"]})


@query("key_phrases", "with e as (select vec_id, label, embedding::double[] v, sqrt(list_dot_product(embedding::double[], embedding::double[])) n from embeddings), c as (select d.vec_id doc, x.vec_id cand, 'p' || x.vec_id phrase, round(list_dot_product(d.v, x.v) / (d.n * x.n), 9) s, x.v, x.n from e d join e x on x.label = d.label and x.vec_id % 7 = 3 where d.vec_id % 50 = 0), a as (select doc, arg_max(cand, (s, -ascii(phrase))) f from (select doc, cand, phrase, s, row_number() over (partition by doc order by s desc, phrase) r from c) where r = 1 group by doc), f as (select a.doc, c.phrase, c.s, c.v, c.n from a join c on c.doc = a.doc and c.cand = a.f), g as (select c.doc, c.phrase, c.s, row_number() over (partition by c.doc order by round(0.5 * c.s - 0.5 * list_dot_product(list_transform(f.v, lambda x: x / f.n), list_transform(c.v, lambda x: x / c.n)), 9) desc, c.phrase) r from c join f on f.doc = c.doc and f.phrase <> c.phrase) select doc, 1::int place, phrase, s score from f union all select doc, 2, phrase, s from g where r = 1")
def key_phrases(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    docs = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("doc"), F.col("embedding").alias("vector"), "label")
    c = e.where("vec_id % 7 = 3").select(F.concat(F.lit("p"), "vec_id").alias("phrase"), F.col("embedding").alias("vector"), "label")
    return evaluation.key_phrases(docs.select("doc", "vector"), docs.select("doc", "label").join(c, "label").select("doc", "phrase", "vector"), "doc", 2)


@query("cosine_topk", "with q as (select vec_id query_id, embedding::double[] q from embeddings where vec_id % 100 = 0), s as (select query_id, vec_id, list_dot_product(q, embedding::double[]) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(embedding::double[], embedding::double[]))) score from q, embeddings where vec_id <> query_id), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) select query_id, rank::int rank, vec_id, round(score, 6) score from r where rank <= 3")
def cosine_topk(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return vectors.top_k(e, e.where("vec_id % 100 = 0"), 3).withColumn("score", F.round("score", 6))


@query("nearest_ancestor", "with recursive p as (select p_partkey id, unnest([p_partkey // 3, p_partkey // 2 + 1]) up, unnest([0, 1]) turn from part where p_partkey > 10), t as (select p_partkey id, p_partkey up, 0 depth, []::int[] path from part union all select t.id, p.up, depth + 1, list_append(path, turn) from t join p on p.id = t.up where t.up > 10 and depth < 12), h as (select id, up, depth, path from t where up <= 10 and up % 3 = 1) select id, arg_min(up, (depth, path)) ancestor, min(depth) depth from h group by id")
def nearest_ancestor(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(k.alias("id"), F.when(k > 10, F.array(F.floor(k / 3), F.floor(k / 2) + 1)).otherwise(F.array().cast("array<bigint>")).alias("parents"))
    return graphs.nearest_ancestor(p, p.where("id <= 10 and id % 3 = 1"))


# ---- windows ----
def _ledger(spark, sf_dir):
    """A year window for each region's number from 2018 and two index windows; one year ends early."""
    r = read(spark, sf_dir, "region").select(F.lit("q").alias("query"), F.lit("year").alias("kind"), F.make_date(F.col("r_regionkey") + 2018, F.lit(1), F.lit(1)).alias("date_from"), F.make_date(F.col("r_regionkey") + 2018, F.when(F.col("r_regionkey") == 2, 6).otherwise(12), F.when(F.col("r_regionkey") == 2, 30).otherwise(31)).alias("date_to"), F.lit(5).cast("long").alias("fetched"), F.lit("2023-02-01").cast("date").alias("fetched_at"))
    return r


@query("missing_search_years", "select unnest([2015, 2016, 2017, 2020, 2023])::int as \"year\"")
def missing_search_years(spark, sf_dir):
    return windows.missing_years(_ledger(spark, sf_dir), 2015, "2023-05-01")


@query("index_window_plan", "select '2023-02-01' since, '2023-01-01' future_from, '2023-03-01' next_since, null::varchar next_future, true gap_refused, true never_refused")
def index_window_plan(spark, sf_dir):
    ledger = _ledger(spark, sf_dir)
    since, future = windows.plan_index(ledger, 2018, "2023-03-05")
    one = spark.createDataFrame([("q", "index", 9)], "query string, kind string, fetched long").select("query", "kind", F.lit("2023-02-01").cast("date").alias("date_from"), F.lit("2023-03-01").cast("date").alias("date_to"), "fetched", F.lit("2023-03-05").cast("date").alias("fetched_at"))
    after = windows.recorded(windows.recorded(ledger, one), one)
    again, none = windows.plan_index(after, 2018, "2023-04-01")

    def refused(**kw) -> bool:
        try:
            windows.plan_index(**kw)
            return False
        except windows.Refused:
            return True

    return spark.createDataFrame([(since, future, again, none, refused(ledger=after, first=2018, up_to="2023-04-01", since="2023-03-20"), refused(ledger=after, first=2010, up_to="2023-04-01"))], "since string, future_from string, next_since string, next_future string, gap_refused boolean, never_refused boolean")


@query("search_queries", "select '(\"a b\" OR c) AND (FIRST_PDATE:[2020-01-01 TO 2020-12-31]) AND (SRC:MED OR SRC:PPR)' year_query, '(\"a b\" OR c) AND (FIRST_IDATE:[2020-01-01 TO 2020-02-01] OR FIRST_PDATE:[2021-01-01 TO 3000-12-31]) AND (SRC:MED OR SRC:PPR)' index_query, true same_hash, false other_hash, sha256('{\"combine\": \"OR\", \"date_field\": \"FIRST_PDATE\", \"sources\": [\"MED\", \"PPR\"], \"terms\": [\"\\\"a b\\\"\", \"c\"]}') hash")
def search_queries(spark, sf_dir):
    space = {"terms": ['"a b"', "c"], "sources": ["MED", "PPR"]}
    turned = {"terms": ["c", '"a b"'], "sources": ["PPR", "MED"], "combine": "OR"}
    row = (windows.year_query(space, "2020-01-01", "2020-12-31"), windows.index_query(space, "2020-01-01", "2020-02-01", "2021-01-01"), windows.space_hash(space) == windows.space_hash(turned), windows.space_hash(space) == windows.space_hash(space | {"combine": "AND"}), windows.space_hash(space))
    return spark.createDataFrame([row], "year_query string, index_query string, same_hash boolean, other_hash boolean, hash string")


@query("year_windows", "select distinct year(o_orderdate)::int as \"year\", make_date(year(o_orderdate), 1, 1) date_from, least(make_date(year(o_orderdate), 12, 31), date '1999-06-30') date_to from orders where year(o_orderdate) < 2000")
def year_windows(spark, sf_dir):
    y = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).where("year < 2000").distinct()
    return y.withColumn("w", windows.window_for(F.col("year"), "1999-06-30")).select("year", "w.*")


@query("random_weeks", "select i::int draw, date '2010-01-01' + (('0x' || md5(i || ':5')[1:7])::int % (date_diff('day', date '2010-01-01', date '2015-12-25') + 1))::int date_from, date '2010-01-01' + (('0x' || md5(i || ':5')[1:7])::int % (date_diff('day', date '2010-01-01', date '2015-12-25') + 1))::int + 6 date_to from range(12) t(i)")
def random_weeks(spark, sf_dir):
    return windows.random_weeks(spark, 2010, 2015, 12, 5)


_PEAK = "((hour({0}) >= 1 and hour({0}) < 4) or (hour({0}) >= 6 and hour({0}) < 10)) and isodow({0}) < 6"


@query("tariff_windows", f"with e as (select event_id, ts, date_trunc('hour', ts) h from events where event_id % 50 = 0), a as (select event_id, ts, unnest(generate_series(h, h + interval 192 hour, interval 1 hour)) x from e), s as (select event_id, unnest(generate_series(ts, ts + interval 179 minute, interval 15 minute)) y from e) select e.event_id, (select min(x) from a where a.event_id = e.event_id and x > h and {_PEAK.format('x')} and not ({_PEAK.format('(x - interval 1 hour)')})) next_peak, greatest((select min(x) from a where a.event_id = e.event_id and not ({_PEAK.format('x')})), e.ts) next_off_peak, not exists (select 1 from s where s.event_id = e.event_id and {_PEAK.format('y')}) and not ({_PEAK.format('(e.ts + interval 180 minute)')}) fits from e")
def tariff_windows(spark, sf_dir):
    t = F.col("t")
    e = read(spark, sf_dir, "events").where("event_id % 50 = 0").select("event_id", F.col("ts").cast("timestamp_ntz").cast("timestamp").alias("t"))
    ntz = lambda c: c.cast("timestamp_ntz")
    return e.select("event_id", ntz(text.next_peak(t)).alias("next_peak"), ntz(text.next_off_peak(t)).alias("next_off_peak"), text.fits_off_peak(t, 180).alias("fits"))


@query("strict_years", "select o_orderkey, case when o_orderkey % 3 > 0 then year(o_orderdate)::int end as \"year\" from orders")
def strict_years(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", text.strict_year(F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.year("o_orderdate"), F.lit(".0"))).otherwise(" ")).alias("year"))


# ---- streams and user functions ----
def _at(spark, name: str) -> str:
    return f"{shared_dir(spark)}/corvane/{name}-{uuid.uuid4().hex}"


def _event_files(spark, sf_dir, parts: int = 4) -> tuple[str, object]:
    at, e = _at(spark, "events"), read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    for m in range(parts):
        e.where(F.col("event_id") % parts == m).coalesce(1).write.mode("append").parquet(at)
    return at, e.schema


@query("stream_ingest", "select event_id, user_id, event_type from events")
def stream_ingest(spark, sf_dir):
    src, schema = _event_files(spark, sf_dir)
    out, check = _at(spark, "ingested"), _at(spark, "check")
    for _ in range(2):  # a restart adds nothing
        log.ingest(log.read_log(spark, src, schema, 2), out, check).awaitTermination()
    return spark.read.schema(schema).parquet(out).select("event_id", "user_id", "event_type")


@query("stream_latest", "select user_id, arg_max(event_id, (ts, event_id)) event_id, arg_max(event_type, (ts, event_id)) event_type from events group by user_id")
def stream_latest(spark, sf_dir):
    src, schema = _event_files(spark, sf_dir)
    out = _at(spark, "latest")
    log.maintain_latest(log.read_log(spark, src, schema, 1), "user_id", ["ts", "event_id"], out, _at(spark, "check"), 4).awaitTermination()
    order = ["user_id", *[c for c in schema.names if c != "user_id"]]
    from pyspark.sql.types import StructType

    return log.read_latest(spark, out, StructType([schema[c] for c in order])).select("user_id", "event_id", "event_type")


@query("stream_resume", "select event_id from events where user_id not in (select c_custkey from customer where c_custkey % 3 = 0)")
def stream_resume(spark, sf_dir):
    src, schema = _event_files(spark, sf_dir)
    out = _at(spark, "resumed")
    done = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"))
    log.ingest(log.new_only(log.read_log(spark, src, schema), done, "user_id").select("event_id"), out, _at(spark, "check")).awaitTermination()
    return spark.read.schema("event_id long").parquet(out)


@query("stream_copy", "select event_id, event_type from events")
def stream_copy(spark, sf_dir):
    src, schema = _event_files(spark, sf_dir, 2)
    out = _at(spark, "copied")
    log.copy_log(spark, src, out, schema, _at(spark, "check")).awaitTermination()
    return spark.read.schema(schema).parquet(out).select("event_id", "event_type")


@query("run_alerts", "with e as (select event_type <> 'error' ok, user_id % 10 run, ts, event_id, date_diff('microsecond', lag(ts) over w, ts) / 1e6 gap, lag(event_type <> 'error') over w was from events window w as (partition by user_id % 10 order by ts)) select run, 'resumed' alert, count(*) n from e where gap > 1800 group by 1 union all select run, 'down', count(*) from e where not ok and coalesce(was, true) group by 1 union all select run, 'up', count(*) from e where ok and not coalesce(was, true) group by 1")
def run_alerts(spark, sf_dir):
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("run"), "ts", (F.col("event_type") != "error").alias("ok"))
    return log.alerts(e, "run", "ts", 1800).groupBy("run", "alert").agg(F.count("*").alias("n"))


def _square(x):
    if x % 10 == 0:
        raise ValueError("round number")
    return x * x


@query("parallel_map", "select c_custkey, case when c_custkey % 10 > 0 then c_custkey * c_custkey end result, case when c_custkey % 10 = 0 then 'ValueError: round number' end error from customer")
def parallel_map(spark, sf_dir):
    return steps.parallel_map(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", _square, "long")


@query("model_calls", "select p_partkey, case when p_size <> 7 then upper(p_name) end raw, case when p_size = 7 then 'no answer' end error from part")
def model_calls(spark, sf_dir):
    from corvane.operators import parsers

    def client(x):
        if x.startswith("!"):
            raise RuntimeError("no answer")
        return x.upper()

    p = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") == 7, "!").otherwise(F.col("p_name")).alias("prompt"))
    return parsers.model_calls(p, "p_partkey", "prompt", client)


@query("step_run", "select o_custkey, count(*) n, round(sum(o_totalprice), 2) total from orders where o_orderstatus = 'F' group by 1 having count(*) > 5")
def step_run(spark, sf_dir):
    r = steps.Registry()
    r.step("open")(lambda t: t["orders"].where("o_orderstatus = 'F'"))
    r.step("totals")(lambda t: t["open"].groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))
    r.step("busy")(lambda t: t["totals"].where("n > 5"))
    return r.run(["open", "totals", "busy"], {"orders": read(spark, sf_dir, "orders")})["busy"]


@query("row_ids", "with s as (select p_partkey, case when p_partkey % 5 > 0 then 'id' || p_partkey end id, p_name from part where p_size < 10) select p_partkey, coalesce(id, 'no-id-row-' || row_number() over (partition by id is null order by p_partkey)) id from s")
def row_ids(spark, sf_dir):
    p = read(spark, sf_dir, "part").where("p_size < 10").select("p_partkey", F.when(F.col("p_partkey") % 5 > 0, F.concat(F.lit("id"), "p_partkey")).alias("id"))
    return queues.numbered(p, "id", "no-id-row-", ["p_partkey"])


@query("seed_terms_added", "with l as (select distinct lower(p_type) term, 'corpus' source from part), s as (select unnest(['economy', 'novel one', 'Novel Two ']) term) select term, source from l union all select distinct lower(trim(term)), 'seed' from s where lower(trim(term)) not in (select term from l)")
def seed_terms_added(spark, sf_dir):
    lexicon = read(spark, sf_dir, "part").select(F.lower("p_type").alias("term")).distinct().withColumn("source", F.lit("corpus"))
    return queues.seeded(lexicon, spark.createDataFrame([("economy",), ("novel one",), ("Novel Two ",), ("novel one",)], "term string"), "term")


@query("boolean_cells", "select o_orderkey, case o_orderkey % 6 when 0 then true when 1 then false when 2 then true when 3 then false end flag from orders")
def boolean_cells(spark, sf_dir):
    raw = F.get(F.array(*[F.lit(x) for x in (" Yes", "NO", "true", "n ", "maybe", "")]), (F.col("o_orderkey") % 6).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", text.truth(raw).alias("flag"))


@query("release_version", "select count(*) n, 1::bigint versions, max(ts)::date newest from events")
def release_version(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("version", F.lit("1.8.0"))
    return table(e.agg(F.count("*").alias("n"), F.countDistinct("version").alias("versions"), F.to_date(F.max("ts")).alias("newest")), "release")

"""Queries of the tagging answers on answers made from orders, each with its SQL: what each kind of answer must give."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from corvane.operators import answers
from corvane.plans.catalog import query
from corvane.session import read

TIERS = ["domain_tier1", "domain_tier2", "domain_tier3"]
_LABELS = {
    "domain_tier1": ["Biology", "Chemistry"],
    "domain_tier2": ["Genomics", "Proteomics", "Imaging"],
    "domain_tier3": ["RNA-seq", "Mass spectrometry"],
    "learning_paradigm": ["supervised", "unsupervised", "reinforcement"],
    "model_family": ["Neural network", "Tree ensemble"],
    "model_use": ["prediction", "generation"],
}
VOCABULARY = {f: {x.lower(): x for x in labels} for f, labels in _LABELS.items()}
CAPS = {"domain_tier1": 1, "domain_tier2": 2, "domain_tier3": 2, "learning_paradigm": 2, "model_family": 1, "model_use": 1}
SEEDS = {"random forest": "Random forest", "rf": "Random forest", "cnn": "CNN"}
HINTS = {"Random forest": ["Tree ensemble"], "CNN": ["Neural network"]}


def _answers(spark, sf_dir, made: list[str]):
    """Each order with one of some answers; @ stands for its number."""
    i = F.col("o_orderkey") % len(made)
    raw = F.get(F.array(*[F.lit(m) for m in made]), i.cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.replace(raw, F.lit("@"), F.col("o_orderkey").cast("string")).alias("raw"))


def _expected(rows: list[dict[str, str]]) -> str:
    """SQL of what each kind of answer gives: a column for each key."""
    columns = [f"[{', '.join(repr(r[c]) for r in rows)}][o_orderkey % {len(rows)} + 1]" for c in rows[0]]
    return ", ".join(f"replace({x}, '@', o_orderkey::varchar) {c}" for x, c in zip(columns, rows[0], strict=True))


def _kind(answer: str, t1="", t2="", t3="", types="", log="", status="ok", fallback="false", rationale=""):
    return answer, {"t1": t1, "t2": t2, "t3": t3, "model_type": types, "rationale": rationale, "violations": log, "status": status, "fallback": fallback}


_TIERED = [
    _kind(json.dumps({"domain_tier1": ["biology"], "domain_tier2": ["GENOMICS"], "model_type": ["rf", "own @"], "rationale": " r@ "}), "Biology", "Genomics", types="Random forest|own @", rationale="r@"),
    _kind(json.dumps({"domain_tier1": ["Chemistry"], "domain_tier3": ["proteomics"]}), "Chemistry", "Proteomics", log="domain_tier3:repaired_to_domain_tier2:Proteomics"),
    _kind(json.dumps({"domain_tier2": ["Astrology", " "]}), "", "Astrology", log="domain_tier2:unknown:Astrology"),
    _kind(json.dumps({"domain_tier1": ["Biology", "Chemistry"], "learning_paradigm": ["magic"]}), "Biology|Chemistry", log="domain_tier1:cap_exceeded:2>1|learning_paradigm:unknown:magic"),
    _kind('<think>{"a": 1} no</think> {"domain_tier1": ["Biology"]}', "Biology", fallback="true"),
    _kind('Here: {"domain_tier3": ["rna-SEQ"]} ok', t3="RNA-seq", fallback="true"),
    _kind("no answer @", status="parse_error", fallback="true", rationale="no answer @"),
    _kind(json.dumps({"domain_tier1": ["Biology"], "domain_tier2": ["chemistry"]}), "Biology", "chemistry", log="domain_tier2:unknown:chemistry"),
    _kind(json.dumps({"domain_tier1": "Biology", "domain_tier2": ["Genomics", "Genomics", "Imaging"]}), "", "Genomics|Genomics|Imaging", log="domain_tier2:cap_exceeded:3>2"),
]


def _joined(*columns: str):
    return [F.array_join(c, "|").alias(a) for c, a in (x.split(" ") for x in columns)]


@query("enrichment_parse", f"select o_orderkey, {_expected([w for _, w in _TIERED])} from orders")
def enrichment_parse(spark, sf_dir):
    rows = answers.parsed(_answers(spark, sf_dir, [a for a, _ in _TIERED]), "raw", TIERS, ["learning_paradigm", "model_family"], VOCABULARY, CAPS, SEEDS)
    return rows.select("o_orderkey", *_joined("domain_tier1 t1", "domain_tier2 t2", "domain_tier3 t3", "model_type model_type"), "rationale", *_joined("vocab_violations violations"), F.col("parse_status").alias("status"), F.col("parse_fallback_used").cast("string").alias("fallback"))


def _refined(answer, paradigm="", family="", types="", use="", back="", log=""):
    return json.dumps(answer) if isinstance(answer, dict) else answer, {"paradigm": paradigm, "family": family, "model_type": types, "model_use": use, "backfilled": back, "violations": log}


_SECOND = [
    _refined({"learning_paradigm": ["Reinforcement Learning"], "model_type": ["rf"]}, "reinforcement", "Tree ensemble", "Random forest", back="Tree ensemble<-Random forest", log="learning_paradigm:repaired:Reinforcement Learning->reinforcement"),
    _refined({"model_family": ["neural network"], "model_type": ["rf", "cnn"]}, "", "Neural network", "Random forest|CNN", back="skipped_cap:Tree ensemble<-Random forest"),
    _refined({"model_use": ["Prediction", "guess"]}, use="prediction|guess", log="model_use:unknown:guess|model_use:cap_exceeded:2>1"),
    _refined({"model_type": ["SHAP analysis", "genetic algorithm @"]}, types="SHAP analysis|genetic algorithm @", log="model_type:excluded_kind:explainability:SHAP analysis|model_type:excluded_kind:optimiser_check:genetic algorithm @"),
    _refined("nothing"),
    _refined({"learning_paradigm": ["supervised", "Supervised learning", "odd learning"]}, "supervised|odd learning", log="learning_paradigm:unknown:odd learning|learning_paradigm:cap_exceeded:3>2|learning_paradigm:repaired:Supervised learning->supervised"),
]


@query("enrichment_refined", f"select o_orderkey, {_expected([w for _, w in _SECOND])} from orders")
def enrichment_refined(spark, sf_dir):
    rows = answers.parsed(_answers(spark, sf_dir, [a for a, _ in _SECOND]), "raw", TIERS, ["learning_paradigm", "model_family"], VOCABULARY, CAPS, SEEDS)
    return answers.refined(rows, "raw", VOCABULARY, CAPS, HINTS).select("o_orderkey", *_joined("learning_paradigm paradigm", "model_family family", "model_type model_type", "model_use model_use", "family_backfilled backfilled", "vocab_violations violations"))


def _tidy(t1, t2, paradigm, to1="", to2="", top="", log=""):
    c = "cleaned:c1:"
    return (t1, t2, paradigm), {"t1": to1, "t2": to2, "paradigm": top, "changes": "|".join(c + x for x in log.split("|") if x)}


_STORED = [
    _tidy(["BIOLOGY"], ["Genomics"], [], "Biology", "Genomics", "", "domain_tier1:case:BIOLOGY->Biology"),
    _tidy([], ["Genomics", "genomics"], ["supervised"], "", "Genomics", "supervised", "domain_tier2:case:genomics->Genomics|domain_tier2:dedup:Genomics"),
    _tidy([], ["biology", "Imaging"], [], "Biology", "Imaging", "", "domain_tier2:moved_to_domain_tier1:Biology"),
    _tidy(["Biology"], ["Astrology", " "], [], "Biology", "", "", "domain_tier2:dropped_unknown:Astrology"),
    _tidy([], ["Genomics", "Proteomics", "Imaging"], ["neural network"], "", "Genomics|Proteomics", "", "domain_tier2:trimmed:Imaging|learning_paradigm:dropped_unknown:Neural network"),
    _tidy(["Chemistry"], ["biology"], [], "Chemistry", "", "", "domain_tier2:dropped_full:Biology"),
    _tidy(["Genomics"], ["Genomics"], None, "", "Genomics", "", "domain_tier1:dropped_duplicate:Genomics"),
]


def _stored(spark, sf_dir):
    i = (F.col("o_orderkey") % len(_STORED)).cast("int")
    column = lambda k: F.from_json(F.get(F.array(*[F.lit(json.dumps(v[k])) for v, _ in _STORED]), i), "array<string>")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", column(0).alias("domain_tier1"), column(1).alias("domain_tier2"), column(2).alias("learning_paradigm"))
    fields = ["domain_tier1", "domain_tier2", "learning_paradigm"]
    done = answers.cleaned({f: F.col(f) for f in fields}, [TIERS, ["learning_paradigm", "model_family", "model_use"]], VOCABULARY, CAPS)
    return rows.select("o_orderkey", done.alias("d")).select("o_orderkey", "d.*")


@query("tag_cleaning", f"select o_orderkey, {_expected([w for _, w in _STORED])} from orders")
def tag_cleaning(spark, sf_dir):
    return _stored(spark, sf_dir).select("o_orderkey", *_joined("domain_tier1 t1", "domain_tier2 t2", "learning_paradigm paradigm", "changes changes"))


@query("cleaning_audit", f"with c as (select {_expected([{'changes': w['changes']} for _, w in _STORED])} from orders), e as (select unnest(string_split(changes, '|')) c from c where changes <> '') select split_part(c, ':', 3) field, split_part(c, ':', 4) \"action\", count(*) n from e group by all")
def cleaning_audit(spark, sf_dir):
    return answers.audit(_stored(spark, sf_dir), "changes")

"""Model answers that tag records with closed vocabularies: parsing with repair, and cleaning of stored tags.

A vocabulary is a dict field -> {lower-case spelling: label}; caps is a dict field -> most tags. Both are small and become
literals. Order matters, so lists are folded from the left by built-in functions; no row goes through Python.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of model_type items that don't belong there, in the order they are tried, and the end of a paradigm's name.
EXCLUDED_KINDS = {
    "explainability": r"\bshap\b|shapley|\blime\b|permutation importance|grad-?cam",
    "statistics": r"\blimma\b|deseq|\blefse\b|redundancy analysis|\blisa\b|local indicators of spatial|differential expression|enrichment analysis|mendelian randomi",
    "pipeline": r"\bwgcna\b|weighted gene co-?expression|\bscenic\b|cellchat|nichenet|\bmonocle\b|pseudotime|trajectory analysis|cell2location",
    "task": r"segmentation$|named entity recognition|^classification$|feature selection|^object detection$",
    "simulation": r"docking|molecular dynamics|monte carlo|\bdft\b|density functional|simulation",
    "component": r"attention mechanism|activation|loss function|dropout|augmentation|calibration|conformal|distillation|retrieval-augmented|chain-of-thought",
    "family_name": r"^(machine learning|deep learning|ensemble machine learning|hybrid machine learning|transfer learning|artificial intelligence)( model| models| algorithms?)?$|^neural network classifier$|^deep learning model$|^machine learning model$",
    "optimiser_check": r"particle swarm|grey wolf|bayesian optimi[sz]ation|optuna|genetic algorithm",
}
PARADIGM_END = r"(?i)\s+(machine\s+)?learning$"
STRINGS = "array<string>"


def table(values: dict) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string, string>")


def lists(values: dict[str, list[str]]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string, array<string>>")


def empty() -> Column:
    return F.array().cast(STRINGS)


def bound(x: Column, use) -> Column:
    """use(x), with x evaluated once."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def json_object(raw: Column) -> Column:
    """Struct of text, the JSON object in an answer (as it is, without a thinking block, or its first {...}; null if none), and whether it took more than the first."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    bare = F.trim(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))
    whole = lambda x: F.when(F.json_object_keys(x).isNotNull(), x)
    return bound(F.struct(text.alias("t"), bare.alias("b")), lambda v: F.struct(F.coalesce(whole(v["t"]), whole(v["b"]), whole(F.regexp_extract(v["b"], r"(?s)(\{.*\})", 1))).alias("text"), whole(v["t"]).isNull().alias("fallback")))


def strings_of(text: Column, field: str) -> Column:
    """A field of a JSON object as its strings, trimmed, without blank ones; empty if it isn't a list."""
    raw = F.get_json_object(text, f"$.{field}")
    listed = F.coalesce(F.from_json(F.when(raw.startswith("["), raw), STRINGS), empty())
    return F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: F.coalesce(x, F.lit("")) != "")


def say(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def tiers(values: dict[str, Column], vocabulary: dict, caps: dict) -> Column:
    """Struct of each field's labels and log. A term of another field goes there if there is room, else it stays and is logged as unknown, like any other."""
    fields = list(values)
    marked = lambda f: F.transform(values[f], lambda v: F.struct(F.lit(f).alias("at"), v.alias("value")))
    items = F.flatten(F.array(*map(marked, fields)))
    start = F.struct(*[empty().alias(f) for f in fields], empty().alias("log"))

    def step(acc: Column, item: Column) -> Column:
        low = F.lower(item["value"])
        home, label, room = F.when(F.lit(False), ""), F.when(F.lit(False), ""), F.when(F.lit(False), F.lit(True))
        for f in fields:  # its own field comes first
            own = F.try_element_at(table(vocabulary[f]), low)
            home, label, room = home.when((item["at"] == f) & own.isNotNull(), f), label.when((item["at"] == f) & own.isNotNull(), own), room.when((item["at"] == f) & own.isNotNull(), True)
        for f in fields:
            other = F.try_element_at(table(vocabulary[f]), low)
            home, label, room = home.when(other.isNotNull(), f), label.when(other.isNotNull(), other), room.when(other.isNotNull(), ~F.array_contains(acc[f], other) & (F.size(acc[f]) < caps[f]))

        def placed(p: Column) -> Column:
            fits = F.coalesce(p["room"], F.lit(False))
            to, what = F.when(fits, p["home"]).otherwise(item["at"]), F.when(fits, p["label"]).otherwise(item["value"])
            why = F.when(~fits, say(item["at"], ":unknown:", item["value"])).when(p["home"] != item["at"], say(item["at"], ":repaired_to_", p["home"], ":", p["label"]))
            return F.struct(*[F.when(to == f, F.array_append(acc[f], what)).otherwise(acc[f]).alias(f) for f in fields], F.when(why.isNotNull(), F.array_append(acc["log"], why)).otherwise(acc["log"]).alias("log"))

        return bound(F.struct(home.alias("home"), label.alias("label"), room.alias("room")), placed)

    return F.aggregate(items, start, step, lambda acc: F.struct(*[acc[f].alias(f) for f in fields], F.concat(acc["log"], *[over(f, acc[f], caps) for f in fields]).alias("log")))


def over(field: str, labels: Column, caps: dict) -> Column:
    return F.when(F.size(labels) > caps[field], F.array(say(f"{field}:cap_exceeded:", F.size(labels), f">{caps[field]}"))).otherwise(empty())


def closed(field: str, values: Column, vocabulary: dict, caps: dict) -> tuple[Column, Column]:
    """A field's labels, unknown terms as they are, and its log."""
    names = table(vocabulary[field])
    labels = F.transform(values, lambda v: F.coalesce(F.try_element_at(names, F.lower(v)), v))
    unknown = F.transform(F.filter(values, lambda v: F.try_element_at(names, F.lower(v)).isNull()), lambda v: say(f"{field}:unknown:", v))
    return labels, F.concat(unknown, over(field, labels, caps))


def parsed(rows: DataFrame, raw: str, tier_fields: list[str], closed_fields: list[str], vocabulary: dict, caps: dict, seeds: dict[str, str]) -> DataFrame:
    """rows with a column for each field, model_type, rationale, vocab_violations, parse_status (ok or parse_error) and parse_fallback_used.

    Unknown terms and lists over their cap are kept and logged. Without a JSON object all lists are empty and rationale is the answer's start.
    """
    r = rows.withColumn("_o", json_object(F.col(raw)))
    r = r.withColumns({f"_{f}": strings_of(F.col("_o.text"), f) for f in [*tier_fields, *closed_fields, "model_type"]})
    r = r.withColumn("_t", tiers({f: F.col(f"_{f}") for f in tier_fields}, vocabulary, caps))
    made = {f: closed(f, F.col(f"_{f}"), vocabulary, caps) for f in closed_fields}
    ok = F.col("_o.text").isNotNull()
    out = {f: F.col(f"_t.{f}") for f in tier_fields} | {f: x for f, (x, _) in made.items()}
    out["model_type"] = F.transform("_model_type", lambda v: F.coalesce(F.try_element_at(table(seeds), F.lower(v)), v))
    out["rationale"] = F.when(ok, F.trim(F.coalesce(F.get_json_object("_o.text", "$.rationale"), F.lit("")))).otherwise(F.left(F.trim(F.coalesce(raw, F.lit(""))), F.lit(300)))
    out["vocab_violations"] = F.concat(F.col("_t.log"), *[log for _, log in made.values()])
    out["parse_status"] = F.when(ok, "ok").otherwise("parse_error")
    out["parse_fallback_used"] = F.col("_o.fallback")
    return r.withColumns(out).drop("_o", "_t", *[f"_{f}" for f in [*tier_fields, *closed_fields, "model_type"]])


def refined(rows: DataFrame, raw: str, vocabulary: dict, caps: dict, hints: dict[str, list[str]]) -> DataFrame:
    """parsed rows with model_use, repaired paradigms, families filled in from hints under the cap, and excluded kinds flagged."""
    uses, use_log = closed("model_use", strings_of(json_object(F.col(raw))["text"], "model_use"), vocabulary, caps)
    ok = F.col("parse_status") == "ok"
    paradigms = table(vocabulary["learning_paradigm"])
    mended = lambda v: F.try_element_at(paradigms, F.lower(F.regexp_replace(v, PARADIGM_END, "")))
    wrong = lambda v: F.array_contains("vocab_violations", say("learning_paradigm:unknown:", v)) & mended(v).isNotNull()
    repairs = F.transform(F.filter("learning_paradigm", wrong), lambda v: F.struct(say("learning_paradigm:unknown:", v).alias("old"), say("learning_paradigm:repaired:", v, "->", mended(v)).alias("new")))
    log = F.concat(F.array_except(F.col("vocab_violations"), F.transform(repairs, lambda x: x["old"])), use_log, F.transform(repairs, lambda x: x["new"]))
    kind = lambda v: reduce(lambda w, k: w.when(v.rlike(f"(?i){EXCLUDED_KINDS[k]}"), k), EXCLUDED_KINDS, F.when(F.lit(False), ""))
    flagged = F.array_compact(F.transform("model_type", lambda v: bound(kind(v), lambda k: F.when(k.isNotNull(), say("model_type:excluded_kind:", k, ":", v)))))
    wanted = F.flatten(F.transform("model_type", lambda m: F.transform(F.coalesce(F.try_element_at(lists(hints), m), empty()), lambda f: F.struct(f.alias("family"), m.alias("of")))))

    def fill(acc: Column, x: Column) -> Column:
        has, full = F.array_contains(acc["families"], x["family"]), F.size(acc["families"]) >= caps["model_family"]
        note = F.when(full, say("skipped_cap:", x["family"], "<-", x["of"])).otherwise(say(x["family"], "<-", x["of"]))
        return F.struct(F.when(has | full, acc["families"]).otherwise(F.array_append(acc["families"], x["family"])).alias("families"), F.when(has, acc["notes"]).otherwise(F.array_append(acc["notes"], note)).alias("notes"))

    filled = F.aggregate(wanted, F.struct(F.col("model_family").alias("families"), empty().alias("notes")), fill)
    r = rows.withColumns({"_filled": filled, "_log": F.when(ok, F.concat(log, flagged)).otherwise(F.col("vocab_violations"))})
    one = F.array_distinct(F.transform("learning_paradigm", lambda v: F.when(wrong(v), mended(v)).otherwise(v)))
    return r.withColumns({"model_use": F.when(ok, uses).otherwise(empty()), "learning_paradigm": one, "model_family": F.col("_filled.families"), "family_backfilled": F.col("_filled.notes"), "vocab_violations": F.col("_log")}).drop("_filled", "_log")


def cleaned(values: dict[str, Column], groups: list[list[str]], vocabulary: dict, caps: dict, mark: str = "cleaned:c1:") -> Column:
    """Struct of each field's labels and changes.

    Spellings become labels, repeats go, lists are cut at their cap; then a term of another field of its group moves there if there is room.
    Unknown terms go. Each change is logged, in the order it is made.
    """
    fields = [f for g in groups for f in g if f in values]
    group = {f: g for g in groups for f in g}

    def first(f: str) -> Column:
        def step(acc: Column, v: Column) -> Column:
            low = F.lower(F.trim(v))
            to, moved = F.when(F.lit(False), ""), F.when(F.lit(False), "")
            for g in group[f]:
                if g != f:
                    other = F.try_element_at(table(vocabulary[g]), low)
                    to, moved = to.when(other.isNotNull(), g), moved.when(other.isNotNull(), other)

            def placed(p: Column) -> Column:
                own = p["own"].isNotNull()
                again = own & F.array_contains(acc["out"], p["own"])
                notes = F.array_compact(
                    F.array(
                        F.when(own & (p["own"] != v), say(f"{mark}{f}:case:", v, "->", p["own"])),
                        F.when(again, say(f"{mark}{f}:dedup:", p["own"])),
                        F.when(~own & p["to"].isNull(), say(f"{mark}{f}:dropped_unknown:", v)),
                    )
                )
                away = F.struct(F.lit(f).alias("at"), p["moved"].alias("label"), p["to"].alias("to"))
                return F.struct(
                    F.when(own & ~again, F.array_append(acc["out"], p["own"])).otherwise(acc["out"]).alias("out"),
                    F.concat(acc["log"], notes).alias("log"),
                    F.when(~own & p["to"].isNotNull(), F.array_append(acc["away"], away)).otherwise(acc["away"]).alias("away"),
                )

            return bound(F.struct(F.try_element_at(table(vocabulary[f]), low).alias("own"), to.alias("to"), moved.alias("moved")), placed)

        start = F.struct(empty().alias("out"), empty().alias("log"), F.array().cast("array<struct<at: string, label: string, to: string>>").alias("away"))
        given = F.filter(F.coalesce(values[f], empty()), lambda v: F.trim(F.coalesce(v, F.lit(""))) != "")
        trim = lambda a: F.transform(F.slice(a["out"], caps[f] + 1, F.greatest(F.size(a["out"]), F.lit(1))), lambda x: say(f"{mark}{f}:trimmed:", x))
        return F.aggregate(given, start, step, lambda a: F.struct(F.slice(a["out"], 1, caps[f]).alias("out"), F.concat(a["log"], trim(a)).alias("log"), a["away"].alias("away")))

    def second(v: Column) -> Column:
        def move(acc: Column, x: Column) -> Column:
            why = F.when(F.lit(False), "")
            for f in fields:
                here = x["to"] == f
                why = why.when(here & F.array_contains(acc[f], x["label"]), say(mark, x["at"], ":dropped_duplicate:", x["label"])).when(here & (F.size(acc[f]) >= caps[f]), say(mark, x["at"], ":dropped_full:", x["label"])).when(here, say(mark, x["at"], f":moved_to_{f}:", x["label"]))
            why = why.otherwise(say(mark, x["at"], ":dropped_unknown:", x["label"]))
            fits = lambda f: (x["to"] == f) & ~F.array_contains(acc[f], x["label"]) & (F.size(acc[f]) < caps[f])
            return F.struct(*[F.when(fits(f), F.array_append(acc[f], x["label"])).otherwise(acc[f]).alias(f) for f in fields], F.array_append(acc["changes"], why).alias("changes"))

        start = F.struct(*[v[f]["out"].alias(f) for f in fields], F.concat(*[v[f]["log"] for f in fields]).alias("changes"))
        return F.aggregate(F.concat(*[v[f]["away"] for f in fields]), start, move)

    return bound(F.struct(*[first(f).alias(f) for f in fields]), second)


def audit(rows: DataFrame, changes: str) -> DataFrame:
    """How often each kind of change was made, by field, most first."""
    each = rows.select(F.explode(changes).alias("c"))
    return each.groupBy(F.split_part("c", F.lit(":"), F.lit(3)).alias("field"), F.split_part("c", F.lit(":"), F.lit(4)).alias("action")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field", "action")

"""Named steps, user functions over rows, and reports that consist of several tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import evaluation
from corvane.session import ship, table


class Registry:
    """Steps by name; each takes the tables made so far and returns its own. They run in the order given, each result written once."""

    def __init__(self):
        self.steps: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {}

    def step(self, name: str):
        def keep(f):
            self.steps[name] = f
            return f

        return keep

    def run(self, names: list[str], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        if unknown := [n for n in names if n not in self.steps]:
            raise KeyError(f"no steps {unknown}; there are {sorted(self.steps)}")
        made = dict(tables)
        for n in names:
            made[n] = table(self.steps[n](made), n)
        return made


def parallel_map(rows: DataFrame, column: str, function: Callable, result: str, out: str = "result") -> DataFrame:
    """rows with a plain Python function of a column, batch by batch; a value for which it fails gives null and the message in error."""
    ship(rows.sparkSession)
    schema = rows.select("*", F.lit(None).cast(result).alias(out), F.lit(None).cast("string").alias("error")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, errors = [], []
            for x in b[column].to_pylist():
                try:
                    values.append(function(x))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  the job goes on, the row tells
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            kind = pa.array(values, {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}[result])
            yield pa.RecordBatch.from_arrays([*b.columns, kind, pa.array(errors, pa.string())], [*b.schema.names, out, "error"])

    return rows.mapInArrow(run, schema)


def population_report(rows: DataFrame, label: str, verdict: str, tier: str, year: str, source: str) -> dict[str, DataFrame]:
    """The tables of a population's report: agreement by tier, disagreements, label histogram, coverage by source, years, consensus of tiers."""
    labels = ("positive", "negative", "undeterminable")
    wide = rows.groupBy("id", label).pivot(tier, ["first", "second"]).agg(F.max(verdict))
    same = F.col("first") == F.col("second")
    return {
        "agreement": evaluation.agreement(rows, label, verdict, labels, by=[tier]),
        "disagreements": rows.where(F.col(label) != F.col(verdict)).groupBy(tier, label, verdict).agg(F.count("*").alias("n")),
        "labels": rows.groupBy(label).agg(F.countDistinct("id").alias("n")),
        "sources": rows.groupBy(source).agg(F.countDistinct("id").alias("n"), F.round(F.avg((F.col(label) == F.col(verdict)).cast("double")), 6).alias("rate")),
        "years": rows.groupBy(year, label).agg(F.countDistinct("id").alias("n")),
        "consensus": wide.groupBy(F.when(same & (F.col("first") == F.col(label)), "all_agree").when(same, "tiers_agree").when(F.col("first").isNull() | F.col("second").isNull(), "one_tier").otherwise("tiers_differ").alias("bucket")).agg(F.count("*").alias("n")),
    }


def long_form(report: dict[str, DataFrame]) -> DataFrame:
    """All tables of a report as rows of table, key (its other columns, joined) and n."""
    parts = []
    for name, d in report.items():
        count = "n" if "n" in d.columns else "n_total"
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in d.columns if c != count])
        parts.append(d.select(F.lit(name).alias("table"), key.alias("key"), F.col(count).cast("long").alias("n")))
    return reduce(DataFrame.union, parts)


def prior_hash(events: DataFrame, keys: DataFrame, key: str, tier: str, current: str) -> str:
    """The only other criteria hash under which these records were classified; ValueError for none or several."""
    rows = events.where((F.col("tier") == tier) & (F.col("mode") == "primary") & (F.col("hash") != current)).join(keys.select(key).distinct(), key, "left_semi")
    found = sorted(r[0] for r in rows.select("hash").where("hash is not null").distinct().limit(20).collect())
    if len(found) != 1:
        raise ValueError(f"prior hashes: {found}")
    return found[0]



"""Model answers to rows: classification text and vocabulary-bound tags."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = ("positive", "negative", "undeterminable")


def classification(raw: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The label in a JSON answer, else in what follows a thinking block or in its first {...}, else the first label word, else parse_error."""
    schema = "classification string"
    bare = F.trim(F.regexp_replace(raw, r"(?s)<think>.*?</think>", ""))
    got = F.coalesce(*[F.from_json(x, schema)["classification"] for x in (raw, bare, F.regexp_extract(bare, r"(?s)(\{.*\})", 1))])
    label = F.lower(F.trim(got))
    word = F.nullif(F.regexp_extract(F.lower(bare), rf"\b({'|'.join(labels)})\b", 1), F.lit(""))
    return F.coalesce(F.when(label.isin(*labels), label), word, F.lit("parse_error"))


def model_calls(rows: DataFrame, key: str, text: str, client: Callable[[str], str]) -> DataFrame:
    """One call a row by an injected client; a call that fails gives an error row instead of ending the job."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            raw, error = [], []
            for x in t[text].to_pylist():
                try:
                    raw.append(client(x))
                    error.append(None)
                except Exception as e:  # noqa: BLE001
                    raw.append(None)
                    error.append(str(e))
            yield pa.RecordBatch.from_arrays([t[key], pa.array(raw, pa.string()), pa.array(error, pa.string())], [key, "raw", "error"])

    kind = dict(rows.dtypes)[key]
    return rows.select(key, text).mapInArrow(run, f"{key} {kind}, raw string, error string")

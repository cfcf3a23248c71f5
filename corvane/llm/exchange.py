"""Keys that occur in several places, found without sending a row for each occurrence.

Rows are dealt into buckets of bounded size. Each bucket sends each of its keys once, packed, to the owner of that
part of the key space; the owner answers each bucket with those of its keys that other buckets have too. A key with
a third of all rows thus costs its owner one entry a bucket, never one a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.words import binary, flat, mix

U = np.uint64


def share(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the key space that a key belongs to; from other bits than those that order keys."""
    return (mix(keys ^ U(0x5851F42D4C957F2D)) % U(parts)).astype(np.int64)


def pack(bucket: int, keys: np.ndarray, parts: int, **more: np.ndarray) -> pa.Table:
    """Rows (part, bucket, keys, more...) with the keys of each part, sorted by part and else in the order given."""
    part = share(keys, parts)
    order = np.argsort(part, kind="stable")
    here, first = np.unique(part[order], return_index=True)
    offs = np.append(first, len(keys))
    columns = {"part": pa.array(here, pa.int64()), "bucket": pa.array(np.full(len(here), bucket), pa.int64()), "keys": binary(keys[order], offs)}
    return pa.table(columns | {k: binary(v[order], offs) for k, v in more.items()})


def answer(table: pa.Table) -> pa.Table:
    """One part of the key space: for each bucket its keys that at least one other bucket has."""
    keys, offs = flat(table["keys"])
    bucket = np.repeat(table["bucket"].to_numpy(), np.diff(offs))
    order = np.argsort(keys, kind="stable")
    keys, bucket = keys[order], bucket[order]
    same = keys[1:] == keys[:-1]
    many = np.zeros(len(keys), bool)
    many[1:] |= same
    many[:-1] |= same
    keys, bucket = keys[many], bucket[many]
    order = np.argsort(bucket, kind="stable")
    keys, bucket = keys[order], bucket[order]
    here, first = np.unique(bucket, return_index=True)
    return pa.table({"bucket": pa.array(here, pa.int64()), "keys": binary(keys, np.append(first, len(keys)))})


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and those of them that occur more than once."""
    found, n = np.unique(keys, return_counts=True)
    return found, found[n > 1]


def member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == keys


def shared_keys(rows: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], parts: int) -> DataFrame:
    """rows has a column bucket; keys_of gives a bucket's keys. Returns (bucket, keys): packed keys that other buckets have too.

    The groups are bounded: a bucket by its caller, a part of the key space by the number of parts.
    """

    def send(table: pa.Table) -> pa.Table:
        found = np.unique(keys_of(table))
        return pack(table["bucket"][0].as_py(), found, parts)

    sent = rows.groupBy("bucket").applyInArrow(send, "part long, bucket long, keys binary")
    return sent.groupBy("part").applyInArrow(answer, "bucket long, keys binary")


def joined(table: pa.Table, column: str = "keys") -> np.ndarray:
    """All packed keys of a table, sorted."""
    return np.sort(flat(table[column])[0]) if table.num_rows else np.zeros(0, np.uint64)


def deal(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long"))


def plainly(df: DataFrame, *kept: str) -> DataFrame:
    """df with columns other than those kept renamed by place, as Python functions are refused names with dots and ticks."""
    return df.toDF(*[c if c in kept else f"c{i}" for i, c in enumerate(df.columns)])

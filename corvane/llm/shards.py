"""Shards of near equal bytes, by sampled splitters.

Records lie on a line, ordered by a hash of their text, so equal texts lie side by side. A size-weighted sample of keys gives
quantile boundaries, and these splitters range-partition the line. A range over twice its share is subdivided by a sample of its
own, and so is each range that a shard's end falls into, until what it holds is a small part of a shard. Each shard
then gets the ranges between two splitters: those nearest to where its share of the bytes ends.

Equal texts are one key, so a group of copies goes to one shard whole. Groups and records over 1/WHOLE of a shard's share
would unbalance a shard at whose end they lie: these few, at most WHOLE * shards, are dealt first, each whole to the shard with
the fewest bytes, largest first, and the shards' parts of the line are made to fill up what is left. Only a group larger than a shard's share is
divided: it stays on the line, where its records are ordered by doc_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import ship, table

#: Rows and bytes that a range should have at most, ranges of a shard at least, most ranges, and sampled keys for each range.
RANGE_ROWS, RANGE_BYTES, LEAST_RANGES, MOST_RANGES, DRAWS = 50_000, 64 << 20, 4, 2048, 24
#: Parts of a shard's share above which a group is dealt by itself, and to which shards' ends are subdivided; rounds of that.
WHOLE, FINE, ROUNDS = 50, 400, 5


def drawn(df: DataFrame, wanted: dict[int, float]) -> dict[int, list[int]]:
    """Keys of ranges. df has a column r; wanted has the draws a byte of each range, so a row's chance goes by its bytes; which rows are drawn depends on them alone."""
    rates = df.sparkSession.createDataFrame(list(wanted.items()), "r int, rate double")
    chance = F.pmod(F.xxhash64("place", "doc_id", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    out: dict[int, list[int]] = {r: [] for r in wanted}
    for r, x in df.join(F.broadcast(rates), "r").where(chance < F.col("size") * F.col("rate")).select("r", "place").collect():  # DRAWS a range
        out[r].append(x)
    return out


def quantiles(keys: list[int], parts: int) -> set[int]:
    return set(np.quantile(np.array(keys, np.int64), np.arange(1, parts) / parts, method="nearest").tolist()) if keys and parts > 1 else set()


def ranges_for(rows: int, total: int, shards: int) -> int:
    """Some ranges for each shard, and more where these would have too many rows or bytes."""
    return int(min(MOST_RANGES, rows, max(LEAST_RANGES * shards, -(-rows // RANGE_ROWS), -(-total // RANGE_BYTES))))


def range_of(cuts: list[int]):
    """The number of the range that a place is in: how many of the cuts are at or before it."""
    edges = np.array(cuts, np.int64)

    def find(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(), "right").astype(np.int32))

    return F.pandas_udf(find, "int")(F.col("place"))


def sums(df: DataFrame, cuts: list[int]) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each range, one row a range."""
    return {r[0]: (r[1], r[2]) for r in df.groupBy(range_of(cuts).alias("r")).agg(F.sum("size"), F.count("*")).collect()}


def ends(held: dict[int, tuple[int, int]], fill: list[float]) -> list[tuple[int, float]]:
    """For each shard but the last the range that its end falls into, and the bytes from that range's start to it."""
    out, at, before, goal = [], 0, 0, 0.0
    order = sorted(held)
    for x in fill[:-1]:
        goal += x
        while at < len(order) - 1 and before + held[order[at]][0] < goal:
            before += held[order[at]][0]
            at += 1
        out.append((order[at], goal - before))
    return out


def splitters(df: DataFrame, total: int, ranges: int, fill: list[float] | None = None) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """Boundaries of the ranges of the line, subdivided where a range has too much or, with fill (bytes for each shard), a shard ends; and what they hold."""
    cuts = sorted(quantiles(drawn(df.withColumn("r", F.lit(0)), {0: ranges * DRAWS / max(1.0, total)})[0], ranges))
    held = sums(df, cuts)
    for _ in range(ROUNDS):
        full = {r: int(-(-x * ranges // max(1, total))) for r, (x, _) in held.items() if x > 2 * total / ranges}
        if fill and total:
            for r, _ in ends(held, fill):
                if held[r][0] > total / len(fill) / FINE and held[r][1] > 1:
                    full[r] = max(full.get(r, 0), min(32, int(-(-held[r][0] * len(fill) * FINE // total))))
        if not full or len(cuts) >= MOST_RANGES:
            break
        more = set(cuts)
        for r, keys in drawn(df.withColumn("r", range_of(cuts)), {r: parts * DRAWS / held[r][0] for r, parts in full.items()}).items():
            more |= quantiles(keys, full[r])
        if more == set(cuts):
            break
        cuts = sorted(more)
        held = sums(df, cuts)
    return cuts, held


def dealt(groups: list[tuple[int, int]], shards: int, total: int) -> tuple[dict[int, int], list[float]]:
    """Shards of groups (hash, bytes), largest first to the emptiest; and the bytes of the line that fill each shard up to one level."""
    load, to = [0] * shards, {}
    for h, x in sorted(groups, key=lambda g: (-g[1], g[0])):
        to[h] = min(range(shards), key=lambda s: (load[s], s))
        load[to[h]] += x
    rest, level = total - sum(load), 0.0
    for k in range(1, shards + 1):  # the k emptiest shards are filled
        level = (rest + sum(sorted(load)[:k])) / k
        if k == shards or level <= sorted(load)[k]:
            break
    return to, [max(0.0, level - x) for x in load]


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """docs has doc_id and text. Returns per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes (null: none) plus 1. Null and empty texts are one group of equal texts. Rows that are
    alike in id and text are taken in any order: they get the slots side by side. An empty table gives an empty one.
    """
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = table(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash")), "sizes")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    groups = rows.groupBy("hash").agg(F.sum("size").alias("held")).where(F.col("held") > total / shards / WHOLE)
    large = {r[0]: r[1] for r in groups.collect()}  # at most WHOLE * shards rows
    whole = {h: x for h, x in large.items() if x <= total / shards}
    to, fill = dealt(list(whole.items()), shards, total)
    of_large = docs.sparkSession.createDataFrame([(h, to.get(h)) for h in large], "large long, own int")
    low, high = F.lit((1 << 20) - 1).cast("long"), F.lit(-(1 << 20)).cast("long")
    # the upper 44 bits come from the text; a large group's lower ones from the id, so ranges can divide its work
    place = F.col("hash").bitwiseAND(high)
    placed = rows.join(F.broadcast(of_large), F.col("hash") == F.col("large"), "left")
    placed = placed.withColumn("place", F.when(F.col("large").isNull(), place).otherwise(place.bitwiseOR(F.xxhash64("doc_id").bitwiseAND(low))))
    placed = table(placed.select("doc_id", "size", "text_crc32", "hash", "place", "own"), "placed")
    line = placed.where("own is null")
    cuts, held = splitters(line, sum(fill), ranges_for(n, total, shards), fill) if total else ([], {})
    first = [0] * shards  # the first range of each shard
    if held:
        for s, (r, x) in enumerate(ends(held, fill), 1):
            first[s] = max(first[s - 1], r + 1 if x > held[r][0] / 2 else r)
    by_range = F.lit(0)
    for s in range(1, shards):
        by_range = F.when(F.col("r") >= first[s], F.lit(s)).otherwise(by_range)
    ranged = placed.withColumn("r", range_of(cuts)).withColumn("shard", F.coalesce("own", by_range))
    counts = sorted(map(tuple, ranged.groupBy("shard", "r").count().collect()))  # shards * ranges rows at most
    before, offsets = dict.fromkeys(range(shards), 0), []
    for s, r, k in counts:
        offsets.append((s, r, before[s]))
        before[s] += k
    offset = docs.sparkSession.createDataFrame(offsets, "shard int, r int, rows_before long")
    order = [F.col("place"), F.col("hash"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32")]
    at = ranged.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "r").orderBy(*order))).join(F.broadcast(offset), ["shard", "r"])
    return at.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rows_before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

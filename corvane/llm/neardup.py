"""Near duplicates: a multi-index Hamming join over b-bit MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct shingles of five words (A-Z folded). Its signature is 64 minima of 16 bits, in
16 chunks of four. Two signatures that differ in at most RADIUS = 31 symbols have, by pigeonhole, a chunk in which at
most one symbol differs. Enumerating the one allowed error of each chunk gives 64 keys of three symbols, and every
such pair shares a key. At a similarity of 0.75 a signature differs in 16 symbols on average with a deviation of
3.5, so a pair at that limit is beyond the radius with a chance of 1.5e-5. A second signature of 256 minima of 8 bits
then has to differ in at most FINE_RADIUS = 96 symbols (at 0.75: 64 on average, deviation 7, so beyond with a chance of 2.9e-6).
Every pair inside both is confirmed on whole sets, unless its ends are linked already.

Equal sets are one node from the start. Keys that only one node has are found without a row for each (see exchange).
Round 1 compares the members of a key with its smallest node only. Round 2 compares, in blocks, all signatures of a key
whose members round 1 has left apart. What is near there makes families, and round 3 confirms, again in blocks, the near pairs of
a family on whole sets. So no link between two components is lost. Both hand on a spanning forest of what they
find, so a group of n near copies never makes more than n rows a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.components import components
from corvane.llm.exchange import deal, distinct, joined, member, shared_keys
from corvane.llm.words import STEP, binary, buffer, flat, mix, shingles, steps, words
from corvane.session import ship, table

U = np.uint64
WORDS, SYMBOLS, CHUNK, ALLOWED = 5, 64, 4, 1
CHUNKS = SYMBOLS // CHUNK
RADIUS = CHUNKS * (ALLOWED + 1) - 1
FINE, FINE_RADIUS = 256, 96
_rng = np.random.default_rng(77)
_MUL = _rng.integers(0, 2**32, SYMBOLS + FINE, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, SYMBOLS + FINE, dtype=np.uint32)
#: Nodes of a bucket in the key exchange, members of a key that are compared in one block, rows of a task
#: of blocks, and shingles of a block of texts.
BUCKET, BLOCK, TASK, SHINGLES = 8192, 512, 8192, 300_000


def signatures(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit and 8-bit minima of each text's shingles; texts without any have zeros."""
    out = np.zeros((SYMBOLS + FINE, len(first) - 1), np.uint16)
    has = np.flatnonzero(np.diff(first))
    if len(has):
        low = (value >> U(32)).astype(np.uint32)
        for k in range(SYMBOLS + FINE):
            least = np.minimum.reduceat(low * _MUL[k] + _ADD[k], first[has]).astype(np.uint64)
            out[k, has] = (mix(least + U(k << 32)) >> U(48)).astype(np.uint16)
    return np.ascontiguousarray(out[:SYMBOLS].T), np.ascontiguousarray(out[SYMBOLS:].T).astype(np.uint8)


def set_hash(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole set; the order of its members is fixed by sorting."""
    n = np.diff(first)
    out, has = np.zeros(len(n), np.uint64), np.flatnonzero(n)
    if len(has):
        out[has] = mix(np.add.reduceat(mix(value ^ U(0x632BE59BD9B4E019)), first[has]) ^ mix(np.bitwise_xor.reduceat(mix(value + U(1)), first[has]) + n[has].astype(np.uint64)))
    return out


SKETCH = "doc_id long, h long, n_shingles long, node long, sig binary, fine binary"


def sketch(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, h) as SKETCH."""
    for t in tables:
        data, offs = buffer(t["text"])
        for i, j in steps(offs):
            value, first = shingles(words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True), WORDS)
            n = np.diff(first)
            sig, fine = signatures(value, first)
            node = pa.array(set_hash(value, first).view(np.int64), mask=n == 0)
            yield pa.RecordBatch.from_arrays([t["doc_id"][i:j], t["h"][i:j], pa.array(n, pa.int64()), node, binary(sig.reshape(-1), np.arange(j - i + 1) * SYMBOLS), binary(fine.reshape(-1), np.arange(j - i + 1) * FINE)], ["doc_id", "h", "n_shingles", "node", "sig", "fine"])


def symbols(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return flat(column, np.uint16)[0].reshape(-1, SYMBOLS)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """For each signature its keys: chunk and left-out symbol in the upper bits, the other three symbols below."""
    s, out = sig.astype(np.uint64).reshape(len(sig), CHUNKS, CHUNK), []
    for skip in range(CHUNK):
        a, b, c = (s[:, :, k] for k in range(CHUNK) if k != skip)
        tag = (np.arange(CHUNKS, dtype=np.uint64) * U(CHUNK) + U(skip)) << U(48)
        out.append(tag | a << U(32) | b << U(16) | c)
    return np.concatenate(out, 1)


def bucket_keys(t: pa.Table) -> np.ndarray:
    return chunk_keys(symbols(t["sig"])).reshape(-1)


def members(t: pa.Table, reply: pa.Table) -> pa.Table:
    """(key, node) for the keys of a bucket that another node has, here or elsewhere."""
    if not t.num_rows:
        return pa.table({"key": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
    keys = chunk_keys(symbols(t["sig"]))
    node = np.repeat(t["node"].to_numpy(), keys.shape[1])
    keys = keys.reshape(-1)
    keep = member(np.union1d(distinct(keys)[1], joined(reply)), keys)
    return pa.table({"key": keys[keep].view(np.int64), "node": node[keep]})


def near(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, SYMBOLS) for s in (a, b))
    u, v = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, FINE) for s in (c, d))
    return pd.Series(((x != y).sum(1) <= RADIUS) & ((u != v).sum(1) <= FINE_RADIUS))


def confirm(tables: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keeps those rows (a, b, text_a, text_b) whose sets are similar enough; a row of a text with another set is left out."""
    for t in tables:
        keep = []
        sides = [buffer(t[c]) for c in ("text_a", "text_b")]
        total = sides[0][1] + sides[1][1]
        for i, j in steps(total, STEP):
            sets = []
            for (data, offs), c in zip(sides, ("a", "b"), strict=True):
                value, first = shingles(words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True), WORDS)
                sets.append((value, first, set_hash(value, first).view(np.int64) == t[c].to_numpy()[i:j]))
            (va, fa, oka), (vb, fb, okb) = sets
            for k in range(j - i):
                x, y = va[fa[k] : fa[k + 1]], vb[fb[k] : fb[k + 1]]
                low, high = sorted((len(x), len(y)))
                if oka[k] and okb[k] and 100 * low >= percent * high:
                    both = np.concatenate([x, y])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    if 100 * common >= percent * (low + high - common):
                        keep.append(i + k)
        yield pa.RecordBatch.from_arrays([t[c].take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.up
        while True:
            y = up[up[x]]
            if (y == up[x]).all():
                return y
            up[x] = y

    def join(self, a: int, b: int) -> None:
        a, b = self.roots(np.array([a, b]))
        self.up[max(a, b)] = min(a, b)


def parted(names: list[str], t: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The pairs of blocks that a table holds, as rows of its left and its right block. A block with itself is left only."""
    columns = [t[c].to_numpy() for c in names]
    side = t["side"].to_numpy()
    order = np.lexsort((side, *columns))
    low, high = order[:-1], order[1:]
    change = np.zeros(len(low), bool)
    for c in columns:
        change |= c[low] != c[high]
    return [(rows[side[rows] == 0], rows[side[rows] == 1]) for rows in np.split(order, np.flatnonzero(change) + 1)]


def stars(node: np.ndarray, root: np.ndarray) -> pa.Table:
    """Each tree (nodes of one root) as edges from its smallest node: tasks that find the same tree give the same edges."""
    order = np.lexsort((node, root))
    first = np.flatnonzero(np.append(True, root[order][1:] != root[order][:-1])) if len(node) else np.zeros(0, np.int64)
    a = np.repeat(node[order][first], np.diff(np.append(first, len(node))))
    b = node[order]
    keep = a != b
    return pa.table({"a": a[keep], "b": b[keep]})


def families(t: pa.Table) -> pa.Table:
    """Of many pairs of blocks (key, i, j): a forest over nodes that are near and in different components."""
    node, comp, sig, fine = t["node"].to_numpy(), t["comp"].to_numpy(), symbols(t["sig"]), flat(t["fine"], np.uint8)[0].reshape(-1, FINE)
    _, first, same = np.unique(node, return_index=True, return_inverse=True)
    twin, trees = first[same], Forest(len(node))  # twin: a node's first row, as it may have several
    for left, right in parted(["key", "i", "j"], t):
        for x in left:
            y = right if len(right) else left[node[left] > node[x]]
            y = y[(comp[y] != comp[x]) & (trees.roots(twin[y]) != trees.roots(twin[x : x + 1]))]
            y = y[(sig[y] != sig[x]).sum(1) <= RADIUS]
            for z in y[(fine[y] != fine[x]).sum(1) <= FINE_RADIUS]:
                trees.join(twin[x], twin[z])
    return stars(node[first], trees.roots(first))


def links_within(percent: int):
    def run(t: pa.Table) -> pa.Table:
        """Of many pairs of blocks (family, i, j): a forest of links between nodes in different components."""
        node, comp = t["node"].to_numpy(), t["comp"].to_numpy()
        data, offs = buffer(t["text"])
        sets, sigs, fines = [], [], []
        for i, j in steps(offs):
            value, first = shingles(words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], True), WORDS)
            right = set_hash(value, first).view(np.int64) == node[i:j]
            sets += [value[x:y] if ok else value[:0] for x, y, ok in zip(first[:-1], first[1:], right, strict=True)]
            for to, new in zip((sigs, fines), signatures(value, first), strict=True):
                to.append(new)
        sig, fine, size = np.concatenate(sigs), np.concatenate(fines), np.array([len(x) for x in sets])
        _, first, same = np.unique(comp, return_index=True, return_inverse=True)
        twin, trees = first[same], Forest(len(node))  # rows of one component are one tree from the start
        for left, right in parted(["family", "i", "j"], t):
            for x in left:
                y = right if len(right) else left[node[left] > node[x]]
                y = y[(100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])) & (size[y] > 0)]
                y = y[trees.roots(twin[y]) != trees.roots(twin[x : x + 1])]
                y = y[(sig[y] != sig[x]).sum(1) <= RADIUS]
                for z in y[(fine[y] != fine[x]).sum(1) <= FINE_RADIUS]:
                    common = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                    if 100 * common >= percent * (size[x] + size[z] - common):
                        trees.join(twin[x], twin[z])
        return stars(comp[first], trees.roots(first))

    return run


def in_pairs(rows: DataFrame, group: str) -> DataFrame:
    """rows has group, node and nb, the number of blocks of its group: each row once for every pair of blocks it is in."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    pair = own.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    return pair.drop("own", "other", "nb").withColumn("spread", F.xxhash64(group, "i", "j"))


def texts_of(docs: DataFrame, need: DataFrame) -> DataFrame:
    """need (with rep and rep_h) and the text of the row with that id and hash: ids that are null or repeat give no other rows."""
    one = (F.col("doc_id").eqNullSafe(F.col("rep"))) & (F.col("h") == F.col("rep_h"))
    return docs.join(need.hint("shuffle_hash"), one)


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of nodes that are linked, by the whole texts of one document of each node."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "rep", "rep_h"), "node")
    texts = texts_of(docs, need).select("node", "text")
    rows = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return rows.mapInArrow(lambda it: confirm(it, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """docs has doc_id and text. Returns per row of docs: doc_id, n_shingles, component_id, kept.

    Rows with null, empty or blank text have n_shingles 0 and are linked with nothing. Repeated rows and equal texts are
    linked. A component whose ids are all null has a null id; among repeated ids each row with the smallest id is kept.
    Columns of docs other than these two aren't used, so they may have any name. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    drawn = table(docs.mapInArrow(sketch, SKETCH), "sketch")
    chosen = F.min_by(F.struct(F.col("doc_id").alias("rep"), F.col("h").alias("rep_h")), F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("rep")
    nodes = table(drawn.where("node is not null").groupBy("node").agg(chosen, F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("fine").alias("fine")).select("node", "rep.rep", "rep.rep_h", "n_shingles", "sig", "fine"), "nodes")
    n = nodes.count()
    dealt = deal(nodes.select("node", "sig"), "node", max(1, -(-n // BUCKET)))
    reply = shared_keys(dealt, bucket_keys, max(1, -(-n * SYMBOLS // (1 << 20))))
    shared = table(dealt.groupBy("bucket").cogroup(reply.groupBy("bucket")).applyInArrow(members, "key long, node long"), "shared")

    centre = shared.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    star = shared.join(centre, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    sig = nodes.select("node", "sig", "fine")

    def within(pairs: DataFrame) -> DataFrame:
        two = pairs.join(sig.toDF("a", "sa", "fa"), "a").join(sig.toDF("b", "sb", "fb"), "b")
        return two.where(F.pandas_udf(near, "boolean")("sa", "sb", "fa", "fb")).select("a", "b")

    first = table(within(star), "pairs")
    links = table(confirmed(first, docs, nodes, percent), "links")
    comps = components(links)

    # round 2: keys whose members are still apart
    known = shared.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    apart = known.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n")).where("low <> high")
    rest = table(known.join(apart.select("key", F.ceil(F.col("n") / BLOCK).alias("nb")), "key"), "apart")
    tasks = max(1, -(-rest.count() // TASK))
    found = in_pairs(rest, "key").join(sig, "node").groupBy(F.pmod("spread", F.lit(tasks)).alias("task")).applyInArrow(families, "a long, b long")
    found = table(found, "near")
    if found.limit(1).count():
        # round 3
        kin = components(found).select("node", F.col("comp").alias("family")).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        kin = table(kin.join(nodes.select("node", "rep", "rep_h", "n_shingles"), "node"), "kin")
        nb = F.ceil(F.greatest(F.count("*") / (BLOCK // 2), F.sum("n_shingles") / SHINGLES)).alias("nb")
        kin = table(kin.join(kin.groupBy("family").agg(nb), "family"), "kin")
        size = kin.agg(F.sum(F.col("n_shingles") * F.col("nb"))).first()[0]
        rows = texts_of(docs, kin.drop("n_shingles")).select("family", "node", "comp", "nb", "text")
        more = in_pairs(rows, "family").groupBy(F.pmod("spread", F.lit(max(1, -(-size // SHINGLES)))).alias("task")).applyInArrow(links_within(percent), "a long, b long")
        comps = components(links.union(table(more, "links")))

    named = nodes.select("node", "rep").join(comps, "node", "left").select("node", "rep", F.coalesce("comp", "node").alias("comp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("least"))
    label = named.join(least, "comp").select("node", "least")
    out = drawn.select("doc_id", "n_shingles", "node").join(label, "node", "left")
    comp = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of docs without those near duplicates whose component has a smaller doc_id; of repeated ids one row stays."""
    kept = near_duplicates(docs, percent).where("kept").select("doc_id").distinct()
    one = docs.join(kept.hint("shuffle_hash"), docs.doc_id.eqNullSafe(kept.doc_id), "left_semi")
    again = docs.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return one.dropDuplicates(["doc_id"]) if again else one

"""SimHash near-duplicates with pivot distance tables.

A fingerprint holds, per bit, the majority over the XXH64 values of the
text's word shingles.  Fingerprints at a small Hamming distance are linked;
linked groups are the components of that relation.

Candidate pairs: with at most ``max_bits`` differing bits, some
``blocks - max_bits`` of the ``blocks`` bit blocks are equal, so every linked
pair meets under an equal (blocks, value) key.  Pivot distances alone make a
poor shuffle key (one pivot lets through more than half of unrelated pairs),
so equal blocks only decide *where* rows meet, and the pivot table decides
*which* pairs are verified: the Hamming distances of each fingerprint to many
reference fingerprints are computed once per bin, rows are ordered by the
first one, and a pair is discarded as soon as one coordinate differs by more
than ``max_bits``.  Survivors are verified on the full fingerprints.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import map_batches, raw_bytes, ship, store
from creditlens.llm.graph import connected_components

BITS = 64
#: Rows that one key may bring to a task; a larger key is dealt over pairs of chunks.
CHUNK = 1024
#: Rows of many keys that share a task.
BIN_ROWS = 16384
#: Reference fingerprints (fixed by their seed).
PIVOTS = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 16, dtype=np.uint64)


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: words split at ASCII white space, A-Z lowered,
    ``shingle``-word shingles with repeats (fewer words: the whole sequence).
    No word (null, empty, blank): 0.  Memory is bounded for long texts."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    width = min(shingle, n)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: n - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    total, ones = len(starts), np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 15):
        part = [digest(joined[s:e], seed) for s, e in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)])]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """``(doc_id, fp, h1, h2)``, one row per input row; fp is the fingerprint
    as a signed long, h1 and h2 are hashes of the text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, shingle, seed) for t in raw_bytes(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), batch.column(2), batch.column(3)],
                                          ["doc_id", "fp", "h1", "h2"])
    h1, h2 = _text_hashes(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h1.alias("h1"), h2.alias("h2"))
    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, h1 long, h2 long")


def _text_hashes(text_col: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(1), F.col(text_col))


def local_links(fp: np.ndarray, key: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one bin: pairs of equal ``key`` within ``max_bits``,
    as (row value, value of its local root).  Pairs already in one local
    component are not compared again, so a large group of near copies costs
    and emits rows in proportion to its members."""
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], key))
    fp, key, table = fp[order], key[order], table[order]
    n = len(fp)
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    active, shift = np.arange(n), 0
    while True:
        shift += 1
        active = active[active + shift < n]
        # rows are in pivot order within a key: once beyond the window, always beyond
        active = active[(key[active] == key[active + shift])
                        & (table[active + shift, 0] - table[active, 0] <= max_bits)]
        if not len(active):
            break
        left = active[parent[active] != parent[active + shift]]
        for c in range(1, table.shape[1]):
            left = left[np.abs(table[left, c] - table[left + shift, c]) <= max_bits]
        left = left[np.bitwise_count(fp[left] ^ fp[left + shift]) <= max_bits]
        if len(left):
            for i in left.tolist():
                a, b = find(i), find(i + shift)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    moved = np.flatnonzero(parent != np.arange(n))
    return fp[moved], fp[parent[moved]]


def _layout(n: int, max_bits: int) -> tuple[list[tuple[int, int]], int]:
    """Bit blocks and how many of them form a key, so that a key of random
    fingerprints meets about 64 rows.  Every layout finds every pair; more
    rows only get longer keys."""
    for blocks in range(max_bits + 1, BITS + 1):
        free = blocks - max_bits
        if n / 2 ** (BITS * free // blocks) <= 64 or blocks == max_bits + 6:
            break
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    return list(zip(edges, edges[1:])), free


def links(groups: DataFrame, n: int, max_bits: int = 4) -> DataFrame:
    """Spanning links ``(a, b)`` between distinct fingerprints ``fp``.

    Rows meet by equal key; a key with more than CHUNK rows is cut into
    chunks that meet pairwise, and bins are as many as the rows after that
    need, so no task holds an unbounded group."""
    spans, free = _layout(n, max_bits)
    keys = []
    for combo in itertools.combinations(spans, free):
        mask = sum(((1 << (hi - lo)) - 1) << lo for lo, hi in combo)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(mask), F.col("fp").bitwiseAND(F.lit(mask))))
    rows = groups.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = (rows.groupBy("key").count().where(F.col("count") > CHUNK)
           .select("key", "count", F.ceil(F.col("count") / CHUNK).alias("chunks"))).checkpoint(eager=True)
    more = hot.agg(F.coalesce(F.sum(F.col("count") * (F.col("chunks") - 2)), F.lit(0))).first()[0]  # a row goes to chunks - 1 pairs
    own = F.pmod(F.xxhash64(F.lit(7), F.col("fp")), F.col("chunks"))
    met = (rows.join(hot.drop("count"), "key", "left")
           .withColumn("own", own)
           .select("fp", F.explode(F.when(
               F.col("chunks").isNull(), F.array(F.col("key")))
               .otherwise(F.transform(
                   F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: j != F.col("own")),
                   lambda j: F.xxhash64(F.col("key"), F.least(j, F.col("own")), F.greatest(j, F.col("own"))))))
               .alias("key")))
    bins = max(1, math.ceil((n * len(keys) + more) / BIN_ROWS))

    def run(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        a, b = local_links(fp, group.column("key").to_numpy(), max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    ship(groups.sparkSession)
    return (met.withColumn("bin", F.pmod(F.xxhash64(F.lit(11), F.col("key")), F.lit(bins)))
            .groupBy("bin").applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, seed: int = 42) -> DataFrame:
    """``(doc_id, fp, component_id)`` per input row; component_id is the
    smallest doc_id reachable over links, itself included.

    Equal fingerprints are one node, so exact copies are never paired.  Null
    and wordless texts have fingerprint 0 and are linked like any other.
    Repeated rows each get a row; a null doc_id stays null and takes the
    smallest id of its component (null if the component has none).  An empty
    table gives an empty result.  Other columns are ignored.
    """
    fps, labelled = _labelled(docs, id_col, text_col, shingle, max_bits, seed)
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = labelled.join(least, "root").select("fp", "component_id")
    return fps.join(members, "fp").select("doc_id", "fp", "component_id")


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4, max_bits: int = 4,
              seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of the rows, and ``(fp, first_id, root)`` per distinct one."""
    fps = store(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint(eager=True)
    roots = connected_components(links(groups, groups.count(), max_bits))
    return fps, (groups.join(roots, groups.fp == roots.node, "left")
                 .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` (same columns) that represent their component, one
    each: the first by id (null ids last), then by hash of the text; of rows
    with equal id and text, one.  So a component without any id keeps one row
    too, and different texts under one id stay where their components differ."""
    fps, labelled = _labelled(docs, id_col, text_col, **how)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h1", "h2")
    first = fps.join(labelled.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("x"))
    keep = first.select(F.col("x.doc_id").alias("_keep_id"), F.col("x.h1").alias("_keep_1"), F.col("x.h2").alias("_keep_2"))
    h1, h2 = _text_hashes(text_col)
    rows = docs.withColumns({"_row_1": h1, "_row_2": h2})
    same = rows[id_col].eqNullSafe(keep["_keep_id"]) & (rows["_row_1"] == keep["_keep_1"]) & (rows["_row_2"] == keep["_keep_2"])
    return (rows.join(keep, same, "left_semi").dropDuplicates([id_col, "_row_1", "_row_2"])
            .drop("_row_1", "_row_2"))

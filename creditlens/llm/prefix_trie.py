"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns, a trie node a distinct path prefix.  Paths
are range-partitioned: splitter paths cut their order into shards.  A prefix
whose conversations lie in two shards is a prefix of the splitter between
them, so the trie of the splitters (the skeleton, broadcast) holds every node
that no shard can finish alone:

* each shard sorts its paths, walks them once and finishes every node that is
  not in the skeleton;
* for skeleton nodes it gives partial aggregates, which are reduced over the
  shards; only the skeleton itself is then summed from its leaves to the root.

A turn is named by 128 bits of the SHA-256 of role and text, so a path is a
binary string that sorts, and is cut, like the turns.  Equal paths are one row
with a count before they are dealt; their ids are hashed in ascending order
from chunks, one chunk in memory at a time.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import map_batches, ship, store

#: Bytes that name a turn.
TURN = 16
#: Turns that a shard holds, about.
SHARD_TURNS = 200_000
#: Sampled paths per shard from which the splitters are taken.
SAMPLE = 8
#: A chunk of a path's ids spans 2 ** CHUNK_BITS consecutive ids.
CHUNK_BITS = 13
_EMPTY = hashlib.sha256(b"").hexdigest()


def named_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, name, chars)``: a turn without its text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # the length of the role keeps (role, text) apart from other splits of the same characters
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.select("conv_id", "turn", F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * TURN).alias("name"),
                        F.char_length(text).cast("long").alias("chars"))


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the named turns of each conversation in order
    (null places first; equal places by name)."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("placed"), F.coalesce("turn", F.lit(0)).alias("turn"), "name", "chars"))),
        lambda t: F.struct(t["name"].alias("name"), t["chars"].alias("chars")))
    return turns.groupBy("conv_id").agg(ordered.alias("turns"))


def shared_openings(convs: DataFrame, every: int = 100, openings: int = 6) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % every
    instead of its own, h = crc32(c) % openings."""
    head = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings, F.lit(0)).cast("int")
    base = (convs.where(F.col("conv_id") % every == 0)
            .select(F.col("conv_id").alias("_base"), F.slice("turns", 1, openings - 1).alias("first")))
    none = F.array().cast(convs.schema["turns"].dataType)
    return (convs.join(base, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("first", none), F.lit(1), head),
                                        F.slice("turns", head + 1, F.size("turns"))).alias("turns")))


def distinct_paths(convs: DataFrame) -> DataFrame:
    """``(path, chars, conv_id, n, ends)`` per distinct path: the code points of
    its turns, its smallest id, its conversations and the hash of their ids.

    A path with very many conversations is met as chunks of consecutive ids;
    the last step reads them in order and holds one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = chars = first = None
        total, digest, out = 0, hashlib.sha256(), []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())], ["path", "chars", "conv_id", "n", "ends"])

        for batch in batches:
            for p, c, low, n, ids in zip(*(batch.column(k).to_pylist() for k in ("path", "chars", "low", "n", "ids"))):
                if p != path:
                    if path is not None:
                        out.append((path, chars, first, total, digest.hexdigest()))
                    path, chars, first, total, digest = p, c, low, 0, hashlib.sha256()
                    seen = False
                if first is None:
                    first = low
                if ids:
                    digest.update((("," if seen else "") + ids).encode())
                    seen = True
                total += n
            if len(out) >= 10_000:
                yield flush()
        if path is not None:
            out.append((path, chars, first, total, digest.hexdigest()))
        if out:
            yield flush()

    path = F.unhex(F.concat_ws("", F.transform("turns", lambda t: t["name"])))
    rows = convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"),
                        F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
    chunks = rows.groupBy("path", "chunk").agg(
        F.first("chars").alias("chars"), F.min("conv_id").alias("low"), F.count("*").alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    ship(convs.sparkSession)
    return (chunks.repartition("path").sortWithinPartitions("path", F.col("chunk").asc_nulls_first())
            .mapInArrow(run, "path binary, chars array<long>, conv_id long, n long, ends string"))


class Skeleton:
    """Trie of the splitter paths.  Node 0 is the root; parents come first."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.parents, self.depths = [-1], [0]
        self.child: dict[tuple[int, bytes], int] = {}
        for s in splitters:
            at = 0
            for k in range(0, len(s), TURN):
                key = (at, s[k:k + TURN])
                if key not in self.child:
                    self.child[key] = len(self.parents)
                    self.parents.append(at)
                    self.depths.append(k // TURN + 1)
                at = self.child[key]


def splitters(paths: DataFrame, shards: int, total: int) -> list[bytes]:
    """At most ``shards - 1`` ascending cuts, from about SAMPLE paths a shard
    taken by hash.  A cut is shortened to the turns that tell it from the cut
    before, so the skeleton stays small."""
    if shards < 2:
        return []
    limit = int(min(1.0, SAMPLE * shards / max(total, 1)) * 2**32)
    picked = sorted(bytes(r[0]) for r in paths.where(F.pmod(F.xxhash64("path"), F.lit(2**32)) < limit).select("path").collect())
    cuts: list[bytes] = []
    for i in range(1, shards):
        if not picked:
            break
        whole, last = picked[i * len(picked) // shards], cuts[-1] if cuts else b""
        same = 0
        while whole[same:same + TURN] and whole[same:same + TURN] == last[same:same + TURN]:
            same += TURN
        cut = whole[:same + TURN]
        if cut > last:
            cuts.append(cut)
    return cuts


def walk(paths: list[bytes], chars: list[list[int]], first: list[int], counts: list[int], ends: list[str],
         skeleton: Skeleton) -> dict[str, list]:
    """All nodes of one shard's ascending distinct paths, as columns.

    ``sid`` is the skeleton id of a node (-1: finished here) and ``parent_sid``
    that of its parent; parents come before children.  For a skeleton node
    n_children, n_leaves and saved_tokens cover only what hangs below it in
    this shard outside the skeleton."""
    sid, up, depth, low, n, size, end = [0], [-1], [0], [None], [0], [0], [""]
    stack, last = [0], b""
    for path, lens, c, k, e in zip(paths, chars, first, counts, ends):
        keep = 0
        while keep < len(stack) - 1 and path[keep * TURN:(keep + 1) * TURN] == last[keep * TURN:(keep + 1) * TURN] != b"":
            keep += 1
        del stack[keep + 1:]
        for d in range(keep, len(path) // TURN):
            parent = stack[-1]
            stack.append(len(sid))
            sid.append(skeleton.child.get((sid[parent], path[d * TURN:(d + 1) * TURN]), -1) if sid[parent] >= 0 else -1)
            up.append(parent)
            depth.append(d + 1)
            low.append(None)
            n.append(0)
            size.append(lens[d])
            end.append("")
        at, last = stack[-1], path
        end[at] = e
        n[at] += k
        low[at] = c if low[at] is None or (c is not None and c < low[at]) else low[at]
    children, leaves, saved = [0] * len(sid), [0] * len(sid), [0] * len(sid)
    for i in range(len(sid) - 1, -1, -1):
        p, outside = up[i], sid[i] < 0
        if outside:
            leaves[i] += children[i] == 0
            saved[i] += (n[i] - 1) * size[i]
        if p >= 0:
            n[p] += n[i]
            if low[i] is not None and (low[p] is None or low[i] < low[p]):
                low[p] = low[i]
            if outside:
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
    return {"sid": sid, "parent_sid": [sid[p] if p >= 0 else -1 for p in up], "conv_id": low, "depth": depth,
            "parent_conv_id": [low[p] if p >= 0 else None for p in up], "n_convs": n, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "chars": size, "ends_sha256": end}


_LONGS = ("sid", "parent_sid", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")
_NODE = ", ".join(f"{c} long" for c in _LONGS) + ", ends_sha256 string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The rows of :func:`walk` over all shards."""
    spark = paths.sparkSession
    shared = spark.sparkContext.broadcast(skeleton)

    def shard(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts = shared.value.splitters
        at = [bisect_right(cuts, p) for p in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *batch.columns], ["shard", *batch.schema.names])

    def nodes(group: pa.Table) -> pa.Table:
        cols = {k: group.column(k).to_pylist() for k in ("path", "chars", "conv_id", "n", "ends")}
        order = sorted(range(group.num_rows), key=cols["path"].__getitem__)
        found = walk(*([cols[k][i] for i in order] for k in ("path", "chars", "conv_id", "n", "ends")), shared.value)
        return pa.table({k: pa.array(v, pa.string() if k == "ends_sha256" else pa.int64()) for k, v in found.items()})

    dealt = map_batches(paths, shard, "shard long, path binary, chars array<long>, conv_id long, n long, ends string")
    return dealt.groupBy("shard").applyInArrow(nodes, _NODE)


def _finish(partial: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """``(sid, *COLUMNS)`` of the skeleton's nodes from their reduced partials:
    one pass from the leaves of the skeleton to its root."""
    rows = {r["sid"]: r for r in partial.collect()}
    own = [[0, 0, 0] for _ in skeleton.parents]  # children, leaves, saved
    for i in range(len(own) - 1, -1, -1):
        if i not in rows:
            continue
        r, mine = rows[i], own[i]
        mine[0] += r["n_children"]
        mine[1] += r["n_leaves"] + (mine[0] == 0)
        mine[2] += r["saved_tokens"] + (r["n_convs"] - 1) * r["chars"]
        p = skeleton.parents[i]
        if p >= 0:
            for j, x in enumerate((1, mine[1], mine[2])):
                own[p][j] += x
    return [(i, r["conv_id"], skeleton.depths[i], rows[skeleton.parents[i]]["conv_id"] if i else None, r["n_convs"],
             *own[i], r["ends_sha256"] or _EMPTY) for i, r in rows.items()]


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per trie node of ``(conv_id, turns)`` conversations, columns COLUMNS.

    conv_id is the smallest member of the node (null only if no member has an
    id); n_convs counts members, n_children its children, n_leaves the
    childless nodes of its subtree; saved_tokens sums (n_convs - 1) x code
    points of the last text over its subtree; ends_sha256 hashes the ids of
    the conversations that end there (a null id counts but is not listed).
    Conversations without turns are members of the root only.  Equal
    conversations each count.  An empty table has no node.  Not bounded: the
    turns of one conversation, 24 bytes each, are one row.
    """
    spark = convs.sparkSession
    paths = store(distinct_paths(convs), "trie-paths")
    total, turns = paths.agg(F.count("*"), F.coalesce(F.sum(F.size("chars")), F.lit(0))).first()
    skeleton = Skeleton(splitters(paths, math.ceil(turns / shard_turns), total))
    found = store(_shard_nodes(paths, skeleton), "trie-nodes")
    partial = (found.where("sid >= 0").groupBy("sid")
               .agg(F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), F.max("ends_sha256").alias("ends_sha256"),
                    *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))))
    top = spark.createDataFrame(_finish(partial, skeleton),
                                "sid long, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in COLUMNS))
    # as many rows as the skeleton, which was broadcast before
    above = F.broadcast(top.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("_above")))
    rest = (found.where("sid < 0").join(above, "parent_sid", "left")
            .withColumn("parent_conv_id", F.when(F.col("parent_sid") < 0, F.col("parent_conv_id")).otherwise(F.col("_above")))
            .withColumn("ends_sha256", F.when(F.col("ends_sha256") == "", _EMPTY).otherwise(F.col("ends_sha256"))))
    return rest.select(*COLUMNS).unionByName(top.select(*COLUMNS))


def prefix_trie(turns: DataFrame, every: int = 100, openings: int = 6, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """:func:`trie` of the conversations in ``(conv_id, turn, role, text)``
    rows, rebuilt by :func:`shared_openings`.

    Null roles and texts read as ''; turns of equal place are in the order of
    their names; repeated rows are turns of their own; rows without a conv_id
    form one conversation.  Other columns are ignored.
    """
    named = store(named_turns(turns), "trie-turns")
    return trie(shared_openings(conversations(named), every, openings), shard_turns)

"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they
belong to).  A small flow network routes each pattern's words to the quotas
of its sources; the first use of a word is cheap and each repetition costs
more (convex), so repeats only fill what fresh words cannot.  The flow of a
pattern is then turned into documents by a seeded hash order: every document
gets the full passes, and those up to a hash threshold one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditlens.llm.common import store, word_array

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Membership patterns that the driver's network may hold (about 200 bytes each).
MAX_PATTERNS = 1_000_000
_BUCKETS = 4096


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict:
    """Words per source: ``share`` of all words by weight; a source stops at
    ``most`` times its size and the excess is shared anew by weight until none
    is above.  Sources without words get 0."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, rest = {}, list(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not full:
            return out | {s: rest * weight[s] / total for s in free}
        for s in full:
            out[s] = float(most * sizes[s])
        rest -= sum(out[s] for s in full)
        free = [s for s in free if s not in full]
    return out


def route(patterns: dict[tuple, int], quota: dict, passes: int = 2) -> dict[tuple, dict]:
    """Min-cost flow: pattern -> {source: words}.

    Arcs: start -> pattern, one arc of the pattern's size per pass with cost
    1, 3, 5, ... (convex); pattern -> each of its sources; source -> end with
    its quota.  Only the first arc of a path costs anything, so paths of equal
    cost are those that start with the same pass: all of them are augmented
    together (blocking flows on levels), pass after pass.  A pattern whose only
    source has no other pattern is its own network, with the flow
    min(quota, passes x size)."""
    met: dict = {}
    for p in patterns:
        for s in p:
            met[s] = met.get(s, 0) + 1
    out: dict[tuple, dict] = {p: {s: 0 for s in p} for p in patterns}
    shared = {}
    for p, size in patterns.items():
        if len(p) == 1 and met[p[0]] == 1:
            out[p][p[0]] = min(quota[p[0]], passes * size)
        elif p:
            shared[p] = size
    node = {("p", p): 2 + i for i, p in enumerate(shared)}
    node |= {("s", s): 2 + len(shared) + i for i, s in enumerate(dict.fromkeys(s for p in shared for s in p))}
    graph: list[list[int]] = [[] for _ in range(2 + len(node))]
    to, room = [], []

    def arc(a: int, b: int, c: int) -> int:
        for x, y, r in ((a, b, c), (b, a, 0)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
        return len(to) - 2

    first = {p: arc(0, node["p", p], 0) for p in shared}
    routed = [(p, s, arc(node["p", p], node["s", s], passes * size)) for p, size in shared.items() for s in p]
    for kind, s in node:
        if kind == "s":
            arc(node["s", s], 1, quota[s])
    for _ in range(passes):
        for p, size in shared.items():
            room[first[p]] += size
        _augment(graph, to, room)
    for p, s, e in routed:
        out[p][s] = room[e ^ 1]
    return out


def _augment(graph: list[list[int]], to: list[int], room: list[int]) -> None:
    """Maximum flow from node 0 to node 1 over what ``room`` leaves: blocking
    flows on breadth-first levels until the end is out of reach."""
    while True:
        level = [-1] * len(graph)
        level[0], queue = 0, [0]
        for x in queue:
            for e in graph[x]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[1] < 0:
            return
        after, path, x = [0] * len(graph), [], 0
        while True:
            if x == 1:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                back = next(i for i, e in enumerate(path) if not room[e])
                x = to[path[back] ^ 1]
                del path[back:]
            while after[x] < len(graph[x]):
                e = graph[x][after[x]]
                if room[e] and level[to[e]] == level[x] + 1:
                    break
                after[x] += 1
            if after[x] < len(graph[x]):
                path.append(graph[x][after[x]])
                x = to[path[-1]]
            elif path:
                x = to[path.pop() ^ 1]
                after[x] += 1
            else:
                break


def _members(sources: DataFrame, col: str) -> Column:
    """The membership pattern: a sorted set of sources; a plain column is one source."""
    c = F.col(col)
    return F.array_sort(F.array_distinct(c)) if sources.schema[col].dataType.typeName() == "array" else F.array(c)


def _rank(id_col: str, text_col: str, seed: int) -> Column:
    """Seeded order of documents: a hash of id and text (equal rows are one unit)."""
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.xxhash64(F.col(text_col)))


def plan(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2) -> tuple[DataFrame, dict, dict]:
    """From rows ``(members, size, rank)``: the cut per pattern as a DataFrame
    ``(pattern, passes, cut)``, the source sizes and the targets.

    A document gets ``passes`` uses, and one more if its rank is at most
    ``cut``.  The cut is found on two levels: word totals of _BUCKETS rank
    ranges per pattern, then the ranks of the one range that holds the end of
    the pattern's flow; neither groups a pattern's rows in one task."""
    spark = sized.sparkSession
    low = F.lit(-2**63)
    bucket = F.shiftrightunsigned(F.col("rank").bitwiseXOR(low), 52)  # ranks in signed order -> 0 .. 4095
    totals = (sized.groupBy("members", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
              .checkpoint(eager=True))
    found = totals.groupBy("members").agg(F.sum("words").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r["members"] or ()): int(r["words"]) for r in
                sorted(found, key=lambda r: [(s is None, s or "") for s in r["members"] or ()])}
    sizes: dict = {}
    for p, words in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + words
    goal = targets(sizes, weights, share, most)
    flow = route(patterns, {s: round(goal[s]) for s in sorted(goal, key=lambda s: (s is None, s or ""))}, most)
    rows = []
    for p, words in patterns.items():
        total = sum(flow[p].values())
        passes = total // words if words else 0
        rows.append((list(p), int(passes), int(total - passes * words)))
    shares = spark.createDataFrame(rows, "pattern array<string>, passes long, rest long")
    order = Window.partitionBy("members").orderBy("bucket")
    edge = (totals.withColumn("before", F.sum("words").over(order) - F.col("words"))
            .join(shares, F.col("members").eqNullSafe(F.col("pattern")))
            .where("before < rest and rest <= before + words")
            .select("pattern", "passes", "rest", "before", F.col("bucket").alias("edge")))
    # the few ranks of the edge range: one more use while the total comes nearer to the rest
    near = (sized.withColumn("bucket", bucket)
            .join(F.broadcast(edge), F.col("members").eqNullSafe(F.col("pattern")) & (F.col("bucket") == F.col("edge")))
            .groupBy("pattern", "rest", "before", "rank").agg(F.sum("size").alias("words")))
    upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("rank"))
    inside = (near.withColumn("upto", F.col("before") + upto)
              .where(F.col("upto") - F.col("words") / 2 <= F.col("rest"))
              .groupBy("pattern").agg(F.max("rank").alias("last")))
    start = F.when(F.col("edge") > 0, F.shiftleft(F.col("edge"), 52).bitwiseXOR(low) - 1)  # just below the edge range
    cuts = (shares.join(edge.select("pattern", "edge"), "pattern", "left").join(inside, "pattern", "left")
            .select("pattern", "passes", F.coalesce("last", start).alias("cut")).collect())
    cut = spark.createDataFrame(cuts, "pattern array<string>, passes long, cut long")
    return cut, sizes, goal


def uses() -> Column:
    """Uses of a document, given ``passes``, ``cut`` and ``rank``."""
    return F.col("passes") + F.coalesce((F.col("rank") <= F.col("cut")).cast("long"), F.lit(0))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), _members(docs, source_col).alias("members"),
                       F.size(word_array(F.col(text_col))).cast("long").alias("size"),
                       _rank(id_col, text_col, seed).alias("rank"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """Per input row: ``doc_id, members, size, uses, taken`` (words taken,
    repeats counted) and, per source in code point order, ``source_sizes`` and
    ``targets`` as arrays parallel to ``members``.

    ``source_col`` is one source or an array of them; null is a source of its
    own (the last); an empty array belongs to no source and is never taken.
    Null texts have size 0.  Equal rows share their rank and are taken
    together.  The same input, seed and weights give the same mix.  An empty
    table gives an empty result.
    """
    sized = store(sized_rows(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cut, sizes, goal = plan(sized, weights, share, most)
    spark = docs.sparkSession
    facts = spark.createDataFrame(
        [(p["pattern"], p["passes"], p["cut"], [sizes[s] for s in p["pattern"]], [goal[s] for s in p["pattern"]])
         for p in cut.collect()],
        "pattern array<string>, passes long, cut long, source_sizes array<long>, targets array<double>")
    # one row per membership pattern, at most MAX_PATTERNS
    rows = sized.join(F.broadcast(facts), F.col("members").eqNullSafe(F.col("pattern")))
    return rows.select("doc_id", "members", "size", uses().alias("uses"), (F.col("size") * uses()).alias("taken"),
                       "source_sizes", "targets")


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     weights=WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """``docs`` (same columns) as the mix takes them: a row per use."""
    sized = store(sized_rows(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cut, _, _ = plan(sized, weights, share, most)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                        _members(docs, source_col).alias("members"), _rank(id_col, text_col, seed).alias("rank"))
    return (keyed.join(F.broadcast(cut), F.col("members").eqNullSafe(F.col("pattern")))
            .where(uses() > 0)
            .select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), uses())))
            .select("_doc.*"))

"""Deterministic, distributed replacements for random draws.

"Pick n rows at random" becomes "pick the n rows with the smallest
``md5(key || '|' || seed)``" of a group.  No row has to be ranked for that:
:func:`hash_at` finds the hash of the n-th row, and every row then decides on
its own by comparing hashes.

1. bucket = first 4 hex digits of the hash (65,536 buckets, uniform for
   distinct keys); rows are counted per (group, bucket), at most 65,536 counts
   per group;
2. the running total of the counts names the one bucket that holds the n-th
   row, and only that bucket's rows (about 1 / 65,536 of the group) are ranked.

The result equals ``row_number() OVER (PARTITION BY group ORDER BY hash) <= n``
for distinct keys (rows with equal keys are taken together).  NULL is a group
like any other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX = 4


def key_hash(key_cols: Sequence[str], seed) -> Column:
    parts = [F.col(c).cast("string") for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def key_hash_sql(key_cols: Sequence[str], seed) -> str:
    """DuckDB twin of :func:`key_hash`."""
    parts = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in key_cols)
    return f"md5({parts} || '|' || '{seed}')"


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed, out: str = "_rank",
              eligible: Column | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` = 1-based rank of md5(key|seed) among eligible rows of the
    row's group (NULL for rows that are not eligible)."""
    group_cols = list(group_cols)
    elig = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    d = (df.withColumn("_h", key_hash(key_cols, seed))
           .withColumn("_b", F.substring("_h", 1, BUCKET_HEX))
           .withColumn("_e", elig))
    counts = d.filter("_e").groupBy(*group_cols, "_b").agg(F.count("*").alias("_n"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy())
    w = w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    d = join_groups(d, before, group_cols + ["_b"], "left")
    wr = Window.partitionBy(*group_cols, "_b", "_e").orderBy("_h", *key_cols)
    rank = F.when(F.col("_e"), F.col("_before") + F.row_number().over(wr))
    return d.withColumn(out, rank.cast("long")).drop("_h", "_b", "_e", "_before")


def join_groups(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols`` where NULL equals NULL; ``right`` adds its other columns."""
    named = right.withColumnsRenamed({c: f"_r_{i}" for i, c in enumerate(cols)})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{i}")) for i, c in enumerate(cols)]
    return left.join(named, on, how).drop(*[f"_r_{i}" for i in range(len(cols))])


def hash_at(df: DataFrame, key_cols: Sequence[str], seed, points: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``points`` (group columns and ``n``) -> the same with ``cut``, the hash
    of the group's n-th row in hash order.  Points with n < 1 or beyond the
    group give no row."""
    groups = list(group_cols)
    if not groups:  # one group
        one = F.lit(1).alias("_one")
        return hash_at(df.select("*", one), key_cols, seed, points.select("*", one), ["_one"]).drop("_one")
    d = df.select(*groups, *[c for c in key_cols if c not in groups], key_hash(key_cols, seed).alias("_h"))
    d = d.withColumn("_b", F.substring("_h", 1, BUCKET_HEX))
    order = Window.partitionBy(*groups).orderBy("_b")  # at most 65,536 rows per group
    counts = (d.groupBy(*groups, "_b").agg(F.count("*").alias("_c"))
              .withColumn("_upto", F.sum("_c").over(order)))
    edge = (join_groups(counts, points, groups).where("_upto - _c < n and n <= _upto")
            .select(*groups, "n", F.col("_b").alias("_edge"), (F.col("n") - F.col("_upto") + F.col("_c")).alias("_left")))
    near = join_groups(d.withColumnRenamed("_b", "_edge"), edge, [*groups, "_edge"])
    rank = F.row_number().over(Window.partitionBy(*groups, "n").orderBy("_h", *key_cols))
    return near.withColumn("_rank", rank).where("_rank = _left").select(*groups, "n", F.col("_h").alias("cut"))


def _first_n(df: DataFrame, key_cols: Sequence[str], seed, n: int) -> Column:
    """Condition that holds for the ``n`` rows of ``df`` with the smallest hashes."""
    if n < 1:
        return F.lit(False)
    points = df.sparkSession.createDataFrame([(n,)], "n long")
    found = hash_at(df, key_cols, seed, points).first()
    return F.lit(True) if found is None else key_hash(key_cols, seed) <= found["cut"]


def flag_top_up(df: DataFrame, flag: str, key_cols: Sequence[str], quota: float, seed=42) -> DataFrame:
    """SMP-03: if the flagged share is below ``quota``, flag
    ``int(N*quota) - flagged`` more rows, taken from the unflagged rows in
    hash order.  Two counts and one hash reach the driver."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.col(flag)).alias("k")).first()
    n, k = int(row["n"] or 0), int(row["k"] or 0)
    needed = int(n * quota) - k
    if needed <= 0:
        return df
    open_ = F.col(flag) == 0
    chosen = _first_n(df.filter(open_), key_cols, seed, needed)
    return df.withColumn(flag, F.when(open_ & chosen, F.lit(1)).otherwise(F.col(flag)))


def _up_to(df: DataFrame, key_cols: Sequence[str], seed, group_cols: Sequence[str], n: Column) -> DataFrame:
    """``df`` plus ``_in``: whether a row is among its group's first ``n``
    (an expression of the group's size ``_size``)."""
    groups = list(group_cols)
    points = (df.groupBy(*groups).agg(F.count("*").alias("_size"))
              .select(*groups, F.least(n, F.col("_size")).cast("long").alias("n")))
    cuts = hash_at(df, key_cols, seed, points, groups).drop("n")
    inside = F.coalesce(key_hash(key_cols, seed) <= F.col("cut"), F.lit(False))
    return join_groups(df, cuts, groups, "left").withColumn("_in", inside).drop("cut")


def sample_per_group(df: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str],
                     n: int, seed=42) -> DataFrame:
    """SMP-01: n rows per group (all rows of smaller groups)."""
    return _up_to(df, key_cols, seed, group_cols, F.lit(n)).filter("_in").drop("_in")


def hash_fraction(key_cols: Sequence[str], seed) -> Column:
    """U[0,1) from the first 8 hex digits of the key hash (map-only)."""
    return F.conv(F.substring(key_hash(key_cols, seed), 1, 8), 16, 10).cast("double") / 4294967296.0


def hash_fraction_sql(key_cols: Sequence[str], seed) -> str:
    return f"CAST(('0x' || substr({key_hash_sql(key_cols, seed)}, 1, 8)) AS UBIGINT) / 4294967296.0"


def sample_fraction(df: DataFrame, key_cols: Sequence[str], fraction: float, seed=42) -> DataFrame:
    """SMP-02: deterministic fraction sample, no shuffle."""
    return df.filter(hash_fraction(key_cols, seed) < fraction)


def hash_split(df: DataFrame, key_cols: Sequence[str], test_fraction=0.2, seed=42,
               out: str = "is_test") -> DataFrame:
    """ML-02: random split as a column (stable under repartitioning)."""
    return df.withColumn(out, (hash_fraction(key_cols, seed) < test_fraction).cast("int"))


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], test_fraction=0.2,
                     seed=42, out: str = "is_test") -> DataFrame:
    """ML-03: per class, the ceil(p * n_class) rows of smallest hash are test
    rows (rows without a label are a class of their own)."""
    marked = _up_to(df, key_cols, seed, [label], F.ceil(F.col("_size") * test_fraction))
    return marked.withColumn(out, F.col("_in").cast("int")).drop("_in")


def stratified_three_way(df: DataFrame, label: str, key_cols: Sequence[str], test_fraction: float, val_fraction: float,
                         seed, test: str, val: str) -> DataFrame:
    """ML-03 twice from one hash: ``test`` (0 / 1) as :func:`stratified_split`,
    and ``val`` (boolean), per class the next ceil(p * rest) rows."""
    first = F.ceil(F.col("_size") * test_fraction).cast("long")
    points = (df.groupBy(label).agg(F.count("*").alias("_size")).withColumn("_test", first)
              .withColumn("_val", F.col("_test") + F.ceil((F.col("_size") - F.col("_test")) * val_fraction).cast("long")))
    both = points.select(label, F.explode(F.array("_test", "_val")).alias("n")).distinct()
    cuts = (hash_at(df, key_cols, seed, both, [label]).groupBy(label)
            .agg(F.min("cut").alias("_cut_test"), F.max("cut").alias("_cut_val")))
    h = key_hash(key_cols, seed)
    inside = lambda c: F.coalesce(h <= F.col(c), F.lit(False))
    return (join_groups(df, cuts, [label], "left")
            .withColumns({test: inside("_cut_test").cast("int"), val: inside("_cut_val") & ~inside("_cut_test")})
            .drop("_cut_test", "_cut_val"))


# ------------------------------------------------------------ rebalancing

# Target share per segment
TARGET_SHARES = {0: 0.15, 1: 0.25, 2: 0.45, 3: 0.15}
SEGMENTS = tuple(TARGET_SHARES)


@dataclass(frozen=True)
class Move:
    """``n`` rows of the segments ``source`` become ``to``; ``seed`` orders them."""
    source: tuple
    to: int
    n: int
    seed: object


def segment_counts(df: DataFrame, label: str) -> Counter:
    return Counter({int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect() if r[0] is not None})


def plan_moves(start: Counter, shortfall: Callable, donors: Callable) -> list[Move]:
    """Moves that fill each segment's ``shortfall(segment, share, live)`` from
    its ``donors(segment, share, live)`` in order, each giving at most half of
    what it holds at that point.  ``share`` is the share before any move,
    ``live`` the counts so far."""
    total, live, moves = sum(start.values()), Counter(start), []
    share = {s: start[s] / total if total else 0.0 for s in SEGMENTS}
    for to in SEGMENTS:
        missing = shortfall(to, share, live)
        for source in donors(to, share, live):
            part = min(missing, live[source] // 2)
            if part > 0:
                moves.append(Move((source,), to, part, to * 100 + source))
                live[source] -= part
                live[to] += part
                missing -= part
    return moves


def apply_moves(df: DataFrame, label: str, key_cols: Sequence[str], moves: list[Move]) -> DataFrame:
    """All moves as one projection: a move is a hash limit found beforehand,
    so the plan reads its input once however many moves there are."""
    for m in moves:
        pool = F.col(label).isin(*m.source)
        chosen = _first_n(df.filter(pool), key_cols, m.seed, m.n)
        df = df.withColumn(label, F.when(pool & chosen, F.lit(m.to)).otherwise(F.col(label)))
    return df


def fill_empty_segments(df: DataFrame, label: str, key_cols: Sequence[str], seed=42,
                        share=0.05) -> DataFrame:
    """SMP-04(a): an empty segment receives max(int(N*share), 1) rows, from
    segment 2 (for 0 and 1) or from segments 0 and 1 together (for 2 and 3)."""
    live = segment_counts(df, label)
    amount = max(int(sum(live.values()) * share), 1)
    for to in SEGMENTS:
        pool = (2,) if to < 2 else (0, 1)
        part = 0 if live[to] else min(amount, sum(live[s] for s in pool))
        if part:
            df = apply_moves(df, label, key_cols, [Move(pool, to, part, f"{seed}-{to}")])
            live = segment_counts(df, label)
    return df


def rebalance_small_segments(df: DataFrame, label: str, key_cols: Sequence[str]) -> DataFrame:
    """SMP-04(b): a segment that starts below 5 % receives int(N*target)
    rows; donors are the segments that start with rows, largest first."""
    start = segment_counts(df, label)
    total = sum(start.values())
    return apply_moves(df, label, key_cols, plan_moves(
        start,
        lambda to, share, live: int(total * TARGET_SHARES[to]) if share[to] * 100 < 5.0 else 0,
        lambda to, share, live: sorted((s for s in SEGMENTS if s != to and start[s]), key=lambda s: -start[s])))


def rebalance_under_half(df: DataFrame, label: str, key_cols: Sequence[str]) -> DataFrame:
    """SMP-04(c): a segment under half its target share is filled up to the
    target; donors are the segments above their own target at that point."""
    start = segment_counts(df, label)
    total = max(sum(start.values()), 1)
    above = lambda s, live: live[s] / total > TARGET_SHARES[s]
    return apply_moves(df, label, key_cols, plan_moves(
        start,
        lambda to, share, live: (int(total * TARGET_SHARES[to]) - live[to]
                                 if live[to] / total < TARGET_SHARES[to] * 0.5 else 0),
        lambda to, share, live: [s for s in SEGMENTS if s != to and above(s, live)]))

"""Second-order gradient boosting on distributed histograms.

Trees are grown level by level as in the published second-order method: every
row has a gradient g and a hessian h of the loss at its present margin, a leaf
with sums G and H has the weight -T(G) / (H + l2), T the soft threshold by l1,
and a split is worth what it adds to the sum of T(G)^2 / (H + l2) / 2.

* Features are cut once into at most ``bins`` quantile bins (plus one for
  missing values, which take the better side of each split).  The binned rows
  are kept as blocks of packed columns, one small row per block.
* A level is one job of one stage: each task sums g and h per (class, node,
  feature, bin) over its blocks and the tasks' sums are added.  Only these
  histograms, whose size does not follow the rows, reach the driver, which
  picks the splits.  Up to TASK_BLOCKS blocks are summed faster than a job is
  started, so there the same loop over the same sums runs in one task instead
  of a job per level; the model is equal.
* g and h are rounded to integer multiples of a power of two before they are
  summed, so no result depends on the order of rows, tasks or retries.
* Margins are a function of the block and the trees so far, and so are a
  round's sampled rows, their g and h and their nodes.  A worker keeps those of
  the blocks it has seen and adds the trees and levels that are new; a lost
  worker costs only their recomputation.
* The classes of a multi-class model share their softmax margins: a round
  grows one tree per class from the same probabilities.
* Validation rows are scored in the pass that starts the next round, and the
  fit stops when ``patience`` rounds brought no lower loss: the model is the
  prefix up to the best round, without a second fit.

Row samples are hashes of (key, round), column samples seeded draws per tree.
"""

from __future__ import annotations

import json
import operator
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.session import ship

#: Rows of a block, and the most blocks that one task fits alone.
BLOCK_ROWS, TASK_BLOCKS = 65_536, 4
#: Sums of more tasks than this are added on the executors first.
GATHER = 64
#: Bytes that a worker keeps of its blocks.
KEEP_BYTES = 256 << 20
#: Rank error of the quantile cuts is 1 / ACCURACY.
ACCURACY = 10_000
#: Sums stay below 2 ** EXACT, where doubles hold every integer.
EXACT = 52


@dataclass
class Params:
    """``loss`` is squared, logistic or softmax (then ``classes`` > 2)."""
    loss: str = "squared"
    classes: int = 1
    rounds: int = 100
    depth: int = 5
    step: float = 0.1
    rows: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    min_hessian: float = 1.0
    min_gain: float = 1e-6
    bins: int = 64
    patience: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """A complete binary tree as a heap: node i has the children 2i + 1 and
    2i + 2; ``feature`` is -1 at a leaf.  Bins up to ``cut`` go left."""
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def leaf_of(self, binned: np.ndarray, missing: int, at: np.ndarray | None = None) -> np.ndarray:
        """The heap index of each row's leaf, from the nodes ``at`` or the root; ``binned`` is features x rows."""
        n = binned.shape[1]
        at = np.zeros(n, np.int64) if at is None else at
        rows, flat = np.arange(n), binned.reshape(-1)
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            x = flat.take(np.where(inner, feature, 0).astype(np.int64) * n + rows)
            left = np.where(x == missing, self.missing_left[at], x <= self.cut[at])
            at = np.where(inner, 2 * at + 2 - left, at)


@dataclass
class Boosted:
    """A fitted model: ``trees[round][class]``."""
    params: Params
    features: list[str]
    cuts: list[np.ndarray]
    base: list[float]
    trees: list[list[Tree]]
    losses: list[float] = field(default_factory=list)        # validation loss after each round
    train_losses: list[float] = field(default_factory=list)  # training loss after each round

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def treeWeights(self) -> list[float]:
        """The step is part of the leaf values."""
        return [1.0] * len(self.trees)

    @property
    def stages(self) -> list[Boosted]:
        return [self]

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def importances(self) -> dict[str, float]:
        """Mean gain of a feature's splits, normalised to sum 1."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in (t for several in self.trees for t in several):
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = total / np.maximum(count, 1)
        return dict(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))

    def margins(self, binned: np.ndarray) -> np.ndarray:
        """classes x rows."""
        out = np.repeat(np.array(self.base)[:, None], binned.shape[1], axis=1)
        return _add_trees(out, binned, self.trees, self.params.bins)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with one more column: the predicted value (squared loss), the
        probability of class 1 (logistic) or the array of class probabilities
        (softmax).  Null and NaN features are missing values."""
        if output in df.columns:
            raise ValueError(f"column {output} is there already")
        ship(df.sparkSession)
        many = self.params.loss == "softmax"
        inputs = [f"_x{i}" for i in range(len(self.features))]
        kind = "array<double>" if many else "double"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                binned = bin_columns([batch.column(i) for i in range(len(self.cuts))], self.cuts, self.params.bins)
                out = _respond(self.margins(binned), self.params.loss)
                column = (pa.array(list(out.T), pa.list_(pa.float64())) if many else pa.array(out[0]))
                yield pa.RecordBatch.from_arrays([*batch.columns[len(self.cuts):], column], [*batch.schema.names[len(self.cuts):], output])

        wide = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(self.features, inputs)], *[F.col(f"`{c}`") for c in df.columns])
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return wide.mapInArrow(run, f"{schema}, `{output}` {kind}")

    def table(self) -> list[tuple]:
        """``(round, class, node, feature, threshold, missing_left, gain, value)`` of every node."""
        out = []
        for r, several in enumerate(self.trees):
            for k, t in enumerate(several):
                live = [0]
                for i in live:
                    f = int(t.feature[i])
                    if f >= 0:
                        live += [2 * i + 1, 2 * i + 2]
                    out.append((r, k, i, self.features[f] if f >= 0 else None, float(self.cuts[f][t.cut[i]]) if f >= 0 else None,
                                bool(t.missing_left[i]) if f >= 0 else None, float(t.gain[i]), float(t.value[i])))
        return out

    def to_dict(self) -> dict:
        trees = [[{k: getattr(t, k).tolist() for k in ("feature", "cut", "missing_left", "value", "gain")} for t in several]
                 for several in self.trees]
        return {"params": asdict(self.params), "features": self.features, "cuts": [c.tolist() for c in self.cuts],
                "base": self.base, "trees": trees, "losses": self.losses, "train_losses": self.train_losses}

    @classmethod
    def from_dict(cls, d: dict) -> Boosted:
        kinds = {"feature": np.int16, "cut": np.uint8, "missing_left": bool, "value": float, "gain": float}
        trees = [[Tree(**{k: np.array(t[k], kind) for k, kind in kinds.items()}) for t in several] for several in d["trees"]]
        return cls(Params(**d["params"]), list(d["features"]), [np.array(c, float) for c in d["cuts"]], list(d["base"]), trees,
                   list(d["losses"]), list(d["train_losses"]))


# ---------------------------------------------------------------- binning

def bin_columns(columns: Sequence[pa.Array], cuts: Sequence[np.ndarray], bins: int) -> np.ndarray:
    """features x rows: the number of cuts below each value; ``bins`` where it is missing."""
    out = np.empty((len(cuts), len(columns[0]) if columns else 0), np.uint8)
    for i, (column, cut) in enumerate(zip(columns, cuts)):
        x = column.to_numpy(zero_copy_only=False).astype(float)
        out[i] = np.where(np.isnan(x), bins, np.searchsorted(cut, x, side="left"))
    return out


def quantile_cuts(train: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` ascending cut points per feature, values of the
    training rows: a value goes left of a cut that it does not exceed."""
    shares = [i / bins for i in range(1, bins)]
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = train.agg(*[F.percentile_approx(value(c), shares, ACCURACY).alias(f"c{i}") for i, c in enumerate(features)],
                    *[F.max(value(c)).alias(f"m{i}") for i, c in enumerate(features)]).first()
    out = []
    for i in range(len(features)):
        found = np.unique(np.array(row[f"c{i}"] or [], float))
        out.append(found[found < row[f"m{i}"]] if len(found) else found)  # nothing lies right of the largest value
    return out


def _blocks(df: DataFrame, keys: Sequence[str], features: Sequence[str], cuts: list[np.ndarray], bins: int) -> DataFrame:
    """``(block, binned, y, w, key, val)``: packed columns of up to BLOCK_ROWS rows."""
    n = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held, seq = [], 0

        def pack(rows: pa.Table) -> pa.RecordBatch:
            cols = [rows.column(i).combine_chunks() for i in range(rows.num_columns)]
            blobs = [bin_columns(cols[:n], cuts, bins).tobytes(), *(np.ascontiguousarray(
                c.to_numpy(zero_copy_only=False), kind).tobytes() for c, kind in zip(cols[n:], ("f8", "f8", "i8", "?")))]
            at = TaskContext.get().partitionId() << 32 | seq
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *(pa.array([b], pa.binary()) for b in blobs)],
                                              ["block", "binned", "y", "w", "key", "val"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK_ROWS:
                table = pa.Table.from_batches(held)
                yield pack(table.slice(0, BLOCK_ROWS))
                held, seq = table.slice(BLOCK_ROWS).to_batches(), seq + 1
        if sum(b.num_rows for b in held):
            yield pack(pa.Table.from_batches(held))

    rows = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)],
                     F.col("label").cast("double").alias("y"), F.col("weight").cast("double").alias("w"),
                     F.xxhash64(*keys).alias("key"), F.col("is_val").alias("val"))
    return rows.mapInArrow(run, "block long, binned binary, y binary, w binary, key binary, val binary")


# ---------------------------------------------------------------- loss

def _respond(margins: np.ndarray, loss: str) -> np.ndarray:
    if loss == "softmax":
        e = np.exp(margins - margins.max(axis=0))
        return e / e.sum(axis=0)
    return 1.0 / (1.0 + np.exp(-margins)) if loss == "logistic" else margins


def gradients(margins: np.ndarray, y: np.ndarray, w: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """g and h, classes x rows."""
    p = _respond(margins, loss)
    if loss == "squared":
        return (p - y) * w, np.broadcast_to(w, p.shape).copy()
    if loss == "logistic":
        return (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w
    return (p - (np.arange(len(p))[:, None] == y)) * w, np.maximum(2 * p * (1 - p), 1e-16) * w


def row_losses(margins: np.ndarray, y: np.ndarray, loss: str) -> np.ndarray:
    p = _respond(margins, loss)
    if loss == "squared":
        return (p[0] - y) ** 2
    right = p[0] * y + (1 - p[0]) * (1 - y) if loss == "logistic" else p[y.astype(int), np.arange(len(y))]
    return -np.log(np.maximum(right, 1e-15))


def _add_trees(margins: np.ndarray, binned: np.ndarray, rounds: Sequence[Sequence[Tree]], bins: int) -> np.ndarray:
    for several in rounds:
        for k, tree in enumerate(several):
            margins[k] += tree.value[tree.leaf_of(binned, bins)]
    return margins


def in_sample(key: np.ndarray, share: float, rnd: int, seed: int) -> np.ndarray:
    """Rows of a round's sample: a mix of key, round and seed below ``share``."""
    if share >= 1:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        z = key.view(np.uint64) + np.uint64((rnd * 1_000_003 + seed) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(float) / 2.0**53 < share


# ---------------------------------------------------------------- one level

_KEPT: OrderedDict = OrderedDict()


@dataclass
class _Kept:
    """What a worker keeps of a block: its margins after ``done`` rounds and,
    of the round that follows, the sampled rows' bins, g, h and node per class."""
    done: int
    margins: np.ndarray
    part: np.ndarray | None = None
    g: np.ndarray | None = None
    h: np.ndarray | None = None
    at: list[np.ndarray] | None = None

    @property
    def nbytes(self) -> int:
        return self.margins.nbytes + (0 if self.part is None else self.part.nbytes + self.g.nbytes + 2 * self.h.nbytes)


def _kept(fit: str, block: int, binned: np.ndarray, base: list[float], trees: list, bins: int) -> _Kept:
    """The block's margins after ``trees``, from those this worker kept."""
    kept = _KEPT.pop((fit, block), None)
    if kept is None or kept.done > len(trees):
        kept = _Kept(0, np.repeat(np.array(base)[:, None], binned.shape[1], axis=1))
    if kept.done < len(trees):
        kept = _Kept(len(trees), _add_trees(kept.margins, binned, trees[kept.done:], bins))
    _KEPT[fit, block] = kept
    while len(_KEPT) > 1 and sum(k.nbytes for k in _KEPT.values()) > KEEP_BYTES:
        _KEPT.popitem(last=False)
    return kept


@dataclass
class _Level:
    """What a task needs to sum one level.  ``nodes[k]`` lists the heap indices
    that are still open in class k's tree, ``columns[k]`` the features it may split."""
    fit: str
    params: Params
    base: list[float]
    trees: list
    growing: list[Tree]
    nodes: list[list[int]]
    columns: np.ndarray
    scale: float
    loss_scale: float
    n_features: int

    def sums(self, block: int, blobs: Sequence[bytes]) -> np.ndarray:
        """The sums of one block as one array of integers: loss and weight of
        the validation rows, of the training rows (at the root, else 0), then g
        and then h by class, open node, feature and bin."""
        p, width = self.params, self.params.bins + 1
        y, w, key, val = (np.frombuffer(b, kind) for b, kind in zip(blobs[1:], ("f8", "f8", "i8", "?")))
        binned = np.frombuffer(blobs[0], np.uint8).reshape(self.n_features, len(y))
        kept = _kept(self.fit, block, binned, self.base, self.trees, p.bins)
        out = np.zeros(4 + 2 * sum(map(len, self.nodes)) * self.n_features * width, np.int64)
        if self.nodes[0] == [0] and len(self.nodes) == p.classes:
            loss = np.rint(row_losses(kept.margins, y, p.loss) * w * self.loss_scale)
            for i, mask in enumerate((val, ~val)):
                out[2 * i:2 * i + 2] = int(loss[mask].sum()), int(np.rint(w[mask] * 2**20).sum())
        if kept.part is None:
            use = np.flatnonzero(~val & in_sample(key, p.rows, len(self.trees), p.seed))
            g, h = gradients(kept.margins[:, use], y[use], w[use], p.loss)
            kept.part, kept.g, kept.h = binned[:, use], np.rint(g * self.scale), np.rint(h * self.scale)
            kept.at = [np.zeros(len(use), np.int64) for _ in range(p.classes)]
        cells, first = out[4:].reshape(2, -1, self.n_features, width), 0
        for k, open_nodes in enumerate(self.nodes):
            if open_nodes:
                n = len(open_nodes)
                number = np.full(2 ** (p.depth + 1) - 1, -1)
                number[open_nodes] = np.arange(n)
                kept.at[k] = self.growing[k].leaf_of(kept.part, p.bins, kept.at[k])
                node = number[kept.at[k]]
                live = np.flatnonzero(node >= 0)
                base, gk, hk = node[live] * width, kept.g[k][live], kept.h[k][live]
                for f in range(self.n_features):
                    if f and not self.columns[k, f]:  # the first feature also gives the nodes' totals
                        continue
                    cell = base + kept.part[f].take(live)
                    for total, x in zip(cells, (gk, hk)):
                        total[first:first + n, f] = np.bincount(cell, x, n * width).reshape(n, width)
                first += n
        return out


def _blobs(batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
    for i in range(batch.num_rows):
        block, *blobs = (c[i] for c in batch.columns)
        yield block.as_py(), [b.as_buffer() for b in blobs]


def _added(blocks: RDD) -> Callable[[_Level], np.ndarray]:
    """Sums of a level over all blocks, one array per task."""
    def sums(level: _Level) -> np.ndarray:
        def run(rows: Iterator[tuple]) -> Iterator[np.ndarray]:
            total = None
            for block, *blobs in rows:
                found = level.sums(block, blobs)
                total = found if total is None else total + found
            if total is not None:
                yield total

        found = blocks.mapPartitions(run)
        return found.treeReduce(operator.add) if blocks.getNumPartitions() > GATHER else sum(found.collect())
    return sums


def _in_one_task(blocks: DataFrame, start: _Start) -> Boosted:
    """The whole loop in the task of the only partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for batch in batches for x in _blobs(batch)]
        model = _boost(start, lambda level: sum(level.sums(*x) for x in held))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model.to_dict())])], ["model"])
    return Boosted.from_dict(json.loads(blocks.mapInArrow(run, "model string").first()["model"]))


def soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_splits(g: np.ndarray, h: np.ndarray, columns: np.ndarray, p: Params):
    """``(gain, feature, cut, missing_left, left sums, right sums)`` per node of
    histograms ``nodes x features x (bins + 1)``; of equal gains the first
    feature, then the lowest cut, then missing values right."""
    total_g, total_h = g[:, :1].sum(axis=2), h[:, :1].sum(axis=2)  # nodes x 1
    score = lambda a, b: soft(a, p.l1) ** 2 / (b + p.l2)
    left_g, left_h = (np.cumsum(x[:, :, :-1], axis=2)[:, :, :-1] for x in (g, h))
    left_g, left_h = (np.stack([a, a + x[:, :, -1:]], axis=3) for a, x in ((left_g, g), (left_h, h)))
    right_g, right_h = total_g[:, :, None, None] - left_g, total_h[:, :, None, None] - left_h
    with np.errstate(invalid="ignore", divide="ignore"):  # empty sides are masked below
        gain = 0.5 * (score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)[:, :, None, None])
    gain = np.where((left_h >= p.min_hessian) & (right_h >= p.min_hessian) & columns[None, :, None, None], gain, -np.inf)
    flat = gain.reshape(len(g), -1)
    at = flat.argmax(axis=1)
    feature, cut, side = np.unravel_index(at, gain.shape[1:])
    pick = lambda x: x.reshape(len(g), -1)[np.arange(len(g)), at]
    return pick(gain), feature, cut, side.astype(bool), (pick(left_g), pick(left_h)), (pick(right_g), pick(right_h))


def fit(df: DataFrame, keys: Sequence[str], features: Sequence[str], params: Params) -> Boosted:
    """Fit on ``df`` with columns ``label`` (class numbers from 0 for logistic
    and softmax), optionally ``weight`` and ``is_val`` (rows that only decide
    when to stop), and ``keys`` (for the row samples).  Rows without a label,
    or with a null or zero weight, are left out; null or NaN features are
    missing values.  Without training rows the model is its base."""
    p, spark = params, df.sparkSession
    ship(spark)
    if "weight" not in df.columns:
        df = df.withColumn("weight", F.lit(1.0))
    if "is_val" not in df.columns:
        df = df.withColumn("is_val", F.lit(False))
    df = df.where("label is not null and not isnan(label) and weight > 0").withColumn("is_val", F.coalesce("is_val", F.lit(False)))
    train = df.where(~F.col("is_val"))
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    facts = train.agg(F.count("*").alias("n"), F.min("label").cast("double").alias("lo"), F.max("label").cast("double").alias("hi"),
                      exact(F.col("label") * F.col("weight")).alias("wy"), exact(F.col("weight")).alias("w"),
                      F.max("weight").cast("double").alias("top")).first()
    n_val = df.where("is_val").count()
    base = [0.0] * p.classes
    if p.loss == "squared" and facts["n"]:
        base = [facts["wy"] / facts["w"]]
    cuts = quantile_cuts(train, features, p.bins) if facts["n"] else [np.zeros(0)] * len(features)
    model = Boosted(p, list(features), cuts, base, [])
    if not facts["n"]:
        return model
    span = (facts["hi"] - facts["lo"] or 1.0) if p.loss == "squared" else 1.0
    rows = facts["n"] + n_val
    power = lambda bound: 2.0 ** np.floor(EXACT - np.log2(rows * facts["top"] * bound))
    scale, loss_scale = power(4 * span if p.loss == "squared" else 2.0), power((4 * span) ** 2 if p.loss == "squared" else 40.0)
    start = _Start(p, list(features), cuts, base, n_val > 0, float(scale), float(loss_scale))
    alone = rows <= TASK_BLOCKS * BLOCK_ROWS
    parts = 1 if alone else min(-(-rows // BLOCK_ROWS), spark.sparkContext.defaultParallelism)
    laid = df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df
    blocks = _blocks(laid, keys, features, cuts, p.bins)
    if alone:
        return _in_one_task(blocks, start)
    packed = blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _boost(start, _added(packed))
    finally:
        packed.unpersist()


@dataclass
class _Start:
    """What the loop begins with."""
    params: Params
    features: list[str]
    cuts: list[np.ndarray]
    base: list[float]
    validate: bool
    scale: float
    loss_scale: float


def _boost(start: _Start, sums: Callable[[_Level], np.ndarray]) -> Boosted:
    """Rounds of trees from the ``sums`` of their levels."""
    p, scale, loss_scale = start.params, start.scale, start.loss_scale
    model = Boosted(p, start.features, start.cuts, start.base, [])
    name, draw = uuid.uuid4().hex, np.random.default_rng(p.seed)
    width, n_features = p.bins + 1, len(start.features)
    take = max(1, round(p.columns * n_features))
    best, best_loss, wanted = 0, np.inf, p.rounds if n_features else 0
    for rnd in range(wanted + 1):
        growing = [Tree.empty(p.depth) for _ in range(p.classes)]
        nodes: list[list[int]] = [[0] for _ in range(p.classes)]
        columns = np.zeros((p.classes, n_features), bool)
        for k in range(p.classes):
            columns[k, np.sort(draw.permutation(n_features)[:take])] = True
        for depth in range(p.depth):
            found = sums(_Level(name, p, start.base, model.trees, growing, nodes, columns, scale, loss_scale, n_features))
            if depth == 0 and rnd:
                val_loss, train_loss = (float(a / loss_scale / (b / 2**20 or 1.0)) for a, b in found[:4].reshape(2, 2))
                model.train_losses.append(train_loss)
                if start.validate:
                    model.losses.append(val_loss)
                    if val_loss < best_loss:
                        best, best_loss = rnd, val_loss
                    if (p.patience is not None and rnd - best >= p.patience) or rnd == wanted:
                        model.trees = model.trees[:best]
                        return model
            if rnd == wanted:
                return model
            cells = found[4:].reshape(2, -1, n_features, width) / scale
            at = 0
            for k in range(p.classes):
                if nodes[k]:
                    hist = cells[:, at:at + len(nodes[k])]
                    at += len(nodes[k])
                    nodes[k] = _grow(growing[k], nodes[k], hist, columns[k], p, last=depth + 1 == p.depth)
            if not any(nodes):
                break
        model.trees.append(growing)
    return model


def _grow(tree: Tree, nodes: list[int], hist: np.ndarray, columns: np.ndarray, p: Params, last: bool) -> list[int]:
    """Split the open ``nodes`` of one level; returns the nodes that are open next."""
    weight = lambda g, h: -p.step * float(soft(g, p.l1)) / (h + p.l2) if h + p.l2 > 0 else 0.0
    gain, feature, cut, missing, left, right = best_splits(hist[0], hist[1], columns, p)
    opened = []
    for i, node in enumerate(nodes):
        if node == 0:
            tree.value[0] = weight(hist[0, i, 0].sum(), hist[1, i, 0].sum())
        if not gain[i] > p.min_gain:
            continue
        tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = feature[i], cut[i], missing[i], gain[i]
        for child, (g, h) in ((2 * node + 1, left), (2 * node + 2, right)):
            tree.value[child] = weight(g[i], h[i])
            if not last:
                opened.append(child)
    return opened

"""The booster against a plain recursive one, its losses, stops and round trips."""
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.operators import boosting as B


def table(seed, n, classes=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.choice((0.0, 1.0, 2.0)), rng.uniform(-5, 5)
        if classes:
            label = float(min(classes - 1, int(abs(a) + b / 2 + rng.random() / 2)))
        else:
            label = 3 * a + (b == 1) * c + rng.gauss(0, .1)
        rows.append((i, None if rng.random() < .1 else a, b, float("nan") if rng.random() < .05 else c, label,
                     rng.choice((1.0, 2.0)), rng.random() < .25))
    return rows


COLUMNS = "user_id long, a double, b double, c double, label double, weight double, is_val boolean"


def brute(rows, cuts, p, base):
    """Recursive growth over plain lists; returns the split table."""
    missing = lambda v: v is None or math.isnan(v)
    xs = [r[1:4] for r in rows if not r[6]]
    ys, ws = [r[4] for r in rows if not r[6]], [r[5] for r in rows if not r[6]]
    margins = [list(base) for _ in xs]
    soft = lambda g: math.copysign(max(abs(g) - p.l1, 0), g)
    score = lambda g, h: soft(g) ** 2 / (h + p.l2)
    out = []
    for rnd in range(p.rounds):
        grads = []
        for m, y, w in zip(margins, ys, ws):
            if p.loss == "squared":
                grads.append([((m[0] - y) * w, w)])
            elif p.loss == "logistic":
                q = 1 / (1 + math.exp(-m[0]))
                grads.append([((q - y) * w, q * (1 - q) * w)])
            else:
                e = [math.exp(v) for v in m]
                q = [v / sum(e) for v in e]
                grads.append([((v - (y == k)) * w, 2 * v * (1 - v) * w) for k, v in enumerate(q)])
        for k in range(p.classes):
            def grow(node, members, depth):
                g, h = (sum(grads[i][k][j] for i in members) for j in (0, 1))
                value = -p.step * soft(g) / (h + p.l2)
                best = None
                if depth < p.depth:
                    for f in range(3):
                        for cut in cuts[f]:
                            for missing_left in (False, True):
                                left = [i for i in members if (missing_left if missing(xs[i][f]) else xs[i][f] <= cut)]
                                gl, hl = (sum(grads[i][k][j] for i in left) for j in (0, 1))
                                if hl < p.min_hessian or h - hl < p.min_hessian:
                                    continue
                                gain = .5 * (score(gl, hl) + score(g - gl, h - hl) - score(g, h))
                                if best is None or gain > best[0] + 1e-9:
                                    best = gain, f, cut, missing_left, left
                if best and best[0] > p.min_gain:
                    out.append((rnd, k, node, "abc"[best[1]], round(best[2], 9), best[3], round(best[0], 4), round(value, 6)))
                    grow(2 * node + 1, best[4], depth + 1)
                    grow(2 * node + 2, sorted(set(members) - set(best[4])), depth + 1)
                else:
                    out.append((rnd, k, node, None, None, None, 0.0, round(value, 6)))
                    for i in members:
                        step[i][k] = value
            step = step if k else [[0.0] * p.classes for _ in xs]
            grow(0, list(range(len(xs))), 0)
        margins = [[a + b for a, b in zip(m, s)] for m, s in zip(margins, step)]
    return sorted(out, key=lambda r: r[:3])


@pytest.mark.parametrize("loss, classes, l1, l2", [("squared", 1, 0.1, 1.0), ("squared", 1, 25.0, 0.0), ("logistic", 1, 0.1, 1.0),
                                                   ("softmax", 3, 0.1, 1.0)])
def test_split_tables_equal_a_brute_force_booster(spark, monkeypatch, loss, classes, l1, l2):
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)  # several blocks and partitions
    rows = table(7, 260, {"squared": 0, "logistic": 2, "softmax": 3}[loss])
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    p = B.Params(loss=loss, classes=classes, rounds=3, depth=3, step=0.3, l1=l1, l2=l2, bins=8)
    model = B.fit(df, ["user_id"], ["a", "b", "c"], p)
    want = brute(rows, [c.tolist() for c in model.cuts], p, model.base)
    got = sorted(((r, k, i, f, None if t is None else round(t, 9), m, round(g, 4), round(v, 6))
                  for r, k, i, f, t, m, g, v in model.table()), key=lambda r: r[:3])
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert all(abs(a[6] - b[6]) < 2e-3 and abs(a[7] - b[7]) < 2e-5 for a, b in zip(got, want))
    assert any(r[5] for r in got)  # some split sends missing values left


def test_l1_zeroes_small_leaves_and_l2_shrinks(spark):
    df = spark.createDataFrame(table(3, 200), COLUMNS)
    values = {}
    for l1, l2 in ((0.0, 0.0), (0.0, 50.0), (40.0, 0.0)):
        m = B.fit(df, ["user_id"], ["a", "b", "c"], B.Params(rounds=1, depth=2, l1=l1, l2=l2))
        values[l1, l2] = [abs(r[7]) for r in m.table()]
    assert max(values[0.0, 50.0]) < max(values[0.0, 0.0]) and max(values[40.0, 0.0]) < max(values[0.0, 0.0])
    assert B.soft(np.array([-3.0, -0.5, 0.5, 2.0]), 1.0).tolist() == [-2.0, 0.0, 0.0, 1.0]


def test_results_do_not_depend_on_the_layout(spark):
    rows = table(5, 500, 3)
    p = B.Params(loss="softmax", classes=3, rounds=4, depth=3, rows=0.7, columns=0.67)
    fits = [B.fit(spark.createDataFrame(r, COLUMNS).repartition(n), ["user_id"], ["a", "b", "c"], p).table()
            for r, n in ((rows, 1), (rows[::-1], 7))]
    assert fits[0] == fits[1]


def test_the_loop_gives_one_model_in_a_task_and_on_the_driver(spark, monkeypatch):
    rows = table(6, 400, 2)
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    p = B.Params(loss="logistic", rounds=8, depth=3, rows=0.8, columns=0.7, patience=3)
    inside = B.fit(df, ["user_id"], ["a", "b", "c"], p)
    monkeypatch.setattr(B, "BLOCK_ROWS", 90)
    monkeypatch.setattr(B, "_in_one_task", None)
    outside = B.fit(df, ["user_id"], ["a", "b", "c"], p)
    assert inside.to_dict() == outside.to_dict() and inside.getNumTrees > 2


def test_joint_classes_share_their_probabilities(spark):
    df = spark.createDataFrame(table(11, 600, 4), COLUMNS).withColumn("is_val", F.lit(False))
    model = B.fit(df, ["user_id"], ["a", "b", "c"], B.Params(loss="softmax", classes=4, rounds=12, depth=3, step=0.2))
    assert model.train_losses == sorted(model.train_losses, reverse=True) and len(model.train_losses) == 12
    assert model.train_losses[0] < math.log(4)
    out = model.transform(df, "p").select("p", "label").collect()
    assert all(abs(sum(r.p) - 1) < 1e-12 and len(r.p) == 4 for r in out)
    want = -sum(math.log(r.p[int(r.label)]) * w for r, w in zip(out, [r[5] for r in table(11, 600, 4)])) / sum(r[5] for r in table(11, 600, 4))
    assert abs(want - model.train_losses[-1]) < 1e-6


def test_patience_ends_the_fit_at_the_best_round(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 1), float(i % 3), rng.random(), rng.gauss(0, 1), 1.0, i % 3 == 0) for i in range(600)]  # noise
    df = spark.createDataFrame(rows, COLUMNS)
    model = B.fit(df, ["user_id"], ["a", "b", "c"], B.Params(rounds=60, depth=4, step=0.5, patience=5))
    assert len(model.losses) < 60 and len(model.losses) - model.best_round == 5
    assert model.losses[model.best_round - 1] == min(model.losses) and model.getNumTrees == model.best_round
    whole = B.fit(df, ["user_id"], ["a", "b", "c"], B.Params(rounds=len(model.losses), depth=4, step=0.5))
    assert whole.losses == model.losses and whole.table() == model.table()


def test_transform_round_trip_and_edges(spark):
    df = spark.createDataFrame(table(9, 150, 2), COLUMNS)
    p = B.Params(loss="logistic", rounds=5, depth=3)
    model = B.fit(df, ["user_id"], ["a", "b", "c"], p)
    again = B.Boosted.from_dict(json.loads(json.dumps(model.to_dict())))
    one, two = (m.transform(df).select("user_id", "prediction").orderBy("user_id").collect() for m in (model, again))
    assert one == two and all(0 < r.prediction < 1 for r in one)
    assert model.transform(df).columns == [*df.columns, "prediction"]
    assert abs(sum(model.importances().values()) - 1) < 1e-9
    empty = B.fit(df.limit(0), ["user_id"], ["a", "b", "c"], p)
    assert empty.trees == [] and empty.transform(df).select("prediction").distinct().collect()[0][0] == 0.5
    flat = B.fit(df.withColumns({"a": F.lit(1.0), "b": F.lit(None).cast("double"), "c": F.lit(0.0)}), ["user_id"], ["a", "b", "c"], p)
    assert all(r[3] is None for r in flat.table())
    with pytest.raises(ValueError):
        model.transform(df.withColumn("prediction", F.lit(1)))


def test_a_few_blocks_are_fitted_in_one_task(spark, monkeypatch):
    rows = table(8, 300)
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    p = B.Params(rounds=6, depth=3, rows=0.8, columns=0.7, patience=3)
    whole = B.fit(df, ["user_id"], ["a", "b", "c"], p)
    monkeypatch.setattr(B, "BLOCK_ROWS", 90)
    with monkeypatch.context() as m:
        m.setattr(B, "_added", None)
        assert B.fit(df, ["user_id"], ["a", "b", "c"], p).to_dict() == whole.to_dict()
    monkeypatch.setattr(B, "TASK_BLOCKS", 1)
    monkeypatch.setattr(B, "_in_one_task", None)
    monkeypatch.setattr(B, "GATHER", 2)  # the sums of the tasks meet on the executors
    assert B.fit(df, ["user_id"], ["a", "b", "c"], p).to_dict() == whole.to_dict()


def test_a_level_is_one_job_of_one_stage(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    df = spark.createDataFrame(table(4, 260), COLUMNS)
    sc, counts = spark.sparkContext, []
    for rounds in (2, 5):
        sc.setJobGroup(f"rounds-{rounds}", "levels")
        model = B.fit(df, ["user_id"], ["a", "b", "c"], B.Params(rounds=rounds, depth=3, min_gain=-1.0, min_hessian=0.0))
        assert model.getNumTrees == rounds
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")]
        counts.append((len(jobs), sum(len(j.stageIds) for j in jobs)))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert (counts[1][0] - counts[0][0], counts[1][1] - counts[0][1]) == (9, 9)  # three more rounds of three levels


def test_rows_beyond_the_range_of_feature_numbers():
    tree = B.Tree.empty(1)
    tree.feature[0], tree.cut[0] = 1, 3
    binned = np.zeros((2, 40_000), np.uint8)
    binned[1, ::2] = 9
    assert tree.leaf_of(binned, 64).tolist() == [2, 1] * 20_000
    assert tree.leaf_of(binned, 64, np.zeros(40_000, np.int64)).tolist() == [2, 1] * 20_000

"""Boosting against a plain recursion over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import boosting as B
from riskweave.operators import model as M

PLAIN = {"rows": 1.0, "columns": 1.0, "least_weight": 1.0, "gamma": 0.2}


def _rows(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.choice([0.0, 1.0, 2.0, None]), rng.choice([float("nan"), rng.gauss(0, 1)])
        y = int(rng.random() < (0.6 if a > 0.7 and b != 1.0 else 0.05))
        rows.append((f"t{i:05d}", i, a, b, c, y))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(_rows(), "transaction_id string, s long, a double, b double, c double, is_fraud int")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("s") * 3600)).repartition(4)


def test_first_split_and_leaves_by_hand(spark):
    # four negatives at 1, two positives at 2, one of each missing; equal class weights: w = 5/3 for positives
    rows = [(1.0, 0)] * 4 + [(2.0, 1)] * 2 + [(None, 0), (None, 1)]
    df = spark.createDataFrame([(f"t{i}", i, x, y) for i, (x, y) in enumerate(rows)], "transaction_id string, s long, x double, is_fraud int")
    df = df.withColumn("timestamp", F.timestamp_seconds("s"))
    s = dict(rounds=1, depth=1, rows=1.0, columns=1.0, least_weight=0.1, gamma=0.0, alpha=0.1, lam=1.0, rate=0.5)
    # nothing is held back but a row after the end
    late = spark.createDataFrame([("z", 9, 1.0, 0)], df.drop("timestamp").schema).withColumn("timestamp", F.timestamp_seconds("s"))
    tree, = B.fit_boosting(df.unionByName(late), ["x"], validation=0.1, **s).trees
    weight = 6 / 3      # negatives to positives, the row held back included
    g = {1.0: 4 * 0.5, 2.0: -2 * 0.5 * weight, None: 0.5 - 0.5 * weight}
    h = {1.0: 4 * 0.25, 2.0: 2 * 0.25 * weight, None: 0.25 + 0.25 * weight}
    soft = lambda v: math.copysign(max(abs(v) - 0.1, 0), v)
    score = lambda ks: soft(sum(g[k] for k in ks)) ** 2 / (sum(h[k] for k in ks) + 1)
    gains = {True: score([1.0, None]) + score([2.0]) - score(g), False: score([1.0]) + score([2.0, None]) - score(g)}
    side = max(gains, key=gains.get)
    assert tree.feature[0] == 0 and tree.cut[0] == 0 and tree.missing_left[0] is side and tree.gain[0] == pytest.approx(gains[side])
    left, right = ([1.0, None], [2.0]) if side else ([1.0], [2.0, None])
    for node, ks in ((tree.left[0], left), (tree.right[0], right)):
        assert tree.value[node] == pytest.approx(-0.5 * soft(sum(g[k] for k in ks)) / (sum(h[k] for k in ks) + 1))


def _plain(bins, y, w, late, settings, rounds):
    """Trees as nested tuples, and the average precision after each round."""
    s = B.replace(B.Settings(), **settings)
    margin = np.zeros(len(y))
    trees, precision = [], []

    def term(g, h):
        return max(abs(g) - s.alpha, 0) ** 2 / (h + s.lam)

    def leaf(g, h):
        return -math.copysign(max(abs(g) - s.alpha, 0), g) / (h + s.lam) * s.rate

    def grow(rows, depth, g, h):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-9, None)
        if depth < s.depth:
            for f in range(bins.shape[1]):
                b = bins[rows, f]
                found = (0.0, None)
                for side in (True, False):
                    for cut in range(B.MISSING - 1):
                        left = np.where(b == B.MISSING, side, b <= cut)
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        if hl >= s.least_weight and hs - hl >= s.least_weight:
                            gain = term(gl, hl) + term(gs - gl, hs - hl) - term(gs, hs)
                            if gain > found[0] + 1e-9:
                                found = (gain, (f, cut, side, rows[left], rows[~left]))
                if found[0] > best[0] + 1e-9:
                    best = found
        if best[1] is None:
            return ("leaf", rows, leaf(gs, hs))
        f, cut, side, left, right = best[1]
        parts = grow(left, depth + 1, g, h), grow(right, depth + 1, g, h)
        if parts[0][0] == parts[1][0] == "leaf" and best[0] < s.gamma:
            return ("leaf", rows, leaf(gs, hs))
        return ("node", (f, cut, side), *parts)

    def leaves(t):
        return [t] if t[0] == "leaf" else leaves(t[2]) + leaves(t[3])

    def apply(t, row):
        while t[0] == "node":
            f, cut, side = t[1]
            b = bins[row, f]
            t = t[2] if (side if b == B.MISSING else b <= cut) else t[3]
        return t[2]

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        t = grow(np.flatnonzero(~late), 0, w * (p - y), w * p * (1 - p))
        margin = margin + np.array([apply(t, i) for i in range(len(y))])
        trees.append(t)
        order = sorted({m for m in margin[late]}, reverse=True)
        tp = fp = 0
        area = 0.0
        for m in order:
            pos, neg = ((margin[late] == m) & (y[late] == 1)).sum(), ((margin[late] == m) & (y[late] == 0)).sum()
            tp, fp = tp + pos, fp + neg
            area += pos * tp / (tp + fp)
        precision.append(area / y[late].sum())
    return trees, precision


def _nested(tree, node=0):
    if tree.feature[node] < 0:
        return ("leaf", tree.value[node])
    return ("node", (tree.feature[node], tree.cut[node], tree.missing_left[node]), _nested(tree, tree.left[node]), _nested(tree, tree.right[node]))


def _same(a, b):
    if a[0] == "leaf":
        return b[0] == "leaf" and a[1] == pytest.approx(b[2], abs=1e-9)
    return b[0] == "node" and a[1] == b[1] and _same(a[2], b[2]) and _same(a[3], b[3])


def test_trees_and_stages_equal_plain_recursion(spark, table, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 3)
    settings = {**PLAIN, "depth": 3, "rate": 0.3}
    model = B.fit_boosting(table, ["a", "b", "c"], rounds=7, patience=50, **settings)
    rows = sorted(table.select("transaction_id", "a", "b", "c", "is_fraud").collect())
    columns = [np.array([np.nan if r[k] is None else r[k] for r in rows], float) for k in ("a", "b", "c")]
    bins, y = B.binned(columns, model.edges), np.array([r.is_fraud for r in rows])
    late = np.arange(len(rows)) >= len(rows) * 4 // 5
    w = np.where(y == 1, (y == 0).sum() / y.sum(), 1.0)
    trees, precision = _plain(bins, y, w, late, settings, 7)
    assert model.precision == pytest.approx(precision)
    assert len(model.trees) == int(np.argmax(np.round(precision, 12))) + 1
    assert all(_same(_nested(t), p) for t, p in zip(model.trees, trees))
    assert max(len(t.feature) for t in model.trees) > 3


def test_patience():
    assert B.stop_at([0.1, 0.3, 0.3, 0.2], 2) == (1, True)
    assert B.stop_at([0.1, 0.3, 0.2, 0.4], 3) == (3, False)
    assert B.stop_at([], 5) == (0, False) and B.stop_at([0.0] * 6, 5) == (0, True)


def test_stops_at_the_best_round_and_scores_after_reload(spark, table, tmp_path):
    model = B.fit_boosting(table, ["a", "b", "c"], rounds=30, patience=2, depth=2, rate=0.5, rows=0.8, columns=0.7)
    best = len(model.trees) - 1
    assert model.precision[best] == max(model.precision[:best + 3]) and len(model.precision) in (10, 20, 30)
    again = B.fit_boosting(table.repartition(4), ["a", "b", "c"], rounds=30, patience=2, depth=2, rate=0.5, rows=0.8, columns=0.7)
    assert [t.feature for t in again.trees] == [t.feature for t in model.trees]
    model.save(str(tmp_path))
    back = B.BoostedModel.load(spark, str(tmp_path))
    one = {r.transaction_id: r.score for r in model.score(table, ["transaction_id"]).collect()}
    two = {r.transaction_id: r.score for r in back.score(table.withColumn("more", F.lit(1)), ["transaction_id"]).collect()}
    assert one == two and len(one) == 400 and all(0 < v < 1 for v in one.values())
    missing = back.score(table.drop("b").limit(1), ["transaction_id"]).collect()
    assert len(missing) == 1
    gains = {r.feature: r.importance for r in B.gain_importance(back.node_table(spark), ["a", "b", "c", "none"]).collect()}
    assert gains["none"] == 0 and gains["a"] > 1
    lost = {r.feature: r.importance for r in M.permutation_importance(back, table).collect()}
    assert lost["a"] > 0


def test_mean_gain_over_a_tree_by_hand(spark):
    tree = B.Tree()
    left, right = tree.split(0, 0, 3, True, 8.0)
    tree.split(left, 1, 0, False, 2.0)
    tree.split(right, 0, 1, False, 4.0)
    model = B.BoostedModel(["x", "y"], [[1.0, 2.0, 3.0, 4.0], [5.0]], [tree])
    got = [(r.feature, r.importance) for r in B.gain_importance(model.node_table(spark), ["x", "y", "z"]).collect()]
    assert got == [("x", 6.0), ("y", 2.0), ("z", 0.0)]
    pruned = B.Tree()
    left, _ = pruned.split(0, 0, 0, True, 0.5)
    pruned.split(left, 0, 0, True, 0.9)
    pruned.prune(1.0)
    assert pruned.feature[0] == -1


def test_records_of_any_size_and_sums_that_meet_in_tasks_grow_the_same_trees(spark, table, monkeypatch):
    settings = dict(rounds=4, patience=50, depth=3, rate=0.3, rows=0.8, columns=0.7, least_weight=1.0)
    whole = B.fit_boosting(table, ["a", "b", "c"], **settings)
    monkeypatch.setattr(B, "SUMS", 0)
    monkeypatch.setattr(B, "CHUNK", 7)
    monkeypatch.setattr(B, "BLOCK", 2)
    parted = B.fit_boosting(table.repartition(3), ["a", "b", "c"], **settings)
    assert [t.feature for t in parted.trees] == [t.feature for t in whole.trees] and parted.precision == pytest.approx(whole.precision)
    assert [t.value for t in parted.trees] == [pytest.approx(t.value) for t in whole.trees]


def test_a_tree_reads_rows_once_brought_up_to_date(spark, table, monkeypatch):
    """Growing gets rows with the margins of all trees before; no level applies them again."""
    seen = []

    def level(rows, tree, active, *rest, level=B._level):
        seen.append(sum(float(np.abs(m).sum()) for *_, m in rows.collect()))
        return level(rows, tree, active, *rest)

    monkeypatch.setattr(B, "_level", level)
    model = B.fit_boosting(table, ["a", "b", "c"], rounds=3, patience=50, depth=1, rate=0.3, rows=1.0, columns=1.0, gamma=0.0)
    assert seen[0] == 0.0 and len(set(seen)) == 3 and len(model.precision) == 3

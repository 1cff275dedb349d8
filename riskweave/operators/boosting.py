"""Second-order boosting with regularised histogram trees, as Spark jobs.

Features are cut at quantiles once and rows are stored as one byte per feature,
``CHUNK`` rows to a record of column arrays, which executors keep. A level of a
tree is one job: tasks sum gradients and hessians per (node, feature, bin), the
sums meet per feature, and the best split of each node and feature comes to the
driver, as do sums of ``SUMS`` bytes at most, which are added there. Rows are
never collected. The first level of a tree brings the margins
up to the tree before it, so no tree is applied to a row twice. Margins are
stored every ``BLOCK`` rounds, and the average precision of all rounds of a
block is found in one job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import evaluate as E
from riskweave.operators.features import align_features, project_features, with_class_weight
from riskweave.operators.split import find_cut
from riskweave.session import scratch_path, settle

BINS = 256              # of a feature; the last one holds missing values
MISSING = BINS - 1
BLOCK = 10              # rounds between stored margins
CHUNK = 32_768          # rows of a record
SUMS = 64 << 20          # bytes of a level's sums that may meet on the driver, which saves a stage
HELD = StorageLevel.MEMORY_AND_DISK

NODE_SCHEMA = ("tree int, node int, feature string, position int, cut int, threshold double, missing_left boolean, "
               "left int, right int, value double, gain double, cover double")


@dataclass(frozen=True)
class Settings:
    # --- fixed values: boosting settings ---------------------------------------
    rounds: int = 1000
    patience: int = 50
    depth: int = 6
    rate: float = 0.05
    least_weight: float = 5.0       # hessian sum of a child
    gamma: float = 1.0              # least gain of a split that ends in leaves
    alpha: float = 0.1              # L1
    lam: float = 1.0                # L2
    rows: float = 0.8               # share of rows a tree sees
    columns: float = 0.8            # share of features a tree sees
    seed: int = 42
    # --- end of fixed values -----------------------------------------------------


@dataclass
class Tree:
    """Nodes as lists; a leaf has feature -1. Rows with bins up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> tuple[int, int]:
        pair = len(self.feature), len(self.feature) + 1
        for _ in pair:
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, -1),
                                  (self.right, -1), (self.value, 0.0), (self.gain, 0.0), (self.cover, 0.0)):
                column.append(empty)
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        self.left[node], self.right[node] = pair
        return pair

    def prune(self, gamma: float) -> None:
        """Takes back splits of too little gain whose children are leaves, from the bottom up."""
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0 and self.gain[node] < gamma and all(
                    self.feature[c] < 0 for c in (self.left[node], self.right[node])):
                self.feature[node], self.left[node], self.right[node], self.gain[node] = -1, -1, -1, 0.0

    def leaves(self, bins: np.ndarray, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows in ascending order) for all ``rows`` of ``bins``, column by column."""
        stack = [(0, np.arange(len(bins)) if rows is None else rows)]
        while stack:
            node, own = stack.pop()
            f = self.feature[node]
            if f < 0:
                yield node, own
            elif len(own):
                b = bins[:, f][own]
                goes = b <= self.cut[node]
                if self.missing_left[node]:
                    goes |= b == MISSING
                stack += [(self.left[node], own[goes]), (self.right[node], own[~goes])]

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins``."""
        at = np.zeros(len(bins), np.int64)
        for node, rows in self.leaves(bins):
            at[rows] = node
        return at


def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_score(g, h, s: Settings):
    return shrunk(g, s.alpha) ** 2 / (h + s.lam)


def leaf_value(g: float, h: float, s: Settings) -> float:
    return float(-shrunk(g, s.alpha) / (h + s.lam) * s.rate)


def best_splits(sums: np.ndarray, s: Settings) -> list[tuple]:
    """(gain, cut, missing_left, g_left, h_left, g, h) per node from sums[node, bin, (g, h)] of one feature.

    The gain is what the scores of the children exceed the node's by. Missing
    values go to the side that gains more, left on ties; the smallest of equal
    cuts is taken. No admissible split: gain 0.
    """
    out = []
    for node in sums:
        g, h = node.sum(0)
        lost = node[MISSING]
        below = np.cumsum(node[:MISSING - 1], axis=0)
        best = (0.0, 0, False, 0.0, 0.0, float(g), float(h))
        for side, extra in ((True, lost), (False, 0.0)):
            left = below + extra
            gl, hl = left[:, 0], left[:, 1]
            gain = leaf_score(gl, hl, s) + leaf_score(g - gl, h - hl, s) - leaf_score(g, h, s)
            gain = np.where((hl >= s.least_weight) & (h - hl >= s.least_weight), gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), k, side, float(gl[k]), float(hl[k]), float(g), float(h))
        out.append(best)
    return out


@dataclass
class BoostedModel:
    """Trees over binned features; scores batch and stream frames."""

    features: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    precision: list[float] = field(default_factory=list)    # average precision after each round, those cut off included

    def score(self, df: DataFrame, keep: Sequence[str] = (), column: str = "score") -> DataFrame:
        """``keep`` columns and the positive-class probability."""
        kept = df.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], *df.columns)
        aligned = align_features(kept, self.features, [f"_keep_{c}" for c in keep])
        edges, trees = self.edges, self.trees

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            bins = binned([c.to_numpy(float) for c in columns], edges)
            return pd.Series(1 / (1 + np.exp(-margins(bins, trees, np.zeros(len(bins))))))

        return aligned.select(*[F.col(f"_keep_{c}").alias(c) for c in keep],
                              probability(*[F.col(f).cast("double") for f in self.features]).alias(column))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node; leaves have no feature."""
        rows = []
        for t, tree in enumerate(self.trees):
            for n, f in enumerate(tree.feature):
                edge = float(self.edges[f][tree.cut[n]]) if f >= 0 and tree.cut[n] < len(self.edges[f]) else None
                rows.append((t, n, self.features[f] if f >= 0 else None, f, tree.cut[n], edge, tree.missing_left[n], tree.left[n],
                             tree.right[n], tree.value[n], tree.gain[n], tree.cover[n]))
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, folder: str) -> None:
        spark = SparkSession.getActiveSession()
        self.node_table(spark).write.mode("overwrite").parquet(f"{folder}/nodes")
        rows = [(i, f, [float(e) for e in es]) for i, (f, es) in enumerate(zip(self.features, self.edges))]
        spark.createDataFrame(rows, "position int, feature string, edges array<double>").write.mode("overwrite").parquet(f"{folder}/bins")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> BoostedModel:
        bins = spark.read.parquet(f"{folder}/bins").orderBy("position").collect()
        nodes = spark.read.parquet(f"{folder}/nodes").orderBy("tree", "node").collect()
        trees: list[Tree] = []
        for r in nodes:
            if r["node"] == 0:
                trees.append(Tree([], [], [], [], [], [], [], []))
            for column, value in zip(vars(trees[-1]).values(), (r["position"], r["cut"], r["missing_left"], r["left"], r["right"],
                                                                r["value"], r["gain"], r["cover"])):
                column.append(value)
        return cls([r["feature"] for r in bins], [list(r["edges"]) for r in bins], trees)


def gain_importance(nodes: DataFrame, features: Sequence[str], top_n: int = 35) -> DataFrame:
    """Mean gain per split of each feature, largest first; features without a split have 0."""
    spark = nodes.sparkSession
    used = nodes.filter("feature IS NOT NULL").groupBy("feature").agg(F.avg("gain").alias("gain"))
    names = spark.createDataFrame([(f,) for f in features], "feature string")
    return names.join(used, "feature", "left").select("feature", F.coalesce("gain", F.lit(0.0)).alias("importance")).orderBy(
        F.desc("importance"), "feature").limit(top_n)


# ---------------------------------------------------------------- bins

def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = MISSING - 1) -> list[list[float]]:
    """Ascending cuts per feature, ``bins`` at most, from a mergeable sketch; NaN and null count as missing."""
    clean = df.select(*[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f"f{i}") for i, f in enumerate(features)])
    found = clean.approxQuantile(clean.columns, [(k + 1) / (bins + 1) for k in range(bins)] + [1.0], 1 / (4 * bins))
    # the largest value needs no cut: nothing lies above it
    return [sorted(set(map(float, q)))[:-1][:bins] for q in found]


def binned(columns: Sequence[np.ndarray], edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Row by feature: how many edges lie below a value; missing values have the last bin."""
    out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.uint8, order="F")
    for i, (c, e) in enumerate(zip(columns, edges)):
        out[:, i] = np.where(np.isnan(c), MISSING, np.searchsorted(np.asarray(e, float), c, "left"))
    return out


def margins(bins: np.ndarray, trees: Sequence[Tree], start: np.ndarray) -> np.ndarray:
    out = start.copy()
    for t in trees:
        for node, rows in t.leaves(bins):
            out[rows] += t.value[node]
    return out


RECORD = "late boolean, bins binary, y binary, w binary, u binary, margin binary"


def _records(df: DataFrame, features: Sequence[str], edges: list[list[float]]) -> DataFrame:
    """``CHUNK`` rows to a record of arrays: bins by column, label, weight, a hash that draws the rows of a tree, margin."""
    source = df.select(F.col("_late").alias("late"), F.xxhash64("_row").alias("u"), F.col("_label").cast("double").alias("y"),
                       F.col("weight").cast("double").alias("w"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple]] = {False: [], True: []}

        def record(late: bool) -> pa.RecordBatch:
            bins, y, w, u = (np.concatenate(x) for x in zip(*held[late]))
            held[late] = []
            whole = (bins.tobytes("F"), y.tobytes(), w.tobytes(), u.tobytes(), bytes(8 * len(y)))
            return pa.RecordBatch.from_arrays([pa.array([late]), *(pa.array([x], pa.binary()) for x in whole)],
                                              ["late", "bins", "y", "w", "u", "margin"])

        for b in batches:
            late = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            u, y, w, *values = (c.to_numpy(zero_copy_only=False) for c in b.columns[1:])
            bins = binned([c.astype(float) for c in values], edges)
            for side in (False, True):
                own = np.flatnonzero(late == side)
                if len(own):
                    held[side].append((bins[own], y[own], w[own], u[own]))
                    if sum(len(x[1]) for x in held[side]) >= CHUNK:
                        yield record(side)
        for side in (False, True):
            if held[side]:
                yield record(side)

    return source.mapInArrow(work, RECORD)


def _bins(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(width, -1).T


def _drawn(u: np.ndarray, tree: int, s: Settings) -> np.ndarray:
    """Which rows a tree sees: a hash of row and tree, so a repeated task sees the same."""
    mixed = (u.view(np.uint64) ^ np.uint64(tree * 0x9E3779B97F4A7C15 + s.seed & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)).astype(float) / float(1 << 53) < s.rows


# ---------------------------------------------------------------- growing

def _level(rows: RDD, tree: Tree, active: list[int], columns: list[int], number: int, width: int, s: Settings) -> dict[int, tuple]:
    """The best split of each active node: (gain, feature, cut, missing_left, g_left, h_left, g, h)."""
    seat = {n: i for i, n in enumerate(active)}

    def count(part: int, chunks: Iterator[tuple]) -> Iterator[tuple]:
        sums = np.zeros((len(columns), len(active), BINS, 2))
        for bins, y, w, u, margin in chunks:
            for node, own in tree.leaves(bins, np.flatnonzero(_drawn(u, number, s))):
                if node not in seat or not len(own):
                    continue
                p, weight = 1 / (1 + np.exp(-margin[own])), w[own]
                g, h = weight * (p - y[own]), weight * p * (1 - p)
                for i, f in enumerate(columns):
                    b = bins[:, f][own].astype(np.intp)
                    for k, value in enumerate((g, h)):
                        sums[i, seat[node], :, k] += np.bincount(b, value, BINS)
        yield from ((f, (part, sums[i])) for i, f in enumerate(columns))

    def pick(group: tuple) -> list[tuple]:
        # in the order of the parts, so that a repeated run adds alike
        total = np.zeros((len(active), BINS, 2))
        for _, x in sorted(group[1], key=lambda x: x[0]):
            total += x
        return [(node, group[0], *found) for node, found in zip(active, best_splits(total, s))]

    sums = rows.mapPartitionsWithIndex(count)
    if rows.getNumPartitions() * len(columns) * len(active) * BINS * 16 > SUMS:
        found = sums.groupByKey(width).flatMap(pick).collect()
    else:
        groups: dict[int, list[tuple]] = {f: [] for f in columns}
        for f, x in sums.collect():
            groups[f].append(x)
        found = [r for group in groups.items() for r in pick(group)]
    best: dict[int, tuple] = {}
    for node, feature, gain, *rest in sorted(found, key=lambda r: (-r[2], r[1])):       # nodes x features rows
        best.setdefault(node, (gain, feature, *rest))
    return best


def grow(rows: RDD, number: int, width: int, s: Settings) -> Tree:
    """The next tree after the margins of ``rows``."""
    rng = np.random.default_rng([s.seed, number])
    columns = sorted(rng.choice(width, max(1, round(s.columns * width)), replace=False).tolist())
    tree, active = Tree(), [0]
    for level in range(s.depth):
        best = _level(rows, tree, active, columns, number, width, s)
        following = []
        for node in active:
            gain, feature, cut, side, gl, hl, g, h = best[node]
            tree.value[node], tree.cover[node] = leaf_value(g, h, s), h
            if gain <= 0:
                continue
            for child, (cg, ch) in zip(tree.split(node, feature, cut, side, gain), ((gl, hl), (g - gl, h - hl))):
                tree.value[child], tree.cover[child] = leaf_value(cg, ch, s), ch
                # no split of a lighter node leaves both children their weight
                if ch >= 2 * s.least_weight * (1 - 1e-9):
                    following.append(child)
        active = following
        if not active:
            break
    tree.prune(s.gamma)
    return tree


def _held(records: DataFrame, width: int) -> RDD:
    """The rows that grow trees as arrays, kept by the executors."""
    def arrays(r) -> tuple:
        return (_bins(r["bins"], width), np.frombuffer(r["y"]), np.frombuffer(r["w"]), np.frombuffer(r["u"], np.int64), np.frombuffer(r["margin"]))

    return records.filter("NOT late").rdd.map(arrays).persist(HELD)


def _moved(rows: RDD, tree: Tree) -> RDD:
    """``rows`` with the margins after ``tree``."""
    return rows.map(lambda r: (*r[:4], margins(r[0], [tree], r[4])))


def _stored(rows: RDD) -> RDD:
    """``rows`` written once and read back: a lost executor costs a re-read and the trees since."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "margins")
    rows.saveAsPickleFile(path, 1)
    return spark.sparkContext.pickleFile(path).persist(HELD)


def _late_moved(late: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """Records with the margins after ``trees``, written."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [margins(_bins(bins, width), trees, np.frombuffer(margin)).tobytes() for bins, margin in zip(*(c.to_pylist() for c in b.columns[1::4]))]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(new, pa.binary())], b.schema.names)

    return settle(late.mapInArrow(work, late.schema), "late-margins")


def staged_precision(late: DataFrame, trees: list[Tree], width: int) -> list[float]:
    """Average precision of the held-back rows after each of ``trees``; margins are prefix sums over the trees.

    Tasks count the labels of equal scores per record, Spark adds them up.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, y, margin in zip(*(c.to_pylist() for c in b.columns)):
                bins, positive, now = _bins(data, width), np.frombuffer(y) == 1, np.frombuffer(margin)
                for i, t in enumerate(trees):
                    now = margins(bins, [t], now)
                    scores, at = np.unique(now, return_inverse=True)
                    pos = np.bincount(at, positive, len(scores)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(scores), i, np.int32)), pa.array(scores), pa.array(pos), pa.array(np.bincount(at) - pos)],
                        ["stage", "score", "pos", "neg"])

    counted = late.select("bins", "y", "margin").mapInArrow(work, "stage int, score double, pos long, neg long")
    counts = settle(counted.groupBy("stage", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "score-counts")
    found = {r["stage"]: r["average_precision"] for r in E.counts_metrics(counts, ["stage"]).collect()}
    return [found.get(i) or 0.0 for i in range(len(trees))]


def stop_at(precision: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round, whether the patience has run out): the first of equal rounds is the best."""
    best = 0
    for i, p in enumerate(precision):
        if p > precision[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def fit_boosting(train: DataFrame, features: Sequence[str], label: str = "is_fraud", time: str = "timestamp", row_id: str = "transaction_id",
                 validation: float = 0.2, **settings) -> BoostedModel:
    """Trains until ``patience`` rounds bring no better average precision on the latest rows; keeps the best round's trees.

    Positives weigh as much as negatives in all; ``validation`` of the rows, the
    latest, are held back. Missing values have a side of their own at each
    split. Rows without a label are left out.
    """
    s = replace(Settings(), **settings)
    features = list(features)
    project_features(train, features)       # names the features that are missing
    # every pass below reads this once; the id may be a feature's name as well
    own = {"_label": F.col(label), "_time": F.col(time), "_row": F.col(row_id)}
    ready = settle(align_features(train.withColumns(own), features, list(own)), "training")
    cut = find_cut(ready, 1 - validation, "_time", "_row")
    narrow = with_class_weight(ready.withColumn("_late", cut.later("_time", "_row")), "_label").filter(F.col("_label").isin(0, 1))
    edges = quantile_edges(narrow.filter("NOT _late"), features)
    records = settle(_records(narrow, features, edges), "binned")
    model = BoostedModel(features, edges, [])
    width = len(features)
    rows, late = _held(records, width), records.filter("late")
    while len(model.trees) < s.rounds:
        block: list[Tree] = []
        for _ in range(min(BLOCK, s.rounds - len(model.trees))):
            moved = _moved(rows, block[-1]).persist(HELD) if block else rows
            block.append(grow(moved, len(model.trees) + len(block), width, s))
            if moved is not rows:
                rows.unpersist()
            rows = moved
        model.precision += staged_precision(late, block, width)
        model.trees += block
        best, over = stop_at(model.precision, s.patience)
        if over or len(model.trees) >= s.rounds:
            model.trees = model.trees[:best + 1]
            break
        late = _late_moved(late, block, width)
        before, rows = rows, _stored(_moved(rows, block[-1]))
        before.unpersist()
    rows.unpersist()
    return model

"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a sparse random index vector that follows from its hash. The
vector of a token's bucket is the sum of the index vectors of its neighbours
over the whole corpus, so tokens of like company have like vectors. A document
is the mean of its token vectors, over occurrences and over distinct tokens,
with its token counts; a two-layer network scores it and one temperature,
fitted on labelled rows kept aside, calibrates the probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import Interner, slices, word_hash
from riskweave.llm.tokens import forget_tokenizers
from riskweave.session import settle

BUCKETS = 8192          # token buckets: bounds the vector table to BUCKETS x WIDTH
WIDTH = 48
NONZERO = 2             # entries of an index vector
REACH = 2               # neighbours on either side
BLOCK = 256             # buckets per row of a partial sum
FAN_IN = 32             # partial sums added at once
MAX_FIT = 20_000        # labelled rows that the network is fitted on, about: those with the smallest hashes
HIDDEN = 32
STEPS = 1500
TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")


def _token_key(token: str) -> int:
    """The hash of a token; numbers count as one token, of symbol runs at most three characters."""
    if token[0].isdigit():
        token = "0"
    elif not token[0].isalpha():
        token = token[:3]
    return word_hash(token.encode("utf-8", "surrogatepass"))


def _tokens(text: str | None, cache: Interner) -> np.ndarray:
    found = TOKEN.findall(text) if text else []
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def _index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the index vectors: (n, NONZERO) each."""
    shifts = np.arange(NONZERO, dtype=np.uint64) * np.uint64(12)
    part = keys[:, None] >> shifts
    return ((part & np.uint64(2047)) % np.uint64(WIDTH)).astype(np.int64), ((part >> np.uint64(11)) & np.uint64(1)).astype(np.int8) * 2 - 1


def _buckets(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(48)) % np.uint64(BUCKETS)).astype(np.int64)


def context_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The summed index vectors of the neighbours of each bucket, over all documents, unit length.

    Tasks send sums by blocks of buckets; they are added ``FAN_IN`` at a time,
    so no group holds a sum of every task.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        cache = Interner(_token_key)
        total = np.zeros(BUCKETS * WIDTH)
        seen = False
        for batch in slices(batches):
            docs_keys = [_tokens(t, cache) for t in batch.column(0).to_pylist()]
            cache.trim()
            for part in _parts(docs_keys):
                keys = np.concatenate(part)
                doc = np.repeat(np.arange(len(part)), [len(k) for k in part])
                row = _buckets(keys) * WIDTH
                place, sign = _index(keys)
                for step in range(1, REACH + 1):
                    same = np.flatnonzero(doc[step:] == doc[:-step])     # no neighbours across documents
                    for own, other in ((same, same + step), (same + step, same)):
                        at = row[own, None] + place[other]
                        total += np.bincount(at.ravel(), sign[other].ravel(), BUCKETS * WIDTH)
                        seen = True
        if seen:
            rows = total.astype(np.float32).reshape(-1, BLOCK * WIDTH)
            held = np.flatnonzero(np.abs(rows).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.astype(np.int32)), pa.array([rows[i].tobytes() for i in held], pa.binary())], ["block", "sums"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        whole = sum(np.frombuffer(b, np.float32) for b in rows["sums"])
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "sums": [whole.tobytes()]})

    sums = settle(docs.select(text).mapInArrow(count, "block int, sums binary"), "context-sums")
    most = sums.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        dealt = sums.withColumn("part", F.pmod(F.xxhash64("sums"), F.lit(-(-most // FAN_IN))))
        sums = settle(dealt.groupBy("block", "part").applyInPandas(add, "block int, sums binary"), "context-sums")
        most = sums.groupBy("block").count().agg(F.max("count")).first()[0]
    table = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH), np.float32)
    for r in sums.collect():   # BUCKETS / BLOCK rows
        table[r["block"]] = np.frombuffer(bytes(r["sums"]), np.float32)
    table = table.reshape(BUCKETS, WIDTH)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def _parts(keys: list[np.ndarray], most: int = 400_000) -> Iterator[list[np.ndarray]]:
    """Runs of documents with about ``most`` tokens together; a longer document is one of its own."""
    held, size = [], 0
    for k in keys:
        held.append(k)
        size += len(k)
        if size >= most:
            yield held
            held, size = [], 0
    if size:
        yield held


FEATURES = 2 * WIDTH + 6


def pool(text: str | None, table: np.ndarray, cache: Interner) -> np.ndarray:
    """Features of one text; a text without tokens has zeros."""
    out = np.zeros(FEATURES, np.float32)
    keys = _tokens(text, cache)
    if not len(keys):
        return out
    distinct, times = np.unique(keys, return_counts=True)
    vectors = table[_buckets(distinct)]
    share = (times / len(keys)).astype(np.float32)
    often, once = share @ vectors, vectors.mean(0)
    out[:WIDTH], out[WIDTH:2 * WIDTH] = often, once
    out[2 * WIDTH:] = (np.log1p(len(keys)) / 8, np.log1p(len(distinct)) / 8, len(distinct) / len(keys),
                       np.linalg.norm(often), np.linalg.norm(once), float((keys[1:] == keys[:-1]).mean()) if len(keys) > 1 else 0)
    return out


def pooled(docs: DataFrame, table: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features array<float>) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, vectors = Interner(_token_key), shared.value
        for batch in slices(batches):
            made = np.concatenate([pool(t, vectors, cache) for t in batch.column(1).to_pylist()])
            cache.trim()
            offsets = np.arange(0, len(made) + 1, FEATURES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, made)], [key, "features"])

    return docs.select(key, text).mapInArrow(work, f"`{key}` {docs.schema[key].dataType.simpleString()}, features array<float>")


@dataclass(frozen=True)
class Network:
    """Two layers on standardised features, and the temperature of the output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = STEPS) -> Network:
    """Fits on four fifths of the rows, the temperature on the rest.

    With one class, or no row at all, every score is the smoothed share of ones.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 10 or y.min() == y.max():
        n = x.shape[1]
        return Network(np.zeros(n), np.ones(n), np.zeros((n, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = max(1, len(y) // 5)
    aside, used = order[:cut], order[cut:]
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-4
    z, t = (x[used] - mean) / scale, y[used]
    weights = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(t), min(256, len(t)))
        a, b = z[pick], t[pick]
        h = np.tanh(a @ weights[0] + weights[1])
        p = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3][0], -30, 30)))
        e = (p - b) / len(b)
        back = np.outer(e, weights[2]) * (1 - h * h)
        grads = [a.T @ back + 1e-4 * weights[0], back.sum(0), h.T @ e + 1e-4 * weights[2], np.array([e.sum()])]
        rate = 0.01 * (1 - step / (steps + 1))
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    z, t = net.logits(x[aside]), y[aside]
    heat = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(t > 0.5, -z, z) / k).mean() for k in heat]
    return Network(net.mean, net.scale, net.w1, net.b1, net.w2, net.b2, float(heat[int(np.argmin(loss))]))


def held_out(key: str, folds: int, fold: int):
    """Whether crc32 of the key as text leaves ``fold``; null keys are held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(True))


def _labelled(labels: DataFrame, key: str, label: str, folds: int, fold: int | None) -> DataFrame:
    """(key, y, h): one decided label per key outside the held-out fold, and the hash that orders the sample."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    if fold is not None:
        known = known.filter(~held_out(key, folds, fold))
    decided = known.groupBy(F.col(key).alias(key)).agg(F.avg(label).alias("__y")).filter("__y <> 0.5")
    return decided.select(key, F.round("__y").alias("y"), F.xxhash64(F.col(key), F.lit("fit")).alias("h"))


def _sampled(marked: DataFrame, most: int) -> DataFrame:
    """The labels whose hash lies in the first share that holds about ``most`` of them."""
    held = settle(marked, "labels")
    total = held.count()
    if total <= most:
        return held
    return held.filter(F.shiftrightunsigned("h", 1) < F.lit(int(most / total * 2**63)))


def _fit(rows: DataFrame, key: str) -> Network:
    """Fits on a bounded table of features and labels; a key counts once."""
    fit = rows.dropDuplicates([key]).select("features", "y", "h").toPandas().sort_values("h", kind="stable")
    x = np.stack(fit["features"].to_numpy()).astype(float) if len(fit) else np.zeros((0, FEATURES))
    return fit_network(x, fit["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                   folds: int = 5, fold: int = 0, max_fit: int = MAX_FIT) -> DataFrame:
    """(key, held_out, score) for every row of ``docs``.

    The word vectors come from all texts, the network from about ``max_fit``
    labelled rows at most, outside the held-out fold. Null labels are skipped, of
    repeated labels of a key the mean decides (a tie is skipped); null and empty
    texts are scored from zero features; repeated rows are scored alike. Only
    the named columns are read.
    """
    features = settle(pooled(docs, context_table(docs, text), key, text).withColumn("held_out", held_out(key, folds, fold)), "features")
    sample = _sampled(_labelled(labels, key, label, folds, fold), max_fit)
    net = _fit(features.join(sample, key), key)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, FEATURES).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.score(x))],
                                                 [key, "held_out", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return features.select(key, "held_out", "features").mapInArrow(score, f"`{key}` {kind}, held_out boolean, score double")


def quality_filter(docs: DataFrame, labels: DataFrame, least: float = 0.3, key: str = "doc_id", text: str = "text",
                   label: str = "quality", max_fit: int = MAX_FIT) -> DataFrame:
    """``docs`` without the rows that score below ``least``; all columns as they came.

    All labels may teach, about ``max_fit`` of them at most, those with the
    smallest hashes. A text without tokens is rejected. Rows stay where they are: texts are
    read and judged, not shuffled.
    """
    table = context_table(docs, text)
    sample = _sampled(_labelled(labels, key, label, 1, None), max_fit)
    # about max_fit rows: small enough for every executor
    taught = docs.select(key, text).join(F.broadcast(sample.select(key)), key, "left_semi")
    net = _fit(settle(pooled(taught, table, key, text), "fit").join(sample, key), key)
    shared = docs.sparkSession.sparkContext.broadcast((table, net))
    at = docs.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, model = shared.value
        cache = Interner(_token_key)
        for batch in slices(batches):
            x = np.stack([pool(t, vectors, cache) for t in batch.column(at).to_pylist()]).astype(float)
            cache.trim()
            yield batch.filter(pa.array((model.score(x) >= least) & (x[:, 2 * WIDTH] > 0)))

    return docs.mapInArrow(judge, docs.schema)

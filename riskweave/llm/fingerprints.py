"""Document fingerprints: SimHash over weighted terms, found again through permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import U64, Interner, pack_bits, raw_texts, signed_votes, slices, word_hash
from riskweave.session import settle

LANES = 2           # 64-bit words of a fingerprint
BITS = 64 * LANES
RADIUS = 3          # differing bits that count as near
BLOCKS = 6          # blocks of a fingerprint; tables keep BLOCKS - RADIUS of them in front
TILE = 8192         # fingerprints of one table key that meet in one task, twice


def fingerprint(text: bytes | None, cache: Interner) -> np.ndarray:
    """LANES words of a text; no term: zero.

    A term is a lower-cased (A-Z) run without ASCII white space. It votes with
    the signs of its hash bits, weighted by one plus the logarithm of how often
    it occurs and by its length, which stands for its rarity.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(LANES, U64)
    hashes = np.fromiter(map(cache.__getitem__, words), U64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    terms, first, times = np.unique(hashes, return_index=True, return_counts=True)
    weights = ((1 + np.log(times)) * np.clip(sizes[first] - 1, 1, 10)).astype(np.float32)
    return pack_bits(signed_votes(terms, LANES, weights))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bits."""
    return 1.0 - int(np.bitwise_count(a ^ b).sum()) / BITS


def as_hex(words: np.ndarray) -> str:
    return words.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lanes array<long>) for every row; null texts count as empty."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Interner(word_hash)
        for batch in slices(batches):
            made = np.concatenate([fingerprint(t, cache) for t in raw_texts(batch.column(1))])
            cache.trim()
            offsets = np.arange(0, len(made) + 1, LANES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, made.view(np.int64))], [key, "lanes"])

    return docs.select(key, text).mapInArrow(work, f"`{key}` {docs.schema[key].dataType.simpleString()}, lanes array<long>")


def _tables() -> list[tuple[int, ...]]:
    """Which blocks each permuted table puts in front; RADIUS differences leave one choice untouched."""
    return list(combinations(range(BLOCKS), BLOCKS - RADIUS))


def _masks() -> np.ndarray:
    """(table, lane) words that select the blocks of each table."""
    edges = [BITS * b // BLOCKS for b in range(BLOCKS + 1)]
    block = np.searchsorted(edges, np.arange(BITS), "right") - 1
    chosen = np.array([np.isin(block, t) for t in _tables()])
    return np.packbits(chosen, axis=1).view(">u8").astype(U64)


def near_counts(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(lanes, near): how many other distinct fingerprints differ in 1 to ``radius`` bits.

    ``prints`` has distinct ``lanes``. Each table sorts by the bits of its
    blocks; fingerprints with equal blocks are compared whole. A pair counts in
    the first table that holds it. Keys with more than ``tile`` fingerprints
    are dealt over tiles, and every two tiles meet in a task of their own.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the tables find at most {RADIUS} differing bits")
    masks = _masks()
    keyed = []
    for t, row in enumerate(masks.view(np.int64).tolist()):
        parts = [F.col("lanes")[lane].bitwiseAND(F.lit(m)) for lane, m in enumerate(row)]
        keyed.append(F.xxhash64(F.lit(t), *parts))
    rows = prints.select("lanes", F.posexplode(F.array(*keyed)).alias("table", "front"))
    sizes = rows.groupBy("table", "front").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = settle(sizes, "table-fronts")   # fingerprints alone in all tables go no further
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = (rows.join(sizes, ["table", "front"]).withColumn("own", F.pmod(F.xxhash64("lanes"), tiles))
            .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= 100_000:
                done, rest = _cut(pa.Table.from_batches(held))
                if done is not None:
                    yield from _compare(done, masks, radius)
                    held, count = rest.to_batches(), rest.num_rows
        if count:
            yield from _compare(pa.Table.from_batches(held), masks, radius)

    found = (rows.select("table", "front", "low", "high", "own", "lanes").repartition("table", "front", "low", "high")
             .sortWithinPartitions("table", "front", "low", "high").mapInArrow(work, "lanes array<long>, near long"))
    return found.groupBy("lanes").agg(F.sum("near").alias("near"))


KEYS = ["table", "front", "low", "high"]


def _starts(rows: pa.Table) -> np.ndarray:
    columns = [rows[c].to_numpy() for c in KEYS]
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def _cut(rows: pa.Table) -> tuple[pa.Table | None, pa.Table]:
    """Cuts off the last key, which may go on in the next batch."""
    last = int(_starts(rows)[-1])
    return (rows.slice(0, last), rows.slice(last)) if last else (None, rows)


def _compare(rows: pa.Table, masks: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    words = rows["lanes"].combine_chunks().flatten().to_numpy().view(U64).reshape(-1, LANES)
    table, own = rows["table"].to_numpy(), rows["own"].to_numpy()
    low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
    start = _starts(rows)
    end = np.r_[start[1:], len(words)]
    near = np.zeros(len(words), np.int64)
    size = (end - start)
    # row i meets the rows that follow it under the same key, step by step
    for step in range(1, int(size.max())):
        if step > 256:
            break
        left = end - step
        groups = np.flatnonzero(left > start)
        i = _ranges(start[groups], left[groups])
        _count(i, i + step, words, table, own, low, high, masks, radius, near)
    for g in np.flatnonzero(size > 257):     # the far rows of large keys, a row against many
        for i in range(start[g], end[g] - 257):
            j = np.arange(i + 257, end[g])
            _count(np.full(len(j), i), j, words, table, own, low, high, masks, radius, near)
    held = np.flatnonzero(near)
    if len(held):
        offsets = np.arange(0, len(held) * LANES + 1, LANES, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(offsets, words[held].ravel().view(np.int64)), pa.array(near[held])], ["lanes", "near"])


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _count(i, j, words, table, own, low, high, masks, radius, near) -> None:
    apart = np.bitwise_count(words[i] ^ words[j]).sum(1)
    keep = (apart <= radius) & (apart > 0)
    i, j = i[keep], j[keep]
    # two tiles: only rows of different tiles meet here
    keep = (low[i] == high[i]) | (own[i] != own[j])
    i, j = i[keep], j[keep]
    if not len(i):
        return
    # the first table whose blocks agree counts the pair
    agree = ((words[i] ^ words[j])[:, None, :] & masks[None]).max(2) == 0
    keep = agree.argmax(1) == table[i]
    np.add.at(near, i[keep], 1)
    np.add.at(near, j[keep], 1)


# ---------------------------------------------------------------- edited texts

def in_ranges(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``text`` in key ranges (``__range``), largest key first; ``__ghost`` marks a range's extra last row.

    Every range also gets the first row of the next one, so each row's
    successor is in its own range and no range needs another.
    """
    spark = docs.sparkSession
    parts = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = docs.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    cuts = sorted(set(keys.approxQuantile("k", [i / parts for i in range(1, parts)], 0.2 / parts))) if not keys.isEmpty() else []
    texts = ",".join(f"{int(c)}L" for c in cuts)
    at = F.expr(f"size(filter(array({texts}), c -> c >= `{key}`))") if cuts else F.lit(0)
    # nulls come last
    placed = docs.select(key, text).withColumn("__range", F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(at))
    heads = {r["__range"]: r["head"] for r in placed.groupBy("__range").agg(F.max(key).alias("head")).collect()}
    order = sorted(heads)
    if not order:
        return placed.withColumn("__ghost", F.lit(False))
    # the first row of a range also goes to the range before it; the very first to the last
    before = {r: order[i - 1] for i, r in enumerate(order)}
    pairs = ",".join(f"{r},{b}" for r, b in before.items())
    head = ",".join(f"{r},{'cast(null as long)' if heads[r] is None else str(int(heads[r])) + 'L'}" for r in order)
    is_head = F.col(key).eqNullSafe(F.expr(f"map({head})[__range]"))
    copies = F.when(is_head, F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("g")),
                                     F.struct(F.expr(f"map({pairs})[__range]").alias("r"), F.lit(True).alias("g")))
                    ).otherwise(F.array(F.struct(F.col("__range").alias("r"), F.lit(False).alias("g"))))
    return placed.withColumn("c", F.explode(copies)).select(
        key, text, F.col("c.r").alias("__range"), F.col("c.g").alias("__ghost"))


def edit(own: str, following: str) -> str:
    """The text with its last third replaced by the start of the following one."""
    k = len(own) // 3
    return own[:len(own) - k] + following[:k]


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, lanes, edited_lanes, near_edited, near_next) per row.

    The next document is the one that follows in descending order of the key,
    after the last the first; null keys come last, equal keys by text hash.
    Null texts are empty; a lone document is its own next one.
    """
    kind = docs.schema[key].dataType.simpleString()
    ranged = in_ranges(docs, key, text).withColumn("__hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    ordered = (ranged.repartition("__range").sortWithinPartitions("__range", "__ghost", F.desc_nulls_last(key), "__hash")
               .select(key, text, "__range", "__ghost"))
    schema = (f"`{key}` {kind}, n_chars long, edited_sha256 string, lanes array<long>, edited_lanes array<long>, "
              "near_edited double, near_next double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Interner(word_hash)
        last = None          # the row before, which waits for its successor

        def row(own, following):
            changed = edit(own[1], following[1]).encode()
            prints = fingerprint(changed, cache)
            return (own[0], len(own[1]), hashlib.sha256(changed).hexdigest(), own[4].view(np.int64).tolist(), prints.view(np.int64).tolist(),
                    likeness(own[4], prints), likeness(own[4], following[4]))

        for batch in slices(batches):
            columns = [c.to_pylist() for c in batch.columns]
            out = []
            for k, t, r, ghost in zip(*columns):
                t = t or ""
                now = (k, t, r, ghost, fingerprint(t.encode(), cache))
                # one ghost is the successor; equal head keys may add more, which follow it
                if last is not None and last[2] == r and not last[3]:
                    out.append(row(last, now))
                last = now
            cache.trim()
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (batch.schema.field(0).type, pa.int64(), pa.string(), pa.list_(pa.int64()),
                                                               pa.list_(pa.int64()), pa.float64(), pa.float64()))],
                    [key, "n_chars", "edited_sha256", "lanes", "edited_lanes", "near_edited", "near_next"])

    return ordered.mapInArrow(work, schema)

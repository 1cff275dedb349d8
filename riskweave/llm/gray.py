"""Near duplicates by SimHash and a Gray-order hierarchical index.

Fingerprints that agree on a block of bits meet in one bucket (with r differing
bits at most, one of r + 1 blocks is equal). Inside a bucket they are sorted by
Gray rank, which keeps likely neighbours together; consecutive fingerprints are
grouped, and the bits a group shares, its masked pattern, move into an upper
node, level by level. A search walks down from the root and adds the
differences to the bits that each node brings; a node whose sum exceeds the
radius is left with everything below it. Buckets give a forest of links, never
all pairs, and buckets above ``TILE`` rows are compared tile by tile.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.components import components
from riskweave.llm.text import U64, Interner, mix, pack_bits, raw_texts, shingle_hashes, signed_votes, slices, word_hash
from riskweave.session import settle

FAN = 16           # children of an index node
TILE = 8192        # rows of one bucket that one task holds, twice
CHUNK = 200_000    # rows indexed at once
QUERIES = 8192     # queries walked down at once
PAIRS = 1 << 22    # pairs that the queries walked down at once can make
FULL = U64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- the index

def gray_rank(fingerprints: np.ndarray) -> np.ndarray:
    """Position of each word in the Gray order."""
    rank = fingerprints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> U64(shift)
    return rank


class GrayIndex:
    """Index over fingerprints sorted by (bucket, Gray rank); ``bucket`` counts from 0 without gaps."""

    def __init__(self, bucket: np.ndarray, fingerprints: np.ndarray):
        self.levels = [(fingerprints, np.full(len(fingerprints), FULL), None, None)]
        while True:
            pattern, mask, _, _ = self.levels[-1]
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            if len(first) == len(bucket):
                break
            place = np.arange(len(bucket)) - np.repeat(first, np.diff(np.r_[first, len(bucket)]))
            start = np.flatnonzero(place % FAN == 0)
            end = np.r_[start[1:], len(bucket)]
            lead = np.repeat(pattern[start], end - start)
            shared = np.bitwise_and.reduceat(mask, start) & ~np.bitwise_or.reduceat(pattern ^ lead, start)
            self.levels.append((pattern[start] & shared, shared, start, end))
            bucket = bucket[start]

    def search(self, bucket: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) pairs of one bucket that differ in at most ``radius`` bits."""
        pattern, mask, start, end = self.levels[-1]
        who, node = np.arange(len(queries)), bucket
        apart = np.bitwise_count((queries ^ pattern[node]) & mask[node]).astype(np.int16)
        for below, _, _ in [(lv, None, None) for lv in self.levels[-2::-1]]:
            near = apart <= radius
            who, node, apart = who[near], node[near], apart[near]
            size = end[node] - start[node]
            total = int(size.sum())
            child = np.repeat(start[node] - (np.cumsum(size) - size), size) + np.arange(total)
            above = np.repeat(mask[node], size)
            who, apart = np.repeat(who, size), np.repeat(apart, size)
            pattern, mask, start, end = below
            fresh = mask[child] & ~above
            apart = apart + np.bitwise_count((queries[who] ^ pattern[child]) & fresh)
            node = child
        near = apart <= radius
        return who[near], node[near]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of ``a`` and ``b``; a label is the smallest position of its set."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, low, high = a[apart], b[apart], np.minimum(la, lb)[apart], np.maximum(la, lb)[apart]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def bucket_labels(bucket: np.ndarray, fingerprints: np.ndarray, radius: int,
                  agree: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Per row the smallest position it is linked to inside its bucket; rows sorted by (bucket, Gray rank).

    Large buckets first lose what their middle rows reach, so that a dense group
    costs a few sweeps instead of all its pairs; the rest is searched whole.
    What different middle rows reached is searched against each other as long as
    their labels differ, so no link is lost.
    """
    n = len(bucket)
    label, open_ = np.arange(n), np.ones(n, bool)
    swept = np.full(n, -1)      # the sweep that took the row out

    def hits(who: np.ndarray, among: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, dense, size = np.unique(bucket[among], return_inverse=True, return_counts=True)
        who = who[np.isin(bucket[who], held)]
        if not len(who):
            return
        index = GrayIndex(dense, fingerprints[among])
        before = np.cumsum(size[np.searchsorted(held, bucket[who])]) // PAIRS
        cuts = np.unique(np.r_[np.arange(0, len(who), QUERIES), np.flatnonzero(np.r_[True, before[1:] != before[:-1]]), len(who)])
        for at, end in zip(cuts[:-1], cuts[1:]):
            q = who[at:end]
            i, j = index.search(np.searchsorted(held, bucket[q]), fingerprints[q], radius)
            i, j = q[i], among[j]
            keep = i != j
            i, j = i[keep], j[keep]
            if agree is not None and len(i):
                keep = agree(i, j)
                i, j = i[keep], j[keep]
            yield i, j

    active = np.flatnonzero(np.bincount(bucket) > 64)
    led: list[np.ndarray] = []  # per sweep the middle row of each bucket, or -1
    for sweep in range(24):
        rest = np.flatnonzero(open_ & np.isin(bucket, active))
        if not len(rest):
            break
        held, first, count = np.unique(bucket[rest], return_index=True, return_counts=True)
        leaders = rest[first + count // 2]
        open_[leaders], swept[leaders] = False, sweep
        led.append(np.full(bucket[-1] + 1, -1))
        led[-1][held] = leaders
        rest = rest[open_[rest]]
        won = np.zeros(len(held), np.int64)
        for i, j in hits(leaders, rest):
            label = _merge(label, i, j)
            open_[j], swept[j] = False, sweep
            won += np.bincount(np.searchsorted(held, bucket[j]), minlength=len(held))
        active = held[(won > 0.05 * count) & (count - won > 64)]
    rest = np.flatnonzero(open_)
    if len(rest):
        for i, j in hits(np.arange(n), rest):
            label = _merge(label, i, j)
    for sweep, lead in enumerate(led[:-1]):
        # later sweeps' rows against what this one took: each is within the radius of its leader
        among, who = np.flatnonzero(swept == sweep), np.flatnonzero(swept > sweep)
        apart = np.bitwise_count(fingerprints[who] ^ fingerprints[lead[bucket[who]]])
        near = apart <= 2 * radius
        who, apart = who[near], apart[near]
        who = who[np.lexsort((apart, bucket[who]))]
        place = np.arange(len(who)) - np.searchsorted(bucket[who], bucket[who])
        at, end = 0, 1
        while at < len(who):        # the nearest rows of each bucket first; most buckets are of one label after them
            own = who[(place >= at) & (place < end)]
            own = own[label[own] != label[lead[bucket[own]]]]
            for i, j in hits(own, among):
                label = _merge(label, i, j)
            at, end = end, 4 * end
    return label


# ---------------------------------------------------------------- links on Spark

def links(prints: DataFrame, lanes: int, radius: int, blocks: int = 3,
          agree: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, tile: int = TILE, buckets: str | None = None) -> DataFrame:
    """(src, dst) of a forest that connects what is linked inside every bucket.

    ``prints`` has a unique ``id`` (long) and ``lanes``, an array of longs whose
    first ``lanes`` words are indexed; ``agree(a, b)`` gets the rows' words, two
    matrices, and confirms pairs. With one lane and radius < ``blocks`` no link
    is missed. ``buckets`` names an array of longs to meet on instead of the
    blocks; its places take the lanes in turn.
    """
    edges = [64 * b // blocks for b in range(blocks + 1)]
    if buckets is not None:
        rows = prints.select("id", "lanes", F.posexplode(buckets).alias("lane", "bucket")).withColumn("lane", F.col("lane") % lanes)
    else:
        keys = []
        for lane in range(lanes):
            for b in range(blocks):
                width = edges[b + 1] - edges[b]
                value = F.shiftrightunsigned(F.col("lanes")[lane], edges[b]).bitwiseAND(F.lit((1 << width) - 1))
                keys.append(value + F.lit((lane * blocks + b) << 34))
        rows = prints.select("id", "lanes", F.explode(F.array(*keys)).alias("bucket"))
        rows = rows.withColumn("lane", F.shiftright("bucket", 34).cast("int") / blocks)
    hot = settle(rows.groupBy("bucket").count().filter(F.col("count") > tile)
                 .select("bucket", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "hot-buckets")
    if hot.isEmpty():
        rows = rows.withColumn("pair", F.lit(0).cast("long"))
    else:
        # every two tiles of a hot bucket meet in one task; others have one tile
        tiles = F.coalesce("tiles", F.lit(1))
        own = F.pmod(F.xxhash64("id"), tiles)
        rows = (rows.join(hot, "bucket", "left").withColumn("own", own)
                .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
                .withColumn("pair", F.least("own", "other") * (1 << 31) + F.greatest("own", "other")))
    words = len(prints.first()["lanes"]) if not prints.isEmpty() else lanes

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= CHUNK:
                done, rest = _whole_buckets(pa.Table.from_batches(held))
                if done is not None:
                    yield from _forest(done, lanes, words, radius, agree)
                    held, count = rest.to_batches(), rest.num_rows
        if count:
            yield from _forest(pa.Table.from_batches(held), lanes, words, radius, agree)

    return (rows.select("bucket", "pair", "lane", "id", "lanes").withColumn("lane", F.col("lane").cast("int"))
            .repartition("bucket", "pair").sortWithinPartitions("bucket", "pair").mapInArrow(work, "src long, dst long"))


def _whole_buckets(rows: pa.Table) -> tuple[pa.Table | None, pa.Table]:
    """Cuts off the last bucket, which may go on in the next batch."""
    bucket, pair = rows["bucket"].to_numpy(), rows["pair"].to_numpy()
    first = int(np.argmax((bucket == bucket[-1]) & (pair == pair[-1])))
    return (rows.slice(0, first), rows.slice(first)) if first else (None, rows)


def _forest(rows: pa.Table, lanes: int, words: int, radius: int, agree) -> Iterator[pa.RecordBatch]:
    bucket, pair, lane = (rows[c].to_numpy() for c in ("bucket", "pair", "lane"))
    new = np.r_[True, (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])]
    seg = np.cumsum(new) - 1
    keep = np.flatnonzero(np.bincount(seg)[seg] > 1)      # a bucket of one has no link
    if not len(keep):
        return
    flat = rows["lanes"].combine_chunks().flatten().to_numpy().view(U64).reshape(-1, words)[keep]
    ids = rows["id"].to_numpy()[keep]
    fingerprints = flat[np.arange(len(keep)), lane[keep]]
    order = np.lexsort((gray_rank(fingerprints), seg[keep]))
    flat, ids = flat[order], ids[order]
    check = None if agree is None else lambda i, j: agree(flat[i], flat[j])
    label = bucket_labels(np.unique(seg[keep], return_inverse=True)[1][order], fingerprints[order], radius, check)
    linked = np.flatnonzero(label != np.arange(len(label)))
    if len(linked):
        yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], ["src", "dst"])


# ---------------------------------------------------------------- fingerprints of shingles

def shingle_fingerprint(text: bytes | None, words: int = 3) -> int:
    """Majority of the XXH64 (seed 42) bits of all word shingles, repeats included; no word: zero."""
    w = text.lower().split() if text else []
    if not w:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    hashes = np.array([digest(join(r), 42) for r in runs], U64)
    return int(pack_bits(signed_votes(hashes, 1))[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fingerprint long) per row; null and empty texts have zero."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = np.array([shingle_fingerprint(t, words) for t in raw_texts(batch.column(1))], U64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], [key, "fingerprint"])

    return docs.select(key, text).mapInArrow(work, f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint long")


def fingerprint_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(key, fingerprint, component_id): the smallest key reachable over links of at most ``radius`` bits.

    Equal texts share a fingerprint and so a component; texts without words are
    linked like others; null keys get a component but never name one; repeated
    rows stay; an empty table gives an empty result.
    """
    made = settle(fingerprints(docs, key, text, words), "fingerprints")
    # one row per fingerprint: copies meet map-side and never in the index
    distinct = settle(made.groupBy("fingerprint").agg(F.min(key).alias("low")), "distinct-fingerprints")
    found = links(distinct.select(F.col("fingerprint").alias("id"), F.array("fingerprint").alias("lanes")), 1, radius, radius + 1)
    roots = components(found)
    classed = (distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
               .withColumn("class", F.coalesce("root", "fingerprint")))
    lowest = classed.groupBy("class").agg(F.min("low").alias("component_id"))
    names = settle(classed.join(lowest, "class").select("fingerprint", "component_id"), "classes")
    return made.join(names, "fingerprint").select(key, "fingerprint", "component_id")


# ---------------------------------------------------------------- near duplicates of whole documents

LANES = 4          # 64-bit words of each fingerprint
NEAR = 24          # differing bits of a word that a search admits; 9.7 are expected at similarity 0.8, 2.9 their deviation
BANDS = 16         # of MinHash values of the shingles: two documents meet in one with 1 - (1 - s ** DEEP) ** BANDS,
DEEP = 4           # which is 0.9998 at similarity s = 0.8
SIMILAR = 0.8      # Jaccard similarity of five-word shingles
LOOSE = 0.3        # taken off it for the estimate: over 5 standard errors of 0.052, over 3 for sets of a few shingles
HEAVY = 1 << 22    # shingles of one group that one task holds, twice


def likeness(a: np.ndarray, b: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Jaccard similarity of shingle sets estimated from their fingerprints (the last ``lanes`` words)."""
    apart = np.bitwise_count(a[:, -lanes:] ^ b[:, -lanes:]).sum(1)
    cosine = np.cos(np.pi * apart / (64 * lanes))
    return cosine / (2 - cosine)


def document_shingles(text: bytes | None, cache: Interner, shingle: int = 5) -> np.ndarray:
    """The distinct shingles of a text, as sorted hashes."""
    w = text.lower().split() if text else []
    return np.unique(shingle_hashes(np.fromiter(map(cache.__getitem__, w), U64, len(w)), shingle))


def document_lanes(sets: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """The SimHash of a set of shingles, ``lanes`` words."""
    return pack_bits(signed_votes(sets, lanes)) if len(sets) else np.zeros(lanes, U64)


def document_bands(sets: np.ndarray, bands: int = BANDS, deep: int = DEEP) -> np.ndarray:
    """A key for each band of ``deep`` MinHash values."""
    odd = mix(np.arange(1, bands * deep + 1, dtype=U64)) | U64(1)
    low = (sets * odd[:, None]).min(1, initial=U64(0xFFFFFFFFFFFFFFFF)).reshape(bands, deep)
    keys = np.arange(1, bands + 1, dtype=U64)
    for c in range(deep):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + low[:, c])
    return keys


def set_labels(sets: list[np.ndarray], similar: float) -> np.ndarray:
    """Per set the smallest position linked to it by Jaccard similarities of at least ``similar``; exact.

    Only sets outside the largest class so far are compared with the others, so
    a dense group costs a few comparisons instead of all its pairs.
    """
    n = len(sets)
    label, size = np.arange(n), np.array([len(s) for s in sets])
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, 0]) if both >= similar * (size.sum() - both) else label
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(n), size)[np.argsort(code, kind="stable")]
    count = np.bincount(code)
    start, end = np.cumsum(count) - count, np.cumsum(size)
    asked = np.zeros(n, bool)
    while True:
        outside = np.flatnonzero(~asked & (label != np.bincount(label, minlength=n).argmax()))
        if not len(outside):
            return label
        for i in outside[:64].tolist():
            asked[i] = True
            own = code[end[i] - size[i]:end[i]]
            many = count[own]
            at = np.repeat(start[own] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            both = np.bincount(owner[at], minlength=n)
            found = np.flatnonzero(both >= similar * (size[i] + size - both))
            label = _merge(label, np.full(len(found), i), found)
            if (label == 0).all():
                return label


def exact_links(docs: DataFrame, members: DataFrame, key: str, text: str, shingle: int, similar: float, tile: int = TILE) -> DataFrame:
    """(src, dst) of a forest that connects what is alike inside each group of candidates.

    ``members`` (id, root, key, __text, size) names a row of ``docs`` for each
    candidate; groups above ``tile`` rows or ``HEAVY`` shingles are dealt over tiles.
    """
    hot = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    hot = hot.select("root", F.ceil(F.greatest(F.col("n") / tile, F.col("weight") / HEAVY)).cast("int").alias("tiles")).filter("tiles > 1")
    hot = settle(hot, "hot-groups")
    if hot.isEmpty():
        placed = members.withColumn("pair", F.lit(0).cast("long"))
    else:
        tiles = F.coalesce("tiles", F.lit(1))
        placed = (members.join(hot, "root", "left").withColumn("own", F.pmod(F.xxhash64("id"), tiles))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
                  .withColumn("pair", F.least("own", "other") * (1 << 31) + F.greatest("own", "other")))
    placed = placed.select("root", "pair", "id", F.col(key).alias("__key"), F.col("__text").alias("__kept"))
    own = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__whole")).withColumn("__text", F.xxhash64("__whole"))
    rows = own.join(placed, own[key].eqNullSafe(placed["__key"]) & (own["__text"] == placed["__kept"]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Interner(word_hash)
        group, held = None, {}

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                ids = np.array(list(held))
                label = set_labels(list(held.values()), similar)
                linked = np.flatnonzero(label != np.arange(len(label)))
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], ["src", "dst"])

        for batch in slices(batches):
            for root, pair, i, t in zip(*(batch.column(c).to_pylist() for c in range(3)), raw_texts(batch.column(3))):
                if (root, pair) != group:
                    yield from done()
                    group, held = (root, pair), {}
                if i not in held:       # repeated rows
                    held[i] = document_shingles(t, cache, shingle)
            cache.trim()
        yield from done()

    return (rows.select("root", "pair", "id", "__whole").repartition("root", "pair").sortWithinPartitions("root", "pair")
            .mapInArrow(work, "src long, dst long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    similar: float = SIMILAR) -> DataFrame:
    """(key, __text, __rows, __keep): which of the distinct (key, text) rows stay, one per group.

    Documents whose sets of ``shingle``-word shingles have a Jaccard similarity
    of at least ``similar`` are linked. Bands and an estimate retrieve groups of
    candidates, in which the sets themselves are compared; of each component the row with the smallest
    key stays, then the smallest text hash; null keys stay last. Texts without
    words are copies of each other. ``__text`` is the XXH64 of the text and
    ``__rows`` how often the row occurs.
    """
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__whole"))
    own = own.withColumn("__text", F.xxhash64("__whole")).select(key, "__text", "__whole")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Interner(word_hash)
        for batch in slices(batches):
            sets = [document_shingles(t, cache, shingle) for t in raw_texts(batch.column(2))]
            cache.trim()
            longs = lambda rows, size: pa.ListArray.from_arrays(np.arange(0, len(rows) * size + 1, size, dtype=np.int32), np.concatenate(rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], pa.uint64()).view(pa.int64()),
                 pa.array([len(s) for s in sets], pa.int32()),
                 longs([document_lanes(s) for s in sets], LANES), longs([document_bands(s) for s in sets], BANDS)],
                [key, "__text", "__set", "__size", "lanes", "bands"])

    made = settle(own.mapInArrow(work, f"`{key}` {kind}, __text long, __set long, __size int, lanes array<long>, bands array<long>"), "signatures")
    rows = made.groupBy(key, "__text").agg(F.count(F.lit(1)).alias("__rows"), F.first("__set").alias("__set"), F.first("__size").alias("__size"),
                                           F.first("lanes").alias("lanes"), F.first("bands").alias("bands"))
    rows = settle(rows, "rows")
    # one row per set of shingles: copies meet map-side and never in the index
    distinct = rows.groupBy(F.col("__set").alias("id")).agg(F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key), F.col("__text"))).alias("low"),
                                             F.first("__size").alias("size"), F.first("lanes").alias("lanes"), F.first("bands").alias("bands"))
    distinct = settle(distinct, "distinct-signatures")
    found = links(distinct.select("id", "lanes", "bands"), LANES, NEAR, agree=lambda a, b: likeness(a, b) >= similar - LOOSE, buckets="bands")
    groups = settle(components(found), "candidates")
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    members = distinct.join(groups, distinct["id"] == groups["node"])
    members = settle(members.select("id", "root", F.col("low")[key].alias(key), F.col("low")["__text"].alias("__text"), "size"), "members")
    roots = components(exact_links(docs, members, key, text, shingle, similar))
    classed = distinct.join(roots, distinct["id"] == roots["node"], "left").withColumn("class", F.coalesce("root", "id"))
    kept = classed.groupBy("class").agg(F.min("low").alias("low"))
    kept = kept.select(F.col("low")[key].alias(key), F.col("low")["__text"].alias("__text"), F.lit(True).alias("__keep"))
    same = rows[key].eqNullSafe(kept[key]) & (rows["__text"] == kept["__text"])
    return rows.join(kept, same, "left").select(rows[key], rows["__text"], "__rows", F.coalesce("__keep", F.lit(False)).alias("__keep"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; all columns as they came."""
    stays = near_duplicates(docs, key, text, shingle, similar).filter("__keep")
    stays = stays.select(F.col(key).alias("__key"), F.col("__text").alias("__kept"))
    own = docs.withColumn("__text", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = own.join(stays, own[key].eqNullSafe(F.col("__key")) & (own["__text"] == F.col("__kept")), "left_semi")
    first = Window.partitionBy(key, "__text").orderBy(F.lit(0))
    return joined.withColumn("__n", F.row_number().over(first)).filter("__n = 1").select(*docs.columns)

"""Gray index, components, fingerprints and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from riskweave.llm import fingerprints as FP
from riskweave.llm import gray as G
from riskweave.llm.components import components
from riskweave.llm.text import Interner, word_hash


def classes(nodes, pairs):
    par = {n: n for n in nodes}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            par[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    pairs = {"chain": [(i, i + 1) for i in range(70)], "star": [(99, i) for i in range(50)] + [(5, 5)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": []}[kind]
    want = classes({n for p in pairs for n in p}, pairs)
    got = components(spark.createDataFrame([*pairs, *pairs[:3]], "src long, dst long")).collect()
    assert {(r.node, r.root) for r in got} == {(n, r) for n, r in want.items() if n != r}


def _clouds(rng, n):
    """Centres with near variants: dense groups and strangers."""
    out = set()
    while len(out) < n:
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40])):
            x = c
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return np.array(sorted(out)[:n], np.uint64)


def test_gray_rank_orders_neighbours_by_one_bit():
    codes = np.array([i ^ i >> 1 for i in range(64)], np.uint64)
    assert G.gray_rank(codes).tolist() == list(range(64))


@pytest.mark.parametrize("n,radius", [(1, 2), (17, 2), (400, 0), (400, 3), (900, 8)])
def test_index_finds_all_and_nothing_else(n, radius):
    rng = random.Random(n + radius)
    f = _clouds(rng, n)
    bucket = np.sort(np.array([rng.randrange(3) for _ in range(n)]))
    bucket = np.unique(bucket, return_inverse=True)[1]
    order = np.lexsort((G.gray_rank(f), bucket))
    f, bucket = f[order], bucket[order]
    who, item = G.GrayIndex(bucket, f).search(bucket, f, radius)
    want = {(i, j) for i in range(n) for j in range(n) if bucket[i] == bucket[j] and int(f[i] ^ f[j]).bit_count() <= radius}
    assert sorted(zip(who.tolist(), item.tolist())) == sorted(want)


@pytest.mark.parametrize("n", [50, 1500])
def test_bucket_labels_are_components(n):
    rng = random.Random(n)
    f = _clouds(rng, n)
    f = f[np.argsort(G.gray_rank(f))]
    label = G.bucket_labels(np.zeros(n, np.int64), f, 2)
    pairs = [(i, j) for i in range(n) for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 2) + i + 1]
    assert label.tolist() == [classes(range(n), pairs)[i] for i in range(n)] if n < 100 else len(set(label)) == len(set(classes(range(n), pairs).values()))


@pytest.mark.parametrize("seed", range(8))
def test_bucket_labels_join_bridged_clouds(seed):
    rng = random.Random(seed)
    a, bits = rng.getrandbits(64), rng.sample(range(64), 64)
    flip = lambda x, *some: x ^ sum(1 << b for b in some)
    rows = {flip(a, *bits[:2]), flip(a, *bits[:3])}         # the bridge
    for c in (a, flip(a, *bits[:5])):
        rows |= {c} | {flip(c, *{x, y}) for x in bits[5:20] for y in bits[5:20]}
    f = np.array(sorted(rows), np.uint64)
    f = f[np.argsort(G.gray_rank(f))]
    n = len(f)
    label = G.bucket_labels(np.zeros(n, np.int64), f, 2)
    pairs = [(i, j) for i in range(n) for j in range(i) if int(f[i] ^ f[j]).bit_count() <= 2]
    assert n > 200 and label.tolist() == [classes(range(n), pairs)[0]] * n == [0] * n


@pytest.mark.parametrize("tile", [4, 8192])
def test_links_miss_nothing(spark, tile):
    f = _clouds(random.Random(9), 300)
    prints = spark.createDataFrame([(i, [x]) for i, x in enumerate(f.view(np.int64).tolist())], "id long, lanes array<long>")
    got = [(r.src, r.dst) for r in G.links(prints, 1, 2, tile=tile).collect()]
    want = [(i, j) for i in range(300) for j in range(i) if int(f[i] ^ f[j]).bit_count() <= 2]
    assert classes(range(300), got) == classes(range(300), want)
    assert all(int(f[a] ^ f[b]).bit_count() <= 64 for a, b in got)


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    runs = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_classes(docs, corpus):
    got = G.fingerprint_classes(docs).collect()
    prints = {t: brute_fingerprint(t) for _, t in corpus}
    assert collections.Counter((r.doc_id, r.fingerprint % 2**64) for r in got) == collections.Counter((d, prints[t]) for d, t in corpus)
    fps = sorted(set(prints.values()))
    root = classes(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    low = {}
    for d, t in corpus:
        c = root[prints[t]]
        low[c] = min(x for x in (low.get(c), d) if x is not None) if d is not None or low.get(c) is not None else None
    assert {(r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got} == {(d, prints[t], low[root[prints[t]]]) for d, t in corpus}


def test_near_duplicates_keep_one(spark, words):
    rng = random.Random(8)
    base = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(4)]                                   # exact
    for i in range(4, 8):                                                             # one word of 200
        w = base[i].split()
        w[50] = "other"
        rows.append((100 + i, " ".join(w)))
    for i in range(8, 12):                                                            # half the words
        w = base[i].split()
        rows.append((100 + i, " ".join(w[:100] + [rng.choice(words) for _ in range(100)])))
    rows += [(3, base[3]), (None, base[2]), (None, None), (500, ""), (501, None)]
    docs = spark.createDataFrame([(d, t, "a", 1, 2) for d, t in rows], "doc_id long, text string, lanes string, id int, `class` int")
    kept = G.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), *range(108, 112), 500]


def _edited(rng, words, similarity, kind):
    """A text and a copy with a passage appended, cut off or put in the middle; of about this similarity."""
    w = [rng.choice(words) + rng.choice(words) for _ in range(300)]
    n = round(300 * (1 / similarity - 1))
    fresh = [rng.choice(words) + rng.choice(words) for _ in range(n)]
    return " ".join(w), " ".join({"append": w + fresh, "cut": w[:round(300 * similarity)], "middle": w[:150] + fresh + w[150:]}[kind])


@pytest.mark.parametrize("kind", ["append", "cut", "middle"])
def test_near_duplicates_are_retrieved(spark, words, kind):
    rng = random.Random(kind)
    pairs = [_edited(rng, words, s, kind) for s in (0.82, 0.85, 0.9) for _ in range(60)]
    cache = Interner(word_hash)
    made = [(x, G.document_lanes(s), G.document_bands(s)) for x, t in enumerate(t for p in pairs for t in p)
            for s in [G.document_shingles(t.encode(), cache)]]
    longs = lambda a: a.view(np.int64).tolist()
    prints = spark.createDataFrame([(x, longs(a), longs(b)) for x, a, b in made], "id long, lanes array<long>, bands array<long>")
    got = {frozenset((r.src, r.dst)) for r in G.links(prints, G.LANES, G.NEAR, buckets="bands").collect()}
    assert sum(frozenset((2 * i, 2 * i + 1)) in got for i in range(len(pairs))) >= 0.98 * len(pairs)


def test_near_duplicates_are_those_of_brute_force(spark, words):
    rng = random.Random(12)
    texts = [t for s in (0.72, 0.77, 0.79, 0.8, 0.81, 0.83, 0.9) for k in ("append", "cut", "middle") for _ in range(5) for t in _edited(rng, words, s, k)]
    for _ in range(4):                              # chains of small steps
        w = texts[0].split()[::-1] if not _ else [rng.choice(words) for _ in range(120)]
        for step in range(5):
            texts.append(" ".join(w))
            w = w[8:] + [rng.choice(words) for _ in range(8)]
    n = len(texts)
    own = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    want = classes(range(n), [(i, j) for i in range(n) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in G.keep_one(docs).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("n", [2, 3, 40, 400])
def test_set_labels_are_components(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, (max(1, n // 20), 60)).astype(np.uint64)
    sets = [np.unique(np.r_[rng.choice(base[i % len(base)], 60 - k, replace=False), rng.integers(0, 2**63, k).astype(np.uint64)])
            for i in range(n) for k in [int(rng.integers(0, 12))]]
    own = [set(s.tolist()) for s in sets]
    pairs = [(i, j) for i in range(n) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
    assert G.set_labels(sets, 0.8).tolist() == list(classes(range(n), pairs).values())


@pytest.mark.parametrize("tile", [2, 8192])
def test_exact_links(spark, words, tile):
    rng = random.Random(4)
    texts = [t for s in (0.75, 0.85) for _ in range(6) for t in _edited(rng, words, s, "append")]
    docs = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string")
    members = docs.distinct().selectExpr("doc_id + 100 as id", "-1L as root", "doc_id", "xxhash64(text) as __text", "300 as size")
    got = [(r.src - 100, r.dst - 100) for r in G.exact_links(docs, members, "doc_id", "text", 5, 0.8, tile).collect()]
    assert classes(range(24), got) == {i: i - (i % 2 if i >= 12 else 0) for i in range(24)}


def test_empty(nothing):
    assert G.fingerprint_classes(nothing).collect() == [] and G.keep_one(nothing).collect() == []
    assert FP.edited_fingerprints(nothing).collect() == []


def test_edited_fingerprints(docs, corpus):
    got = FP.edited_fingerprints(docs).collect()
    assert len(got) == len(corpus)
    cache = Interner(word_hash)
    known = [(d, t or "") for d, t in corpus if d is not None]
    order = sorted(known, key=lambda r: -r[0])
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, (d, t) in enumerate(order):
        if d == 7 or i + 1 == len(order) or order[i + 1][0] == 7:
            continue        # equal keys are ordered by hash; the last one goes on with a null key
        n = order[i + 1][1]
        k = len(t) // 3
        edited = t[:len(t) - k] + n[:k]
        r = by[d][0]
        own, changed, following = (FP.fingerprint(x.encode(), cache) for x in (t, edited, n))
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.lanes == own.view(np.int64).tolist() and r.edited_lanes == changed.view(np.int64).tolist()
        assert (r.near_edited, r.near_next) == (FP.likeness(own, changed), FP.likeness(own, following))


@pytest.mark.parametrize("tile", [3, 8192])
def test_near_counts(spark, tile):
    rng = random.Random(4)
    rows = set()
    while len(rows) < 150:
        c = rng.getrandbits(128)
        for _ in range(rng.choice([1, 2, 12])):
            x = c
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(128)
            rows.add(x)
    whole = sorted(rows)
    lanes = {x: [((x >> 64) + 2**63) % 2**64 - 2**63, (x % 2**64 + 2**63) % 2**64 - 2**63] for x in whole}
    prints = spark.createDataFrame([(v,) for v in lanes.values()], "lanes array<long>")
    got = {tuple(r.lanes): r.near for r in FP.near_counts(prints, tile=tile).collect()}
    want = {tuple(lanes[x]): n for x in whole if (n := sum(0 < (x ^ y).bit_count() <= 3 for y in whole))}
    assert got == want

"""Periodic runs against a comparison of every text with itself at every lag."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import runs as R


def slow_runs(w, least=12):
    """All (start, end, smallest period) by definition."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        x = 0
        while x + q < len(w):
            if w[x] != w[x + q]:
                x += 1
                continue
            e = x
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            s, end = x, e + q
            if end - s >= max(least, 2 * q) and not any(all(w[i] == w[i + p] for i in range(s, end - p)) for p in range(1, q)):
                out.add((s, end, q))
            x = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def _cases():
    rng = random.Random(11)
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    while len(thue) < 512:
        thue += thue.translate(str.maketrans("ab", "ba"))
    ab = "ab" * 40 + "a"
    cases = ["", "a", "a" * 300, fib[-1], thue, thue * 2, ab + ab, ("abc" * 30 + "ab") * 3, ("a" * 50 + "b") * 6, "ab" * 60 + "ba" * 70,
             "a" * 30 + "b" + "a" * 30 + "b" + "a" * 90, ("ab" * 20 + "c") * 4 + ("ab" * 20 + "d") * 5]
    for _ in range(120):
        letters = "ab" if rng.random() < 0.5 else "abcdefghij"
        t = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        for _ in range(rng.randint(1, 4)):      # nested repeats
            a = rng.randrange(len(t))
            p = rng.randint(1, max(1, len(t) - a))
            t = t[:a] + (t[a:a + p] * rng.randint(1, 5))[:rng.randint(1, 260)] + t[a + p:]
        cases.append(t[:420])
    return cases


@pytest.mark.parametrize("direct", [8, 16, 32])
def test_runs_equal_brute_force(direct):
    texts = _cases()
    counts = np.array([len(t) for t in texts])
    starts = np.cumsum(counts + 1) - counts - 1
    words = np.concatenate([np.array([ord(c) for c in t] + [-1 - i], np.int64) for i, t in enumerate(texts)])
    got = {i: [] for i in range(len(texts))}
    for s, e, p in R.find_runs(words, starts, counts, direct).tolist():
        i = int(np.searchsorted(starts, s, "right")) - 1
        got[i].append((s - starts[i], e - starts[i], p))
    for i, t in enumerate(texts):
        assert got[i] == slow_runs(t), (direct, t)


def test_long_periods_and_long_texts_take_linear_work():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 50_000, 30_000)
    words = np.concatenate([np.tile(base, 5)[:140_000], [-1], np.zeros(200_000, np.int64), [-2], np.tile([1, 2, 3], 70_000), [-3]])
    counts = np.array([140_000, 200_000, 210_000])
    starts = np.cumsum(counts + 1) - counts - 1
    got = R.find_runs(words, starts, counts)
    assert [0, 140_000, 30_000] in got.tolist() and [140_001, 340_001, 1] in got.tolist() and [340_002, 550_002, 3] in got.tolist()
    assert len(got) == 3


def test_rows(spark, docs, corpus, nothing):
    extra = [(900, " ".join(["x y z"] * 9) + " end"), (901, "a " * 30), (902, "L1 one two. " * 3 + "L2 " + "one two. " * 8)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    found = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in R.periodic_runs(table.repartition(3)).collect()), key=str)
    want = []
    for d, t in [*corpus, *extra]:
        w = (t or "").split()
        runs = slow_runs(w)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        want.append((d, [(s, e - s, q) for s, e, q in runs], " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert found == sorted(want, key=str)
    assert R.periodic_runs(nothing).collect() == []


def test_digest_and_tails(spark, words):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(150)] + [(None, "a b " * 9), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.collapsed_sha256): r for r in R.run_digest(R.periodic_runs(R.with_repeated_tails(docs))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    seen = 0
    for d, t in rows:
        w = (t or "").split()
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = [(s, e - s, q) for s, e, q in slow_runs(w)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        r = got[d, sha(" ".join(x for i, x in enumerate(w) if i not in gone))]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        seen += bool(runs)
    assert seen > 5


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum dolor " * 60_000)], "doc_id long, text string")
    r, = R.run_digest(R.periodic_runs(docs)).collect()
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 180_000, 3, 60_000_000)
    with pytest.raises(ValueError):
        R.periodic_runs(docs, direct=12)
    assert R.with_repeated_tails(docs).filter(F.col("text").isNull()).count() == 0

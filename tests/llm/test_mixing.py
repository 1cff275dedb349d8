"""Mixing: targets, flows and selections against plain Python."""

import collections
import itertools
import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riskweave.llm import flow, mixing as M


def test_shares_are_shared_again_until_none_is_above():
    assert M.shares({"a": 10, "b": 10, None: 80}, (5, 2, 1)) == {"a": 30, "b": 30, None: 40}
    assert M.shares({"a": 100, "b": 100}, (1,)) == {"a": 100, "b": 100}
    assert M.shares({"é": 0, "z": 6, "a": 9}, (5, 2, 1), 3) == {"a": Fraction(75, 7), "z": Fraction(30, 7), "é": 0}
    assert M.shares({}, (1,)) == {} and M.shares({"a": 0}, (1,)) == {"a": 0}


def _least_cost(patterns, quotas, repeats):
    """(most words routed, their least cost) by trying all whole flows."""
    best = (0, 0)
    ways = []
    for members, words in patterns:
        ways.append([w for w in itertools.product(range(repeats * words + 1), repeat=len(members)) if sum(w) <= repeats * words])
    for choice in itertools.product(*ways):
        into, cost = collections.Counter(), 0
        for (members, words), w in zip(patterns, choice):
            for s, n in zip(members, w):
                into[s] += n
            cost += sum(max(0, sum(w) - use * words) for use in range(1, repeats)) if words else 0
        if all(into[s] <= q for s, q in quotas.items()):
            best = max(best, (sum(into.values()), -cost))
    return best[0], -best[1]


def test_flow_is_largest_and_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        names = "ab" if rng.random() < 0.5 else "abc"
        patterns = [(sorted(rng.sample(names, rng.randint(1, 2))), rng.randint(0, 3)) for _ in range(rng.randint(1, 3))]
        quotas = {s: rng.randint(0, 6) for s in names}
        routed = flow.route(patterns, quotas, 2)
        into = collections.Counter()
        cost = 0
        for (members, words), way in zip(patterns, routed):
            assert set(way) == set(members) and sum(way.values()) <= 2 * words
            into.update(way)
            cost += max(0, sum(way.values()) - words)
        assert all(into[s] <= q for s, q in quotas.items())
        assert (sum(into.values()), cost) == _least_cost(patterns, quotas, 2)


def test_overlapping_sources_use_shared_words_before_repeating(spark):
    rows = [(i, "w " * 10, ["a"]) for i in range(10)] + [(100 + i, "w " * 10, ["b", "a", "a"]) for i in range(10)]
    made = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source array<string>"), (3, 1))
    got = {r.source: r for r in made.sources.collect()}
    assert (got["a"].source_size, got["b"].source_size) == (200, 100) and sum(r.target for r in got.values()) == 300
    taken = {r.doc_id: r.taken for r in made.rows.collect()}
    # 225 words for a and 75 for b: all 200 once and the rest twice
    assert sum(taken.values()) == 300 and min(taken.values()) == 10 and max(taken.values()) == 20


def _reference(hashed, weights):
    """Rows of ``mix`` for one source per document, from (key, source, size, hash)."""
    sizes = collections.Counter()
    groups = collections.defaultdict(list)
    for k, s, n, h in hashed:
        sizes[s] += n
        groups[s].append((h, k is None, k or 0, n))
    targets = M.shares(dict(sizes), weights)
    out = collections.Counter()
    for s, docs in groups.items():
        docs.sort()
        copies, rest = divmod(round(targets[s]), sizes[s]) if sizes[s] else (0, 0)
        parts = max(1, -(-len(docs) // M.EDGE_ROWS))
        room, edge, extra = rest, None, collections.Counter()
        for p in range(parts):
            total = sum(d[3] for d in docs if d[0] * parts >> M.BITS == p)
            if edge is None and room <= total and room:
                edge = p
            elif edge is None and room:
                room -= total
                extra.update(d for d in docs if d[0] * parts >> M.BITS == p)
        inside = [d for d in docs if d[0] * parts >> M.BITS == edge]
        for d in inside:
            if 0 < d[3] <= room:
                extra[d] += 1
                room -= d[3]
        left = collections.Counter(inside) - extra
        least = min((d[3] for d in left if d[3]), default=0)
        if room and least and least - room < room:
            extra[next(d for d in inside if d[3] == least and left[d])] += 1
        for d, n in collections.Counter(docs).items():
            for i in range(n):
                out[(None if d[1] else d[2], s, d[3], d[3] * (copies + (i < min(n, extra[d]))))] += 1
    return out, sizes, targets


@pytest.mark.parametrize("edge", [1 << 16, 16])
def test_mix_equals_plain_python(spark, docs, monkeypatch, edge):
    monkeypatch.setattr(M, "EDGE_ROWS", edge)
    monkeypatch.setattr(M, "EXPANDED", 2)
    named = docs.withColumn("source", F.when(F.pmod(F.coalesce("doc_id", F.lit(1)), F.lit(7)) < 4, F.lit("b")).when(F.pmod("doc_id", F.lit(7)) < 6, "a\"é"))
    named = named.unionByName(named.filter("doc_id < 9")).unionByName(named.filter("doc_id = 5")).withColumn("taken", F.lit(1)).withColumn("pattern", F.lit("p"))
    hashed = named.select("doc_id", "source", M.word_count("text").alias("n"))
    hashed = hashed.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col("doc_id").cast("string"), "n"), 64 - M.BITS))
    want, sizes, targets = _reference([tuple(r) for r in hashed.collect()], (5, 2, 1))
    made = M.mix(named.repartition(5), (5, 2, 1))
    got = collections.Counter((r.doc_id, json.loads(r.pattern)[0], r.size, r.taken) for r in made.rows.collect())
    assert got == want
    assert {r.source: (r.source_size, r.target, r.routed) for r in made.sources.collect()} == {
        s: (n, float(targets[s]), round(targets[s])) for s, n in sizes.items()}
    again = M.mix(named.repartition(2, "text"), (5, 2, 1)).rows.select("doc_id", "size", "taken").collect()
    assert collections.Counter(again) == collections.Counter(made.rows.select("doc_id", "size", "taken").collect())


def test_targets_are_met_closely(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = M.mix(docs, (5, 2, 1))
    taken = {json.loads(r.pattern)[0]: r.t for r in made.rows.groupBy("pattern").agg(F.sum("taken").alias("t")).collect()}
    for r in made.sources.collect():
        assert abs(taken[r.source] - r.target) <= 0.01 * r.target + 1, r
    assert made.rows.filter("taken > 3 * size OR taken < 0 OR (size > 0 AND taken % size <> 0)").count() == 0


def test_nothing_to_mix(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    made = M.mix(none, (5, 2, 1))
    assert made.rows.collect() == [] and made.sources.collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in M.mix(wordless, (5, 2, 1)).rows.select("doc_id", "size", "taken").collect()) == [(1, 0, 0), (2, 0, 0)]
    same = spark.createDataFrame([(1, "a b", "x")] * 300 + [(2, "c", "y")], "doc_id long, text string, source string")
    rows = M.mix(same, (1, 1)).rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("taken").alias("t")).collect()
    assert {r.doc_id: (r.n, r.t) for r in rows} == {1: (300, 598), 2: (1, 3)}

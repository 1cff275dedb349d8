"""Collocations against counting by hand."""

import collections
import random
import re

import pytest

from riskweave.llm import phrases as P


def by_hand(rows, support, absorb, most):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) == 1 or a < support:
            continue
        if len(p) == 2 and any(100 * b >= absorb * a for (x, q), b in f.items()
                               if x == lang and len(q) == 3 and b >= support and p in (q[:2], q[1:])):
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:most]))


def _rows():
    rng = random.Random(8)
    words = ["The", "cat", "sat", "on", "a", "mat", "É", "naïve", "x\x1cy", "日本", "\x00", "don't"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ;", "!?", "\x0b"]
    rows = []
    for i in range(120):
        t = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), t))
    rows += [("en", "New York City "), ("en", "new york")] * 15 + [("fr", None), (None, ""), ("de", "...!"), ("fr", "la la " * 200)]
    return rows


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(P, "READ", 40)
    for text in [*(t for _, t in _rows() if t), "no mark at all " * 20, "a." * 100, "b" * 90 + "!" + "c" * 90]:
        parts = list(P._parts(text.encode()))
        cut = lambda t: [p for p in re.split(rb"[.,;:!?\x0A-\x0D]", t) if p]
        assert [p for part in parts for p in cut(part)] == cut(text.encode())


@pytest.mark.parametrize("parts,shards,held", [(1, 4, 1 << 20), (5, 2, 300), (7, 4, 1 << 20), (3, 1, 100)])
def test_phrases_equal_brute_force(spark, monkeypatch, parts, shards, held):
    monkeypatch.setattr(P, "HELD", held)
    rows = _rows()
    docs = spark.createDataFrame([(i, *r, 1, 2) for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase int, n int")
    found = P.first_phrases(P.collocations(docs.repartition(parts), shards=shards, support=6), 25)
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())
    want = by_hand(rows, 6, 50, 25)
    assert len(want) > 25 and got == want


def test_local_support_keeps_what_is_frequent_in_all(spark):
    # a phrase that is just frequent in all, spread over shards of very different sizes
    rows = [("en", "rare pair. " * k + "filler word%d. " % k * 40 * k) for k in (1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = {r.phrase: r.a for r in P.collocations(docs).collect()}
    assert got["rare pair"] == 10


def test_numbers_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 3 * 10**12), ("en", "b", 1, 10**12 + 1), ("en", "a b", 2, 10**12)],
                                   "lang string, phrase string, size int, f long")
    row, = P.scored(counts, 3, 50).collect()
    assert (row.score, row.n) == (10**6 * 10**24 // (3 * 10**12 * (10**12 + 1)), 4 * 10**12 + 1)


def test_no_phrases(nothing):
    assert P.first_phrases(P.collocations(nothing), 5).collect() == []
    with pytest.raises(ValueError):
        P.collocations(nothing, longest=4)

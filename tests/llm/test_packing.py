"""Tokens, linear grouping and packed rows against brute force."""

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskweave.llm import grouping as G
from riskweave.llm import packed as P
from riskweave.llm.tokens import ChunkTokenizer, public_path

PATH = public_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tok = Tokenizer.from_file(PATH)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


ODD = ["", None, "a  b\t\nc", "don't we've I'M x's 's", "<|endoftext|> hi<|startoftext|>", "x<|endoftext|>y <|EndOfText|> <|endoftext|\t>É<|startoftext|><|endoftext|>", "naïve Σίσυφος ΣΑΣ. İstanbul",
       "école café!! ÉTÉ,", "a b c\x1cd\x85e", "日本語 テスト。123 4.5e6", "😀👍🏽 ok", "ǅ ŉ ß ẞ ﬁ Å Å", "x" * 5000, "a.b.c 'q' `t`", "’s it’s", "é!"]


@pytest.mark.parametrize("cache", [3, 100_000])
def test_chunks_give_the_ids_of_whole_texts(whole, cache):
    tok = ChunkTokenizer(PATH, cache)
    for _ in range(2):
        ids, ends = tok.encode_batch([None if t is None else t.encode() for t in ODD])
        parts = np.split(ids, ends)[:-1]
        assert [p.tolist() for p in parts] == [whole(t) for t in ODD]


def _lengths(kind):
    rng = random.Random(kind)
    return {"mixed": [rng.randint(1, 2048) for _ in range(3000)], "small": [rng.randint(1, 60) for _ in range(500)],
            "full": [2048] * 50, "one": [7], "same": [700] * 1000, "tiny": [1] * 5000}[kind]


@pytest.mark.parametrize("kind", ["mixed", "small", "full", "one", "same", "tiny"])
def test_plan_places_every_piece_once(kind):
    lengths = _lengths(kind)
    made = G.plan(dict(collections.Counter(lengths)))
    fill = collections.defaultdict(list)
    ranks = collections.defaultdict(set)
    for length, rank, seq, offset, n in zip(*(made[c].tolist() for c in ("length", "rank", "sequence", "offset", "count"))):
        for i in range(n):
            ranks[length].add(rank + i)
            fill[seq + i].append((offset, length))
    assert {x: len(r) for x, r in ranks.items()} == dict(collections.Counter(lengths))
    for s in fill.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) == made["sequences"][0]
    bound = max(-(-sum(lengths) // 2048), sum(x > 1024 for x in lengths))
    assert len(fill) <= 1.06 * bound + 1 if kind != "same" else len(fill) == 500


ALONE = """
import collections, random
import numpy as np
from riskweave.session import local_session
from riskweave.llm import grouping
spark = local_session(1)
spark.range(3).count()
counts = collections.Counter(random.Random(3).choices(range(1, 2049), k=60000))
made = grouping.plan(dict(counts))
total = sum(n * k for n, k in counts.items())
assert made["count"].sum() == 60000 and made["sequences"][0] <= 1.02 * total / 2048
spark.stop()
"""


def test_plan_in_a_process_that_imports_numpy_before_spark():
    import os
    import subprocess
    import sys
    from pathlib import Path
    root = str(Path(__file__).resolve().parents[2])
    env = {**os.environ, "PYTHONPATH": root + os.pathsep + os.environ.get("PYTHONPATH", "")}
    assert subprocess.run([sys.executable, "-c", ALONE], timeout=120, env=env, cwd=root).returncode == 0


def test_wide_ids_where_the_vocabulary_needs_them(spark, whole):
    docs = spark.createDataFrame([(1, "a small text"), (2, None)], "doc_id long, text string")
    row, = P.packed_rows(docs.coalesce(1), end_id=70_000).collect()
    ids = np.frombuffer(row.ids, "<u4")
    assert len(ids) == 2048 and ids[:row.n_tokens].tolist() == [*whole("a small text"), 70_000, 70_000]


def test_configurations_never_exceed_the_demand():
    sizes, demand = [300, 520, 700, 1100], [40, 33, 21, 17]
    used = np.zeros(4, int)
    for column, times in G.configurations(sizes, demand, 2048):
        assert column @ np.array(sizes) <= 2048
        used += column * times
    assert (used <= demand).all()


def test_documents_packed(spark, docs, corpus, whole):
    rows = G.pack_documents(docs).collect()
    want = collections.Counter()
    for d, t in corpus:
        ids = np.array(whole(t) + [0], "<u4")
        for p, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s:s + 2048]
            want[(d, p, s, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for s in places.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def test_written_sequences_hold_their_ids(tmp_path, docs, corpus, whole):
    rows = G.write_packed(docs, f"file://{tmp_path}/packed").collect()
    assert sum(len(r.ids) for r in rows) == sum(len(whole(t)) + 1 for _, t in corpus)
    assert all(r.starts == sorted(r.starts) and r.starts[0] == 0 and len(r.ids) <= 2048 for r in rows)


def test_no_documents(nothing):
    assert G.pack_documents(nothing).collect() == [] and P.packed_rows(nothing).collect() == []


def test_segment_tree_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(200):
        cap = rng.choice([1, 2, 7, 16, 100, 2048])
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 60))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else cap) - n)
        got = P.best_fit_decreasing(lengths, cap)
        assert sorted(i for s in got for i in s) == list(range(len(lengths)))
        assert sorted(cap - sum(lengths[i] for i in s) for s in got) == sorted(rooms)


@pytest.mark.parametrize("window", [3000, 1_000_000])
def test_packed_rows_give_documents_back(docs, corpus, whole, window):
    rows = P.packed_rows(docs.repartition(3), window=window).collect()
    found = collections.defaultdict(list)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == 2048 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens:].any()
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            assert positions[a:b].tolist() == list(range(b - a))
            found[d].append((s, tuple(ids[a:b].tolist())))
    want = collections.defaultdict(list)
    for d, t in corpus:
        ids = whole(t) + [P.END_ID]
        want[d] += [(s, tuple(ids[s:s + 2048])) for s in range(0, len(ids), 2048)]
    assert {d: sorted(p) for d, p in found.items()} == {d: sorted(p) for d, p in want.items()}

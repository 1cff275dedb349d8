"""Shards, classifiers, templates, licenses and URLs against brute force or held-out accuracy."""

import collections
import random
import zlib

import numpy as np
import pytest

from riskweave.llm import language as L
from riskweave.llm import licenses as LI
from riskweave.llm import quality as Q
from riskweave.llm import templates as T
from riskweave.llm import urls as U
from riskweave.llm.sharding import assign_shards, balance, write_shards


# ---------------------------------------------------------------- shards

def brute_shards(rows, shards):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + 8 for _, t in order]
    total, at, out, slots = sum(sizes), 0, collections.Counter(), collections.Counter()
    for (d, t), s in zip(order, sizes):
        shard = min(shards - 1, max(0, at + s - (s // 2 + 1)) * shards // total)
        out[shard] += s
        at += s
    return out


def test_shards(docs, corpus):
    got = assign_shards(docs, 5).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in corpus)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    whole, most = sum(r.size for r in got), max(r.size for r in got)
    for s in by.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
        assert abs(sum(r.size for r in s) - whole / 5) <= most
    # contiguous: shards follow the order of the keys
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert keys == sorted(keys)


def test_shards_of_distinct_keys_are_those_of_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 3, 50, 400])) for i in range(300)]
    got = assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 7)
    assert {r["shard"]: r["bytes"] for r in balance(got).collect()} == dict(brute_shards(rows, 7))


def test_written_shards(tmp_path, docs, nothing):
    assert write_shards(docs, f"file://{tmp_path}/s", 3).count() == docs.count()
    assert assign_shards(nothing, 3).collect() == []


# ---------------------------------------------------------------- quality

@pytest.fixture(scope="module")
def graded(spark, words):
    """Prose and junk with labels; some labels are null, repeated or contradict each other."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(500):
        good = i % 3 > 0
        t = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(t) if good else " ".join(x + rng.choice(["***", "%%%", "$$$"]) for x in t), "en", i))
        labels.append((i, int(good)))
    rows += [(900, None, "en", 1), (901, "", "en", 1), (None, rows[1][1], "en", 1), (5, rows[5][1], "en", 1)]
    labels += [(1, 1), (7, None), (4, 0), (None, 1), (999, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, score int"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_quality_scores(graded):
    docs, labels = graded
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == 504 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 500 and r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 3 > 0) for r in held]) >= 0.97
    assert len({r.score for r in got if r.doc_id == 5}) == 1


def test_held_out_labels_teach_nothing(graded):
    docs, labels = graded
    other = labels.filter("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    a, b = (sorted((r.doc_id or -1, r.score) for r in Q.quality_scores(docs, x).collect()) for x in (labels, other))
    assert np.allclose([s for _, s in a], [s for _, s in b], atol=1e-6)


def test_quality_filter(graded, nothing, spark):
    docs, labels = graded
    kept = Q.quality_filter(docs, labels)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 900 not in ids and 901 not in ids
    assert np.mean([(i in ids) == (i % 3 > 0) for i in range(500)]) >= 0.97
    assert Q.quality_filter(nothing, labels).collect() == []
    assert Q.quality_scores(docs, labels.limit(0)).filter("score between 0 and 1").count() == 504


def test_temperature_and_one_class():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    net = Q.fit_network(x, (x[:, 0] > 0).astype(float), steps=300)
    assert ((net.score(x) > 0.5) == (x[:, 0] > 0)).mean() > 0.95 and net.temperature > 0
    assert np.allclose(Q.fit_network(x, np.ones(400)).score(x), 401 / 402)


# ---------------------------------------------------------------- language

@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(3)
    parts = {"aa": ["ka", "lo", "mi", "nu"], "bb": ["schr", "eit", "ung", "ver"], "cc": ["été", "eau", "oui", "çon"]}
    rows = []
    for i in range(240):
        lang = list(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40))), lang))
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "123 !!! 4", "cc"), (503, "kalo mi", None), (None, "verung", "bb"), (0, rows[0][1], "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(tongues):
    got = L.languages(tongues).collect()
    want = {r.doc_id: r.lang for r in tongues.collect()}
    assert len(got) == 246 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {500, 501, 502}
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) >= 0.98


def test_bundles_are_sums_of_bound_letters():
    codes = L.grams("Ab, c1d")
    assert [tuple(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in codes.tolist()] == [
        (" ", "a", "b"), ("a", "b", " "), ("b", " ", "c"), (" ", "c", " "), ("c", " ", "d"), (" ", "d", " ")]
    a, b, c = (L.letter_vectors(np.array([ord(x)]))[0] for x in "abc")
    bound = L.gram_vectors(L.grams("abc"))[1]
    assert (bound == np.roll(a, 2) * np.roll(b, 1) * c).all() and set(np.unique(bound)) == {-1, 1}
    assert len(L.grams(None)) == len(L.grams("12 !")) == 0


def test_profiles_equal_one_bundle(tongues):
    got = L.language_profiles(tongues)
    texts = [r.text for r in tongues.collect() if r.lang == "aa" and r.text]
    codes, times = np.unique(np.concatenate([L.grams(t) for t in texts]), return_counts=True)
    want = L.bundle(codes, times)
    assert np.allclose(got["aa"], want / np.linalg.norm(want), atol=1e-5)


def test_language_filter(tongues, nothing):
    kept = L.language_filter(tongues)
    assert kept.columns == tongues.columns
    assert {r.doc_id for r in tongues.collect()} - {r.doc_id for r in kept.collect()} == {500, 501, 502}
    assert L.language_filter(tongues.selectExpr("doc_id", "text", "cast(null as string) as lang")).count() == 243
    assert L.language_filter(nothing).collect() == [] and L.languages(nothing).collect() == []


@pytest.fixture(scope="module")
def spoken():
    """(doc_id, text, lang): three languages, and mixed, short and repeated texts."""
    rng = random.Random(11)
    parts = {"aa": ["ka", "lo", "mi", "nu", "ren", "tas"], "bb": ["schr", "eit", "ung", "ver", "lich", "o"], "cc": ["été", "eau", "oui", "çon", "le", "i"]}
    said = lambda l, n: " ".join("".join(rng.choice(parts[l]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, said(l, rng.randint(12, 90)), l) for i in range(450) for l in [list(parts)[i % 3]]]
    rows += [(600 + i, " ".join(said(l, 15) for l in parts), rng.choice([*parts, None])) for i in range(30)]
    rows += [(700 + i, said(l, rng.randint(1, 3)), None) for i in range(30) for l in [list(parts)[i % 3]]]
    rows += [(800, " ".join(["kalo"] * 300), "aa"), (801, "x" * 500, "aa"), (802, "q", "bb"), (None, rows[0][1], "aa"), (1, rows[1][1], "bb")]
    return rows


def junk(rng, n):
    """Texts of about 40 to 600 n-grams in no language: random letters, encoded runs, an unlearned script."""
    latin = "abcdefghijklmnopqrstuvwxyz"
    line = lambda letters, k: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(k))
    run = lambda k: "".join(rng.choice(latin + latin.upper() + "0123456789+/") for _ in range(k))
    return [make(rng.randint(8, 90)) for _ in range(n) for make in (lambda k: line(latin, k), lambda k: run(7 * k), lambda k: line("абвгдежзийклмноп", k))]


def test_language_filter_rejects_junk_and_unlearned_languages(spark, spoken):
    odd = [(1000 + i, t, [None, "aa", "bb", None][i % 4]) for i, t in enumerate(junk(random.Random(9), 20))]
    rows = spark.createDataFrame(spoken + odd, "doc_id long, text string, lang string").repartition(5)
    kept = [r.doc_id for r in L.language_filter(rows).collect()]
    assert sum(d is not None and d >= 1000 for d in kept) <= 0.05 * len(odd)
    assert sorted(d or -1 for d in kept if d is None or d < 1000) == sorted(d or -1 for d, _, _ in spoken)   # 0 or none: -1


def test_language_filter_keeps_a_language_of_rare_ngrams(spark, spoken):
    rng = random.Random(10)
    rare = [(2000 + i, "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(rng.randint(40, 200))), "dd") for i in range(90)]
    odd = [(1000 + i, t, "ab"[i % 2] * 2) for i, t in enumerate(junk(rng, 10))]
    kept = {r.doc_id for r in L.language_filter(spark.createDataFrame(spoken + rare + odd, "doc_id long, text string, lang string")).collect()}
    assert {d for d, _, _ in rare} <= kept and {d for d, _, _ in spoken} <= kept
    assert sum(d is not None and 1000 <= d < 2000 for d in kept) <= 0.05 * len(odd)


def test_language_bars(spark, spoken):
    rows = spark.createDataFrame(spoken, "doc_id long, text string, lang string")
    profiles = L.language_profiles(rows)
    bars = L.language_bars(rows, profiles)
    assert set(bars) == {"aa", "bb", "cc"} and all(L.JUDGED <= g and 0 < b < L.LEAST for x in bars.values() for g, b in x.items())
    detector, by = L.Detector(profiles), collections.defaultdict(list)
    for _, t, l in spoken:
        _, _, (grade,), (share,) = detector.examine([t])
        if l is not None:
            by[l, grade].append(share)
    for l, x in bars.items():
        for g, b in x.items():
            assert len(by[l, g]) >= L.ENOUGH and b == pytest.approx(L.LEAST * np.quantile(by[l, g], 0.25), abs=1e-3)
    # unrelated n-grams leave a share of 0 on average, with the deviation that bars have to pass
    shares = detector.examine(["".join(chr(0x20000 + 60 * i + j) for j in range(50)) for i in range(400)])[3]
    assert abs(np.mean(shares)) < 4 * detector.noise / 20 and np.std(shares) == pytest.approx(detector.noise, rel=0.3)
    few = L.language_bars(rows.filter("lang = 'aa'").limit(L.ENOUGH - 1), profiles)
    assert few == {}


# ---------------------------------------------------------------- templates

ITEM = "At noon Alice bought 12 apples for 30 dollars. How many apples can Alice buy for 90 dollars?"


def test_template_leaks(spark, words):
    rng = random.Random(1)
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    plain = noise(40)
    docs = [
        (1, f"{noise(30)}. {ITEM} {noise(20)}"),
        (2, "Hello. At noon Bob Smith bought 15 apples for 45 dollars. How many apples can Bob Smith buy for 80 dollars? Yes."),
        (3, "At noon Bob bought 15 apples for 45 dollars. How many apples can Carl buy for 80 dollars?"),     # two names for one
        (4, noise(200)), (5, None), (6, ""), (7, plain.upper()), (8, " ".join(plain.split()[:8])), (None, ITEM), (1, f"x {ITEM}"), (1, f"x {ITEM}"),
    ]
    bench = [(1, ITEM), (2, plain), (3, None), (4, ""), (5, "7 8 9 10"), (6, "two words")]
    d = spark.createDataFrame([(*r, "e", 1) for r in docs], "doc_id long, text string, hash string, pos int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in T.leaks(d, b).collect()}
    assert set(got) == {(1, 1), (2, 1), (None, 1), (7, 2)}
    assert got[2, 1].values_changed >= 3 and got[None, 1].values_changed == 0 and got[None, 1].share == 1
    kept = T.decontaminate(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]
    assert T.leaks(d, b.limit(0)).collect() == [] and T.leaks(d.limit(0), b).collect() == []


def test_items_with_names_in_front_and_items_of_placeholders(spark, words):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = "Anna has 5 red pens. Anna gives 2 pens to Ben. Ben buys 3 more pens."
    bench = [(1, item), (2, "7 8 9 10 11 12 13"), (3, "3 4"), (4, "The mill grinds 40 sacks a day. How many sacks does the mill grind in 3 weeks?")]
    docs = [(1, noise(20) + ". Carl has 8 red pens. Carl gives 4 pens to Dave. Dave buys 7 more pens. " + noise(9)),
            (2, "Carl has 8 red pens. Dave gives 4 pens to Carl. Eve buys 7 more pens."),       # names change about
            (3, noise(5) + " 7 8 9 10 11 12 13 " + noise(5)), (4, "7 8 9 1 2 12 13 " + noise(30)), (5, "it is 3 4 now"), (6, item.upper()), (7, f"He said: {item}"),
            (8, "Our mill grinds 75 sacks a day. How many sacks does the mill grind in 6 weeks?"), (9, noise(400)), (10, "1 2 3 5 6 7 " * 50)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in T.leaks(d, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got >= {(1, 1), (3, 2), (5, 3), (7, 1), (8, 4)}
    assert not got & {(2, 1), (4, 2), (9, 1), (9, 2), (9, 3), (9, 4), (10, 2)}


def test_canonical_tokens():
    canon = T.Canon(limit=3)
    for _ in range(2):
        tokens, values, slot = canon.tokens(b"The train left New York at 10:30, 5 km on. Then 7 stopped !!! km")
        assert slot.tolist() == [1, 0, 0, 1, 0, 1, 1, 1, 0, 1, 1, 0, 0]
        assert tokens[0] == tokens[3] == tokens[9] == T.NAME and tokens[5] == tokens[6] == tokens[10] == T.NUMBER and tokens[7] == T.UNIT
    assert len(canon.tokens(None)[0]) == len(canon.tokens(b" ... ")[0]) == 0


# ---------------------------------------------------------------- licenses

def test_license_notices_that_follow_one_another_are_told_apart(spark, words):
    mit, apache = LI.TEMPLATES["MIT"], LI.TEMPLATES["Apache-2.0-notice"]
    n, m = len(mit.split()), len(apache.split())
    filler = " ".join(words[k % len(words)] for k in range(7))
    half = apache.split()
    swapped = " ".join(half[m // 2:] + half[:m // 2])
    texts = {
        1: "\n".join([mit] * 6),
        2: "\n".join([apache] * 5),
        3: f"{filler} {mit}\n{mit} {filler} {mit}",
        # the middle holds words of the template's start; the next one follows whole
        4: " ".join(half[:m // 2] + half[:4] + half[m // 2:]) + " " + apache,
        5: swapped,
        6: " ".join([mit] * 400),
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in LI.license_spans(rows, {"MIT": mit, "A": apache}).collect():
        got.setdefault((r.doc_id, r.license), []).append((r.start_word, r.end_word))
    got = {k: sorted(v) for k, v in got.items()}
    assert got[1, "MIT"] == [(i * n, i * n + n) for i in range(6)]
    assert got[2, "A"] == [(i * m, i * m + m) for i in range(5)]
    assert got[3, "MIT"] == [(7, 7 + n), (7 + n, 7 + 2 * n), (14 + 2 * n, 14 + 3 * n)]
    assert got[4, "A"] == [(0, m + 4), (m + 4, 2 * m + 4)]
    assert got[5, "A"] == [(0, m)]
    assert got[6, "MIT"] == [(i * n, i * n + n) for i in range(400)]


def test_licenses_at_every_place(spark, words):
    rng = random.Random(7)
    rows, want = [], set()
    for i in range(120):
        name = sorted(LI.TEMPLATES)[i % len(LI.TEMPLATES)]
        before, after = ([rng.choice(words) for _ in range(rng.randint(0, 70))] for _ in range(2))
        rows.append((i, " ".join([*before, LI.TEMPLATES[name].upper() + ".", *after])))
        want.add((i, name, len(before)))
    rows += [(500 + i, " ".join(rng.choice(words) for _ in range(300))) for i in range(20)] + [(600, None), (601, ""), (602, "..."), (None, "Released under the MIT License")]
    got = LI.license_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    starts = collections.defaultdict(set)
    for r in got:
        starts[r.doc_id, r.license].add(r.start_word)
    assert all(at in starts[i, name] for i, name, at in want)
    assert not {r.doc_id for r in got} & {*range(500, 520), 600, 601, 602} and (None, "MIT") in starts
    # the short Apache line is part of the notice; nothing else is found beside the planted one
    extra = {(i, n) for i, n in starts if i is not None} - {(i, n) for i, n, _ in want}
    assert {n for _, n in extra} <= {"Apache-2.0"}


def test_bands_meet_with_the_wanted_probability():
    for j, rows in ((0.2, 1), (0.5, 2), (0.9, 4)):
        b = LI.bands_for(j, rows, 0.999)
        assert 1 - (1 - j ** rows) ** b >= 0.999 > 1 - (1 - j ** rows) ** (b - 1)


# ---------------------------------------------------------------- URLs

RULES = [U.Rule("block", "net", "/"), U.Rule("allow", "example.net", "/en/"), U.Rule("block", "example.com", "/de/"), U.Rule("allow", "org", "/fr/")]


def test_urls(spark):
    odd = [
        ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"), ("http://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
        ("HTTP://Www.Example.COM/de/x?y#z", "www.example.com", "/de/x", "example.com/de/", "block"), ("x://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://b.org/fr/a", "b.org", "/fr/a", "org/fr/", "allow"), ("http://casino.org/fr/a", "casino.org", "/fr/a", "org/fr/", "allow"),
        ("http://c.net", "c.net", "", None, "allow"), ("a.net/x", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("http://d.com?u=http://e.net/", "d.com", "", None, "allow"), ("ftp://ÀB.com#/x://y", "Àb.com", "", None, "allow"), ("://h.com/p://q?x", "h.com", "/p://q", None, None),
    ]
    pages = [(i, u, None) for i, (u, *_) in enumerate(odd)]
    rng = random.Random(3)
    good = ["garden", "river", "school", "music", "history"]
    for i in range(300):
        h = rng.choice(["casino-win", "free-bets", "cheap-pills", "casinowin"] if i % 5 == 0 else [rng.choice(good) + rng.choice(good)])
        pages.append((100 + i, f"http://www.{h}.com/en/{rng.randint(1, 99)}.html", "<p>win free cheap garden river school music history " * 3))
    df = spark.createDataFrame([(*p, "q") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in U.url_verdicts(df, RULES, df).collect()}
    assert len(got) == len(pages)
    for i, (_, *want) in enumerate(odd):
        r = got[i]
        # a made-up host without company has no sure score
        assert [r.host, r.path, r.rule] == want[:3] and r.verdict == (want[3] or r.verdict), r
    for i, u, _ in pages[len(odd):]:
        assert got[i].verdict == ("block" if any(x in u for x in ("casino", "bets", "pills")) else "allow"), got[i]
    assert U.url_verdicts(df.limit(0), RULES, df.limit(0)).collect() == []


def test_hosts_of_joined_words_teach_the_bad_class(spark):
    text = "<p>the river in the garden may win a casino </p>"
    pages = [(i, f"http://casinowin.com/{i}", text) for i in range(300)] + [(300 + i, f"http://gardenriver.com/{i}", text) for i in range(300)]
    long = "garden" * 40 + "casino"
    more = [(600, "http://casino-win1.com/", text), (601, "http://casino-win2.com/", text), (602, f"http://{long}.com/1", text)]
    for rows in (pages, pages + more):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = {r.page_id: r for r in U.url_verdicts(df, [], df).collect()}
        assert all(got[i].verdict == "block" for i in range(300)) and all(got[i].verdict == "allow" for i in range(300, 600))
    assert sorted(got[602].words) == ["casino", "com", *["garden"] * 40]


def test_bayes_equals_counting_by_hand(spark):
    text = "<p>garden river casino win free </p>"
    urls = ["http://casinowin.com/free/1", "http://garden-river.com/en/22", "http://river.com/free", "http://casino.com/", "http://garden.org/x", None]
    df = spark.createDataFrame([(i, u, text) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in U.url_verdicts(df, [], df).collect()}
    words = {i: [*r.words, *U.path_words(r.path)] for i, r in got.items()}
    bad = {i: bool({"casino"} & set(got[i].words)) for i in got}
    seen = {c: collections.Counter(w for i in got if bad[i] is c for w in words[i]) for c in (True, False)}
    size = len(set(seen[True]) | set(seen[False]))
    for i, r in got.items():
        odds = np.log((sum(bad.values()) + 1) / (len(bad) - sum(bad.values()) + 1))
        for w in words[i]:
            one, two = ((seen[c][w] + 1) / (sum(seen[c].values()) + size) for c in (True, False))
            odds += np.log(one / two)
        assert r.score == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-5) and r.verdict == ("block" if r.score > 0.5 else "allow")
    assert sorted(got[0].words) == ["casino", "com", "win"]


def test_viterbi_is_the_best_path():
    counts = {"casino": 50, "win": 40, "cas": 5, "in": 90, "ow": 30, "o": 60}
    known = [{"at": i, "size": len(w), "n": n} for w, n in counts.items() for i in range(9) if "casinowin"[i:].startswith(w)]

    def best(rest):
        if not rest:
            return 0.0, []
        paths = []
        for k in range(1, len(rest) + 1):
            c = min(np.log(1000) - np.log(counts[rest[:k]]) if rest[:k] in counts else np.inf, np.log(1000) + k * np.log(10))
            cost, words = best(rest[k:])
            paths.append((c + cost, [rest[:k], *words]))
        return min(paths)
    assert U.viterbi("casinowin", known, 1000) == best("casinowin")[1] == ["casino", "win"]


# ---------------------------------------------------------------- the pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, sf).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
            kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in docs.collect()} == kept
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id in (%s)" % ",".join(map(str, kept))).collect()]
    assert not any(i in t for t in texts for i in items) and len(set(texts)) == len(texts)


def test_queries_are_registered():
    from riskweave.llm.catalog import QUERIES
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))

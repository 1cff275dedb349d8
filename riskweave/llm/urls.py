"""URL filters: rules first, then words of the host and a naive Bayes score.

Names such as ``casinowin`` are cut into words by the most probable path over a
unigram model (Viterbi); words of host and path vote in a multinomial naive
Bayes model. The model learns from the URLs themselves: those with a listed word
among the words of the host, as the segmentation finds them, are its bad class,
all others the good one, and what goes along with listed words gets its weight
from the counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import settle

LABEL = 4096            # letters looked at together; longer runs, which no name system admits, are cut here
LONGEST = 63            # letters of a word; a host label has no more
BUCKETS = 1 << 16       # hashed words of the model: bounds what executors get
PRIOR_SHARE = 1e-4      # share of all words that a listed word has at least in the unigram model

# fixed values: words of unwanted sites
BAD_WORDS = (
    "adult", "ads", "adserver", "bet", "bets", "betting", "bingo", "casino", "casinos", "cialis", "clickbait", "crack", "escort", "escorts",
    "gambling", "jackpot", "keygen", "lottery", "malware", "payday", "phishing", "pills", "poker", "porn", "porno", "roulette", "sex",
    "slots", "spam", "spyware", "torrent", "torrents", "track", "tracker", "viagra", "warez", "xxx",
)


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both are empty without ``://``."""
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    known = F.coalesce(F.locate("://", F.col(url)) > 0, F.lit(False))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (urls.withColumn("host", F.when(known, F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower())).otherwise(""))
            .withColumn("path", F.when(known, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")))


def rule_of(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host) + len(r.path)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


# ---------------------------------------------------------------- words of a host

def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over the visible words of all texts."""
    visible = F.lower(F.regexp_replace(F.col(text), r"<[^>]*>", " "))
    words = F.explode(F.regexp_extract_all(visible, F.lit(r"(\p{L}+)"), 1))
    return texts.select(words.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segmented(parts: DataFrame, counts: DataFrame, listed: Sequence[str] = BAD_WORDS) -> DataFrame:
    """(part, words): the most probable words of each distinct part.

    Every stretch of a part is looked up by a join, so the unigram model stays
    distributed. Unknown stretches cost more the longer they are.
    """
    spark = parts.sparkSession
    counts = settle(counts, "word-counts")
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    prior = spark.createDataFrame([(w, max(1, int(PRIOR_SHARE * total))) for w in listed], "word string, n long")
    model = counts.unionByName(prior).groupBy("word").agg(F.sum("n").alias("n"))
    size = F.length("part")
    pieces = F.expr(f"""flatten(transform(sequence(1, length(part)), s ->
        transform(sequence(1, least({LONGEST}, length(part) - s + 1)), l -> struct(s - 1 as at, l as size, substring(part, s, l) as word))))""")
    spans = parts.filter(size > 0).select("part", F.explode(pieces).alias("p")).select("part", "p.at", "p.size", "p.word")
    known = spans.join(model, "word").groupBy("part").agg(F.collect_list(F.struct("at", "size", "n")).alias("known"))
    rows = parts.filter(size > 0).join(known, "part", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [viterbi(p, k or (), total) for p, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["part", "words"])

    return rows.select("part", "known").mapInArrow(work, "part string, words array<string>")


def viterbi(part: str, known, total: int) -> list[str]:
    """The words of the most probable path; ties go to the longer first word."""
    cost = {(k["at"], k["size"]): math.log(total) - math.log(k["n"]) for k in known}
    best = [0.0] + [math.inf] * len(part)
    back = [0] * (len(part) + 1)
    for end in range(1, len(part) + 1):
        for size in range(1, min(LONGEST, end) + 1):
            at = end - size
            unknown = math.log(total) + size * math.log(10)
            now = best[at] + min(cost.get((at, size), math.inf), unknown)
            if now <= best[end]:
                best[end], back[end] = now, at
    words, end = [], len(part)
    while end:
        words.append(part[back[end]:end])
        end = back[end]
    return words[::-1]


# ---------------------------------------------------------------- the score

PATH_WORD = re.compile(r"[^\W\d_]+|\d+")


def _bucket(words: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) % BUCKETS for w in words), np.int64, len(words))


def path_words(path: str | None) -> list[str]:
    """Words of a path; all numbers are one word."""
    return ["path:0" if w[0].isdigit() else "path:" + w.lower() for w in PATH_WORD.findall(path or "")]


def url_verdicts(urls: DataFrame, rules: Sequence[Rule], texts: DataFrame, key: str = "page_id", url: str = "url", text: str = "html",
                 listed: Sequence[str] = BAD_WORDS) -> DataFrame:
    """(key, host, path, rule, verdict, score, words) for every row of ``urls``.

    The verdict is the longest fitting rule's, else ``block`` where the score,
    the probability of the bad class, is above one half (one half itself is
    allowed). Listed words count in the segmentation as if they were at least
    ``PRIOR_SHARE`` of all words. The unigram model
    counts the words of all ``texts``. Null urls, and those without ``://``, have
    an empty host and path and are allowed unless a rule says otherwise;
    repeated rows are judged alike; an empty table gives an empty result.
    """
    judged = settle(parsed(urls.select(key, url), url).drop(url), "urls")
    # copies of a host meet map-side: one row each from here on
    hosts = settle(judged.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    label = F.explode(F.expr(
        f"flatten(transform(filter(split(host, '[^\\\\p{{L}}]+'), p -> length(p) > 0), "
        f"p -> transform(sequence(0, cast((length(p) - 1) div {LABEL} as int)), i -> substring(p, i * {LABEL} + 1, {LABEL}))))"))
    labels = settle(hosts.select("host", label.alias("part")), "host-parts")
    words = segmented(labels.select("part").distinct(), word_counts(texts, text), listed)
    named = (labels.join(words, "part").groupBy("host")
             .agg(F.sort_array(F.flatten(F.collect_list("words"))).alias("words")))
    bad = F.arrays_overlap("words", F.array(*[F.lit(w) for w in listed]))
    named = settle(hosts.join(named, "host", "left").select(
        "host", "pages", F.coalesce("words", F.array().cast("array<string>")).alias("words"), F.coalesce(bad, F.lit(False)).alias("bad")), "host-words")

    joined = settle(judged.join(named.select("host", "words", "bad"), "host"), "judged-urls")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        pages = np.zeros(2, np.int64)
        for batch in batches:
            for own, path, bad in zip(*(c.to_pylist() for c in batch.columns)):
                np.add.at(total[int(bad)], _bucket([*own, *path_words(path)]), 1)
                pages[int(bad)] += 1
        for c in (0, 1):
            held = np.flatnonzero(total[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * (len(held) + 1), pa.int32()), pa.array(np.r_[held, -1], pa.int64()), pa.array(np.r_[total[c][held], pages[c]], pa.int64())],
                ["bad", "bucket", "n"])

    counted = joined.select("words", "path", "bad").mapInArrow(count, "bad int, bucket long, n long")
    seen = np.zeros((2, BUCKETS), float)
    pages = np.zeros(2)
    for r in counted.groupBy("bad", "bucket").agg(F.sum("n").alias("n")).collect():     # 2 x BUCKETS at most
        if r["bucket"] < 0:
            pages[r["bad"]] = r["n"]
        else:
            seen[r["bad"], r["bucket"]] = r["n"]
    vocabulary = max(1, int((seen.sum(0) > 0).sum()))
    smooth = np.log(seen + 1) - np.log(seen.sum(1, keepdims=True) + vocabulary)
    odds = (smooth[1] - smooth[0]).astype(np.float32) if pages.min() else np.zeros(BUCKETS, np.float32)
    prior = math.log((pages[1] + 1) / (pages[0] + 1)) if pages.min() else -10.0
    model = urls.sparkSession.sparkContext.broadcast((odds, prior))

    kind = urls.schema[key].dataType.simpleString()
    name, verdict = rule_of(rules)
    ruled = joined.select(key, "host", "path", name.alias("rule"), verdict.alias("given"), "words")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base = model.value
        for batch in batches:
            paths, own = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            logit = np.array([base + weights[_bucket([*w, *path_words(p)])].sum() for w, p in zip(own, paths)], float)
            chance = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            verdicts = [g or ("block" if c > 0.5 else "allow") for g, c in zip(batch.column(4).to_pylist(), chance)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(verdicts, pa.string()), pa.array(chance, pa.float64()), batch.column(5)],
                [key, "host", "path", "rule", "verdict", "score", "words"])

    return ruled.mapInArrow(score, f"`{key}` {kind}, host string, path string, rule string, verdict string, score double, words array<string>")

"""Periodic runs of words found by multi-scale minimizers.

A run is a stretch whose words repeat at the distance of its smallest period,
at least twice, and that no neighbouring word extends. Periods below ``DIRECT``
are found by comparing the text with itself at each such lag. A longer period q
lies in [W, 2W) for one scale W: any stretch of W words of the run comes again
q words later, and so do the least of its K-word hashes, so two equal window
minima at distance q seed the extension to the whole run. K-word grams that
are themselves periodic (period up to K/2) are no minima: two equal minima are
then more than K/2 apart, which bounds the pairs of a position by a constant.
What has none but periodic grams in its first copy lies in two touching runs of
one short period, whose offset gives the possible lags.

A gram is periodic exactly where a run that is already known covers it, as all
shorter periods are found first; so both copies of a stretch agree on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import U64, Interner, mix, raw_texts, slices

DIRECT = 32         # lags below it are compared directly; a power of two, 8 at least
LEAST = 12          # words of a run
BASE = 0x9E3779B97F4A7C15
NONE = U64(0xFFFFFFFFFFFFFFFF)


def _stretches(words: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of ``least`` and more positions x with equal words at x and x + lag."""
    same = np.flatnonzero(words[lag:] == words[:-lag])
    if len(same) < least:
        return same[:0], same[:0]
    cut = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
    keep = last - first + 1 >= least
    return first[keep], last[keep] + 1


def _reach(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch [s, e) around ``at`` whose words come again ``lag`` later; empty if that at ``at`` does not."""
    most = len(words) - lag
    end, step = at, 32
    while end < most:
        upto = min(end + step, most)
        apart = words[end:upto] != words[end + lag:upto + lag]
        hit = int(apart.argmax())
        if apart[hit]:
            end += hit
            break
        end, step = upto, step * 2
    if end == at:
        return at, at
    start, step = at, 32
    while start > 0:
        low = max(0, start - step)
        apart = (words[low:start] != words[low + lag:start + lag])[::-1]
        hit = int(apart.argmax())
        if apart[hit]:
            start -= hit
            break
        start, step = low, step * 2
    return start, end


def _gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row, half the range of 64 bits."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[U64(1), np.full(len(words), BASE, U64)])
        inverse = np.cumprod(np.r_[U64(1), np.full(len(words), pow(BASE, -1, 1 << 64), U64)])
        sums = np.r_[U64(0), np.cumsum(mix(words.view(U64)) * powers[:-1])]
        return mix((sums[size:] - sums[:-size]) * inverse[:len(words) - size + 1]) >> U64(1)


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` of every ``size`` (a power of two) values in a row."""
    step = 1
    while step < size:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def _window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Positions that hold the minimum of some window of ``size`` values; equal minima all count."""
    low = _sliding(values, size, np.minimum)
    edge = np.zeros(size - 1, U64)
    return np.flatnonzero((_sliding(np.concatenate([edge, low, edge]), size, np.maximum) == values) & (values != NONE))


def _seeds(values: np.ndarray, owner: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of equal window minima of one text at a distance in [scale, 2 scale)."""
    at = _window_minima(values, scale // 2)
    at = at[np.argsort(values[at], kind="stable")]
    value, text = values[at], owner[at]
    places, lags = [at[:0]], [at[:0]]
    for step in range(1, len(at)):
        lag = at[step:] - at[:-step]
        live = (value[step:] == value[:-step]) & (text[step:] == text[:-step]) & (lag < 2 * scale)
        if not live.any():
            break
        live &= lag >= scale
        places.append(at[:-step][live])
        lags.append(lag[live])
    return np.concatenate(places), np.concatenate(lags)


class _Found:
    """Runs found so far: the smallest period of each stretch."""

    def __init__(self) -> None:
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.period[start, end] = min(period, self.period.get((start, end), period))

    def up_to(self, period: int) -> list[tuple[int, int, int]]:
        return sorted((p, s, e) for (s, e), p in self.period.items() if p <= period)


def _touching(words: np.ndarray, known: list[tuple[int, int, int]], scale: int) -> Iterator[tuple[int, int]]:
    """(position, lag) seeds with a lag in [scale, 2 scale) between two runs of one period that touch or overlap."""
    for (p, b1, e1), (p2, b2, e2) in zip(known, known[1:]):
        most = min(2 * scale - 1, e1 - b1, e2 - b2, (e2 - b1) // 2)
        if p != p2 or b2 > e1 or most < scale:
            continue
        last = words[e1 - p:e1]
        for y in range(b2, b2 + p):
            if words[y] == last[0] and (words[y:y + p] == last).all():
                residue = (y - (e1 - p)) % p
                for lag in range(scale + (residue - scale) % p, most + 1, p):
                    yield max(b1, b2 - lag), lag
                break


def find_runs(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, direct: int = DIRECT, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of all runs, sorted; places count from the first text.

    ``words`` holds the word numbers (zero and above) of several texts, each
    followed by a negative number of its own; ``starts`` and ``counts`` say
    where each text begins and how many words it has.
    """
    found = _Found()
    longest = int(counts.max(initial=0))
    first_gram = direct // 4
    for lag in range(1, min(direct, longest // 2 + 1)):
        # stretches below ``least`` words are held for the gram test of the first scales
        for s, e in zip(*(x.tolist() for x in _stretches(words, lag, max(lag, min(least, first_gram) - lag)))):
            found.add(s, e + lag, lag)
    owner = np.repeat(np.arange(len(counts)), counts + 1)
    scale = direct
    while 2 * scale <= longest:
        gram = scale // 4
        known = found.up_to(gram // 2)
        inside = np.zeros(len(words) + 1, np.int64)
        for _, s, e in known:
            if e - s >= gram:
                inside[s] += 1
                inside[e - gram + 1] -= 1
        place = np.flatnonzero((counts >= 2 * scale)[owner])
        part = words[place]
        values = np.full(len(part), NONE, U64)
        values[:len(part) - gram + 1] = _gram_hashes(part, gram)
        values[place + gram > (starts + counts)[owner[place]]] = NONE       # beyond the end of its text
        values[np.cumsum(inside)[:-1][place] > 0] = NONE
        at, lag = _seeds(values, owner[place], scale)
        at = place[at]
        order = np.lexsort((at, lag))
        seeds = chain(zip(at[order].tolist(), lag[order].tolist()), _touching(words, known, scale))
        done, upto = 0, 0
        for m, q in seeds:
            if q == done and m < upto:
                continue
            s, e = _reach(words, m, q)
            done, upto = q, e
            if e - s >= q:
                found.add(s, e + q, q)
        scale *= 2
    rows = sorted((s, p, e) for (s, e), p in found.period.items() if e - s >= least)
    return np.array([(s, e, p) for s, p, e in rows], np.int64).reshape(-1, 3)


# ---------------------------------------------------------------- on Spark

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", direct: int = DIRECT, least: int = LEAST) -> DataFrame:
    """(key, runs array<struct<start, length, period>>, collapsed) for every row.

    Words are what ASCII white space parts, numbered from 0. ``runs`` holds every
    run of ``least`` words and more, by start, then period. ``collapsed`` is the
    text's words, one space between them, without those that a run contains
    after its first ``period`` words. Null and empty texts have no run and an
    empty collapsed text; repeated rows and null keys are rows like others; an
    empty table gives none. Only the named columns are read. A task holds a
    slice of texts at a time, or one text if that is longer.
    """
    if direct < 8 or direct & (direct - 1):
        raise ValueError("direct must be a power of two, 8 at least")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Interner(lambda w: len(number))
        for batch in slices(batches, 128):
            split = [t.split() if t else [] for t in raw_texts(batch.column(1))]
            counts = np.array([len(w) for w in split], np.int64)
            ends = np.cumsum(counts + 1)
            starts = ends - counts - 1
            words = np.empty(int(ends[-1]), np.int64)
            words[ends - 1] = -1 - np.arange(len(split))
            held = np.ones(len(words), bool)
            held[ends - 1] = False
            words[held] = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
            number.trim()
            runs = find_runs(words, starts, counts, direct, least)
            kept = np.ones(len(words), bool)
            for s, e, p in runs.tolist():
                kept[s + p:e] = False
            of = np.searchsorted(ends, runs[:, 0], "right")
            mine = np.bincount(of, minlength=len(split))
            short = np.add.reduceat(~kept, starts) > 0
            text_of = [b" ".join(w if not cut else [x for x, k in zip(w, kept[s:s + len(w)].tolist()) if k])
                       for w, s, cut in zip(split, starts.tolist(), short.tolist())]
            rows = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - starts[of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(np.r_[0, np.cumsum(mine)].astype(np.int32), rows),
                 pa.array(text_of, pa.binary()).cast(pa.string())], [key, "runs", "collapsed"])

    return docs.select(key, text).mapInArrow(work, f"`{key}` {docs.schema[key].dataType.simpleString()}, runs array<{RUN}>, collapsed string")


def run_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one, and checksums of the runs and of the collapsed text."""
    better = "r.length > b.length OR (r.length = b.length AND (r.start < b.start OR (r.start = b.start AND r.period < b.period)))"
    best = F.expr(f"aggregate(runs, cast(null as {RUN}), (b, r) -> if(b is null OR {better}, r, b))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("__best", best).select(
        key, F.size("runs").cast("long").alias("n_runs"), "__best.start", "__best.length", "__best.period",
        F.expr("(1000 * __best.length) div __best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_repeated_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text``; every tenth key's text (by checksum) repeats words from some place on.

    With h the CRC32 of the key as text and g = h div 10, a text of n words with
    h % 10 = 0 gets at each place i >= a = g % n the word of a + (i - a) % p, where
    p = 1 + (n - a) div (3 + g % 8). Null keys' texts stay.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit("([^\\x20\\x09-\\x0D]+)"), 1)
    # only what changes is cut into words
    changed = docs.select(F.col(key), F.col(text), h.alias("__h")).withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
    made = """transform(sequence(0, size(__w) - 1), i -> element_at(__w, cast(1 + if(i < __a, i, __a + (i - __a) % __p) as int)))"""
    return (changed.withColumn("__g", F.expr("__h div 10")).withColumn("__n", F.size("__w"))
            .withColumn("__a", F.expr("if(__n > 0, __g % __n, 0)")).withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
            .select(key, F.when(F.col("__w").isNotNull() & (F.col("__n") > 0), F.array_join(F.expr(made), " ")).otherwise(F.col(text)).alias(text)))

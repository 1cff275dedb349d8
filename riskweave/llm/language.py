"""Language identification by hyperdimensional profiles.

Every character has a random vector of signs that follows from its code point.
An n-gram binds the permuted vectors of its characters (a product of the first
shifted twice, the second shifted once and the third as it is); a text bundles,
that is adds, its n-grams, and so does a language over its texts. Documents go
to the language whose prototype has the largest cosine, after the mean of the
prototypes, what all languages share, is taken off both. Whether a document is
in any language at all is read from how much of its bundle lies in the space of
the prototypes, against the labelled documents with as many n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import U64, mix, slices

WIDTH = 512             # dimensions of a vector
UNKNOWN = "und"
SPACE = 32
GRAMS_KEPT = 40_000     # n-gram vectors that a worker keeps
GRAMS_HELD = 400_000    # n-gram counts that a task holds before it adds them up
LEAST = 1 / 9           # of the share that labelled documents show, a third of their cosine
JUDGED = 5              # grade, that is 32 n-grams, from which documents in a language stand out from chance
NOISE = 2.0             # deviations of the share of chance that a bar has to reach
ENOUGH = 30             # labelled documents of a language and grade that set a bar


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Codes of the letter trigrams of a text, words parted by one space; none without letters."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    points = np.where(letter, points, SPACE)
    points = points[letter | np.r_[True, letter[:-1]]]       # one space for a run of others
    points = np.concatenate([[SPACE], points, [SPACE]]).astype(np.int64)
    return points[:-2] << 42 | points[1:-1] << 21 | points[2:]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """Signs of WIDTH dimensions for each code point."""
    words = mix(points.astype(U64)[:, None] * U64(0x9E3779B97F4A7C15) + np.arange(1, WIDTH // 64 + 1, dtype=U64) * U64(0xD1B54A32D192ED03))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1)


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of trigram codes."""
    parts = [codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF]
    out = None
    for shift, part in zip((2, 1, 0), parts):
        points, at = np.unique(part, return_inverse=True)
        vectors = np.roll(letter_vectors(points), shift, axis=1)[at]
        out = vectors if out is None else out * vectors
    return out


def bundle(codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sum of the n-gram vectors of a text or a language."""
    return times.astype(np.float32) @ gram_vectors(codes).astype(np.float32)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One count per code out of several tables."""
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def _counted(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    for l, parts in held.items():
        codes, n = _added(parts)
        yield pa.RecordBatch.from_arrays([pa.array([l] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "gram", "n"])


def language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language, from all rows with a text and a language.

    Tasks count n-grams per language, which Spark adds up; each partition of
    the counts bundles its share, so what reaches the driver is one vector per
    language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for batch in slices(batches):
            by: dict[str, list[np.ndarray]] = {}
            for t, l in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(l, []).append(grams(t))
            for l, parts in by.items():
                found = np.unique(np.concatenate(parts), return_counts=True)
                held.setdefault(l, []).append(found)
                size += len(found[0])
            if size > GRAMS_HELD:
                held = {l: [_added(p)] for l, p in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > GRAMS_HELD // 2:
                    yield from _counted(held)
                    held, size = {}, 0
        yield from _counted(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, 4096):
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            codes, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            vectors = gram_vectors(codes).astype(np.float64)
            for l in set(langs):
                own = langs == l
                sums[l] = sums.get(l, 0.0) + n[own].astype(float) @ vectors[own]
        for l, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([l] * WIDTH, pa.string()), pa.array(np.arange(WIDTH, dtype=np.int32)), pa.array(v)], ["lang", "place", "value"])

    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"))
    counts = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = counts.mapInArrow(add, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():   # languages x WIDTH
        out.setdefault(r["lang"], np.zeros(WIDTH))[r["place"]] = r["value"]
    return {l: v / max(np.linalg.norm(v), 1e-9) for l, v in sorted(out.items())}


class Detector:
    """Compares texts with prototypes; keeps the vectors of frequent n-grams."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.langs = list(profiles)
        self.shared = np.mean(list(profiles.values()), axis=0) if profiles else np.zeros(WIDTH)
        own = np.array([profiles[l] for l in self.langs]).reshape(-1, WIDTH)
        if len(self.langs) > 1:
            own = own - self.shared
        self.own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
        self.space = np.empty((0, WIDTH))
        if profiles:
            _, size, axes = np.linalg.svd(np.array(list(profiles.values())), full_matrices=False)
            self.space = axes[size > 1e-6 * size[0]]
        self.chance = len(self.space) / WIDTH   # share of a bundle of unrelated n-grams
        rest = WIDTH - len(self.space)
        self.noise = float(np.sqrt(2 * len(self.space) / (rest * (WIDTH + 2)))) if rest else np.inf
        self._at: dict[int, int] = {}
        self._vectors = np.empty((0, WIDTH), np.float32)

    def _lookup(self, codes: np.ndarray) -> np.ndarray:
        known = self._at
        fresh = [c for c in codes.tolist() if c not in known]
        if fresh:
            if len(known) + len(fresh) > GRAMS_KEPT:
                known.clear()
                self._vectors = np.empty((0, WIDTH), np.float32)
                fresh = codes.tolist()
            for i, c in enumerate(fresh, len(known)):
                known[c] = i
            made = gram_vectors(np.array(fresh, np.int64)).astype(np.float32)
            self._vectors = np.concatenate([self._vectors, made])
        return np.fromiter(map(known.__getitem__, codes.tolist()), np.int64, len(codes))

    def detect(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.examine(texts)[:2]

    def examine(self, texts: list[str | None]) -> tuple[list[str], list[float], list[int], list[float]]:
        """For each text the nearest language and its cosine, the grade and the share.

        The grade is the base-2 logarithm of how many n-grams a text has, where
        repeated ones count less: the square of their sum by the sum of their
        squares, which is what the cosine grows with. The share is that part of
        the squared bundle that all prototypes together explain, less what they
        explain of unrelated n-grams: 1 at most, 0 by chance.
        """
        found = [np.unique(grams(t), return_counts=True) for t in texts]
        every = np.unique(np.concatenate([c for c, _ in found])) if found else np.empty(0, np.int64)
        if len(every) <= GRAMS_KEPT:
            row = self._lookup(every)
            vectors = self._vectors
        langs, scores, grades, shares = [], [], [], []
        for codes, times in found:
            if not len(codes) or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                grades.append(0)
                shares.append(0.0)
                continue
            if len(every) <= GRAMS_KEPT:
                whole = times.astype(np.float32) @ vectors[row[np.searchsorted(every, codes)]]
            else:   # a text or batch with very many n-grams
                whole = sum(bundle(codes[i:i + 4096], times[i:i + 4096]) for i in range(0, len(codes), 4096))
            whole = whole / max(np.linalg.norm(whole), 1e-9)
            weight = times.astype(float)
            grades.append(int(np.log2(weight.sum() ** 2 / (weight @ weight))))
            shares.append(float(((self.space @ whole) ** 2).sum() - self.chance) / max(1 - self.chance, 1e-9))
            if len(self.langs) > 1:
                whole = whole - self.shared
            near = self.own @ whole / max(np.linalg.norm(whole), 1e-9)
            best = int(near.argmax())
            langs.append(self.langs[best])
            scores.append(float(min(1.0, max(0.0, near[best]))))
        return langs, scores, grades, shares


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs``' own columns but the text, with ``lang_pred`` and ``score`` (the cosine, 0 to 1).

    Null texts and texts without a letter are ``und`` with score 0; so is all
    when no language was learned. Repeated rows are scored alike.
    """
    rest = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(shared.value)
        for batch in slices(batches):
            langs, scores = detector.detect(batch.column(len(rest)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*rest, "lang_pred", "score"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in rest) + "lang_pred string, score double"
    return docs.select(*rest, text).mapInArrow(work, schema)


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, fold: int = 2) -> DataFrame:
    """(key, held_out, lang_pred, score) for every row; learned outside the held-out fold.

    Null keys are held out; rows with a null language or text teach nothing.
    """
    aside = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(True))
    profiles = language_profiles(docs.filter(~aside), text, lang)
    return identify(docs.select(key, aside.alias("held_out"), text), profiles, text)


def language_bars(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", lang: str = "lang", least: float = LEAST) -> dict[str, dict[int, float]]:
    """For each language and grade, ``least`` of the lower quartile of the shares of all its labelled rows.

    The quartile holds while less than a quarter of them are junk. Grades below
    ``JUDGED`` or with under ``ENOUGH`` rows have no bar, nor has one that chance
    reaches: a language of many rare n-grams leaves little in its prototype.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(shared.value)
        for batch in slices(batches):
            _, _, grades, shares = detector.examine(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(grades, pa.int32()), pa.array(shares, pa.float64())], ["lang", "grade", "share"])

    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"))
    measured = known.mapInArrow(measure, "lang string, grade int, share double").filter(F.col("grade") >= JUDGED)
    quartiles = measured.groupBy("lang", "grade").agg(   # of thousandths, so that a group holds few values
        F.percentile(F.round("share", 3), F.lit(0.25)).alias("share"), F.count("*").alias("n"))
    reached = NOISE * Detector(profiles).noise
    out: dict[str, dict[int, float]] = {}
    for r in quartiles.collect():   # languages x grades
        if r["n"] >= ENOUGH and least * r["share"] > reached:
            out.setdefault(r["lang"], {})[r["grade"]] = least * r["share"]
    return out


def language_filter(docs: DataFrame, text: str = "text", lang: str = "lang", least: float = LEAST) -> DataFrame:
    """``docs`` without rows of no language; all columns as they came.

    A row goes if its text is null or has no letter, if no prototype is on its
    side (no cosine above 0), or if its share is not above the bar of its
    language (its label, without one the nearest) in its grade or any below, as
    more n-grams show a language better. So letter junk, encoded runs and texts
    in languages nobody has labelled go. Texts under 32 n-grams and those of
    languages without a bar are not judged by it, so unlabelled junk stays if it
    is nearest to such a language. Prototypes and bars come from all rows with a
    language; without any, rows with a letter stay.
    """
    profiles = language_profiles(docs, text, lang)
    bars = language_bars(docs, profiles, text, lang, least) if profiles else {}
    shared = docs.sparkSession.sparkContext.broadcast((profiles, bars))
    at = docs.columns.index(text)
    label = docs.columns.index(lang)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, bars = shared.value
        detector = Detector(profiles)

        def stays(own: str | None, nearest: str, score: float, grade: int, share: float) -> bool:
            bar = max((b for g, b in bars.get(nearest if own is None else own, {}).items() if g <= grade), default=-np.inf)
            return nearest != UNKNOWN and score > 0 and share > bar

        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            if detector.langs:
                own = batch.column(label).cast(pa.string()).to_pylist()
                keep = [stays(*x) for x in zip(own, *detector.examine(texts))]
            else:
                keep = [len(grams(t)) > 0 for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)

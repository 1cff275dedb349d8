"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so a question with other
values keeps its template. A capitalised word is taken for a name wherever it stands,
at the start of a sentence as well: whatever begins sentences may then be
replaced, as long as it is replaced alike. Windows of canonical tokens are
hashed, joined with the windows of the benchmark, and lined up; what the
placeholders stood for must be replaced consistently along an alignment, or the
match is by chance. An item of nothing but placeholders is met word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import U64, Interner, mix, raw_texts, slices, word_hash
from riskweave.session import settle

WINDOW = 6              # canonical tokens
LITERALS = 0.5          # least share of a window's tokens that are not placeholders
SHARE = 0.4             # of an item's windows that a leak covers
CONSISTENT = 0.9        # of the value pairs of an alignment
MOST_BITS = 27          # of the filter: 16 MB at most

# fixed values: unit words that follow a number
UNITS = frozenset(
    "mm cm m km inch inches ft feet foot yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs pound pounds "
    "ounce ounces oz ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days "
    "week weeks month months year years percent dollar dollars cent cents euro euros mph km/h degree degrees meter meters "
    "metre metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre centimetres".split())

UNIT_BYTES = frozenset(u.encode() for u in UNITS)
NUMBER, NAME, UNIT = (np.uint64(word_hash(x)) for x in (b"<number>", b"<name>", b"<unit>"))
EDGE = " \t\"'`()[]{}<>.,;:!?|*#&$%_-…“”‘’«»"


class Canon:
    """Canonical tokens of texts; remembers chunks within a bound."""

    def __init__(self, limit: int = 200_000):
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.at = Interner(self._add)
        self.rows: list[tuple] = []
        self.table: tuple | None = None

    def _row(self, chunk: bytes) -> tuple:
        """(hash of the word, is a word, number, name, unit)"""
        word = chunk if chunk.isalpha() else chunk[:-1] if chunk[-1:] in (b".", b",") and chunk[:-1].isalpha() else None
        if word is not None:        # ASCII letters, perhaps with a mark behind them
            low = word.lower()
            name = len(word) > 1 and word[:1].isupper() and not word.isupper()
            return word_hash(low), True, False, name, low in UNIT_BYTES
        raw = chunk.decode("utf-8", "replace")
        word = raw.strip(EDGE)
        low = word.lower()
        number = any(c.isdigit() for c in word) and not any(c.isalpha() for c in word.rstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ%°"))
        name = not number and len(word) > 1 and word[0].isupper() and any(c.islower() for c in word[1:])
        return word_hash(low.encode()), bool(word), number, name, low in UNITS

    def _add(self, chunk: bytes) -> int:
        self.rows.append(self._row(chunk))
        return len(self.rows) - 1

    def tokens(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Canonical hashes, hashes of what was there, and which are placeholders."""
        return next(self.each([text]))

    def each(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``tokens`` of several texts; new chunks join the table once for all of them."""
        if len(self.at) > self.limit:
            self._reset()
        chunks = [t.split() if t else [] for t in texts]
        found = [np.fromiter(map(self.at.__getitem__, c), np.int64, len(c)) for c in chunks]
        if self.table is None or len(self.table[0]) < len(self.rows):
            fresh = list(zip(*self.rows[0 if self.table is None else len(self.table[0]):]))
            fresh = (np.array(fresh[0], U64), *(np.array(c, bool) for c in fresh[1:])) if fresh else (np.empty(0, U64), *[np.empty(0, bool)] * 4)
            self.table = fresh if self.table is None else tuple(np.concatenate(p) for p in zip(self.table, fresh))
        return map(self._canonical, found)

    def _canonical(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value, real, number, name, unit = (c[which] for c in self.table)
        value, number, name, unit = (c[real] for c in (value, number, name, unit))
        unit = unit & np.r_[False, number[:-1]] if len(value) else unit
        # a run of names is one slot
        keep = ~(name & np.r_[False, name[:-1]]) if len(value) else np.empty(0, bool)
        start = np.flatnonzero(keep)
        if len(start):
            whole = np.add.reduceat(mix(value), start)
            value = np.where(name[start], whole, value[start])
            number, name, unit = number[start], name[start], unit[start]
        canon = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, value)))
        return canon, value, number | name | unit


def window_hashes(canon: np.ndarray, size: int) -> np.ndarray:
    count = max(0, len(canon) - size + 1)
    out = np.full(count, size, U64)
    for i in range(size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + canon[i:i + count])
    return out


def _windows(table: DataFrame, key: str, text: str, sizes, bits: int, bitmap, verbatim: bool = True) -> DataFrame:
    """(key, __text, size, pos, hash, values, of, verbatim) of the windows that pass the filter.

    ``sizes`` None: an item's own size, the window or the whole shorter item; an
    item whose windows are all made mostly of placeholders gives the hashes of
    its very words. ``verbatim``: whether a document's windows of this kind do.
    """
    kind = table.schema[key].dataType.simpleString()
    own = table.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text"), F.col(text))
    mark = table.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canon()
        for batch in slices(batches):
            cols: list[list] = [[] for _ in range(7)]
            for i, (tokens, values, slot) in enumerate(canon.each(raw_texts(batch.column(2)))):
                for size in sizes if sizes is not None else ([min(WINDOW, len(tokens))] if len(tokens) else []):
                    hashes = window_hashes(tokens, size)
                    if not len(hashes):
                        continue
                    literal = size - (lambda c: c[size:] - c[:-size])(np.r_[0, np.cumsum(slot)])
                    good = literal >= LITERALS * size
                    exact = np.zeros(len(good), bool)
                    if not good.all() and (not good.any() if sizes is None else verbatim):
                        exact = ~good
                        hashes = np.where(good, hashes, mix(window_hashes(values, size)))
                        good = np.ones(len(good), bool)
                    if mark is not None:
                        place = (hashes >> U64(64 - bits)).astype(np.int64)
                        good &= (mark.value[place >> 3] >> (place & 7) & 1).astype(bool)
                    total = int(good.sum())
                    for p in np.flatnonzero(good).tolist():
                        held = np.flatnonzero(slot[p:p + size]) + p
                        for c, v in zip(cols, (i, size, p, int(hashes[p].astype(np.int64)), values[held].view(np.int64).tolist(), total, bool(exact[p]))):
                            c.append(v)
            if cols[0]:
                row = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.bool_())],
                    [key, "__text", "size", "pos", "hash", "values", "of", "verbatim"])

    return own.mapInArrow(work, f"`{key}` {kind}, __text long, size int, pos long, hash long, values array<long>, of long, verbatim boolean")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
          share: float = SHARE) -> DataFrame:
    """(key, __text, item, windows, item_windows, share, values_changed): items that a document holds.

    ``share`` is the part of the item's windows found in consistent alignments.
    An item below the window's length is one window; windows made mostly of
    placeholders are left out, but an item of none but such is met word for word. Null
    and empty texts have no window, empty tables no leak; documents are told
    apart by key and text, so repeated rows count once and null keys are kept.
    """
    items = settle(_windows(benchmark, item, text, None, 0, None).drop("__text"), "item-windows")
    total = items.count()
    bits = max(16, min(MOST_BITS, (64 * max(total, 1)).bit_length()))
    place = F.shiftrightunsigned("hash", 64 - bits)
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    marked = np.array([r[0] for r in items.select(place.alias("p")).distinct().toLocalIterator()], np.int64)
    np.bitwise_or.at(bitmap, marked >> 3, (1 << (marked & 7)).astype(np.uint8))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())     # WINDOW sizes at most

    exact = not items.filter("verbatim").isEmpty()
    found = _windows(docs, key, text, sizes, bits, bitmap, exact).drop("of", "verbatim")
    asked = items.select(F.col(item).alias("__item"), "size", "hash", F.col("pos").alias("__at"), F.col("values").alias("__asked"), "of")
    met = found.join(asked, ["size", "hash"]).withColumn("__line", F.col("pos") - F.col("__at"))
    pairs = F.flatten(F.collect_set(F.arrays_zip(F.col("__asked").alias("a"), F.col("values").alias("b"))))
    lines = met.groupBy(F.col(key), "__text", "__item", "__line").agg(
        F.collect_set("__at").alias("at"), F.array_distinct(pairs).alias("pairs"), F.max("of").alias("of"))
    lines = (lines.withColumn("asked", F.size(F.array_distinct(F.col("pairs.a"))))
             .filter(F.col("asked") >= CONSISTENT * F.size("pairs"))
             .withColumn("changed", F.size(F.filter("pairs", lambda p: p["a"] != p["b"])))
             .filter(F.size("at") >= F.least(F.lit(2), F.col("of"))))
    out = (lines.withColumn("p", F.explode("at")).groupBy(F.col(key), "__text", "__item")
           .agg(F.countDistinct("p").alias("windows"), F.max("of").alias("item_windows"), F.max("changed").alias("values_changed")))
    out = out.withColumn("share", F.col("windows") / F.col("item_windows")).filter(F.col("share") >= share)
    return out.select(key, "__text", F.col("__item").alias(item), "windows", "item_windows", "share", "values_changed")


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns as they came."""
    gone = leaks(docs, benchmark, key, item, text).select(F.col(key).alias("__key"), F.col("__text").alias("__gone")).distinct()
    own = docs.withColumn("__text", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return own.join(gone, own[key].eqNullSafe(F.col("__key")) & (own["__text"] == F.col("__gone")), "left_anti").select(*docs.columns)

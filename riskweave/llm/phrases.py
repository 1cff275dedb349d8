"""Word collocations by partitioned mining (SON).

The corpus is cut into a few shards, sets of input partitions. Each shard is
mined completely: every phrase whose count in the shard reaches the support
lowered in proportion to the shard's words is a candidate, and a phrase with
enough occurrences in all must be one in some shard. The union of the
candidates becomes a bit filter of bounded size, behind which all of them are
counted exactly by their words; what passes the filter by chance falls to its
exact count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import U64, Interner, mix, raw_texts, slices, word_hash
from riskweave.operators.rank import top_per_group
from riskweave.session import settle

SHARDS = 4              # the local support is a fourth of the support, so most phrases of a shard fall
READ = 2 << 20          # bytes of text cut into words at once
HELD = 1 << 22          # phrases of a task that are counted together
ENTRIES = 1 << 22       # distinct phrases of all tasks that one reducing task takes, about
FILTER_BITS = 27        # of the candidate filter: 16 MB
WORDS = 300_000         # distinct words after which a task counts what it holds and forgets them
NUMBER = (1 << 21) - 1  # three word numbers fit 63 bits
MARK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)


class _Words:
    """Numbers of words; number 0 parts pieces."""

    def __init__(self) -> None:
        self.number = Interner(self._add)
        self.forget()

    def forget(self) -> None:
        self.number.clear()
        self.word, self.hashed = [b"."], [0]
        self.number[b"."] = 0

    def full(self) -> bool:
        return len(self.word) > WORDS

    def _add(self, word: bytes) -> int:
        self.word.append(word)
        self.hashed.append(word_hash(word))
        return len(self.word) - 1

    def read(self, texts: list[bytes]) -> np.ndarray:
        """Numbers of all words of ``texts``, pieces parted by zeros."""
        # a full stop is a mark, so it is no word and can stand for the end of a piece
        words = b" . ".join(texts).lower().translate(MARKS).replace(b".", b" . ").split()
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at marks, where pieces end anyway."""
    at = 0
    while len(text) - at > READ:
        mark = MARK.search(text, at + READ)
        if mark is None:
            break
        yield text[at:mark.start()]
        at = mark.end()
    yield text[at:] if at else text


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, about ``READ`` bytes of them at a time."""
    texts: dict[str, list[bytes]] = {}
    size = 0
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
            for part in _parts(text or b""):
                texts.setdefault(lang, []).append(part)
                size += len(part)
                if size >= READ:
                    yield texts
                    texts, size = {}, 0
    if texts:
        yield texts


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Places where ``size`` words of one piece begin."""
    inside = words != 0
    whole = inside[:len(words) - size + 1].copy()
    for i in range(1, size):
        whole &= inside[i:len(words) - size + 1 + i]
    return np.flatnonzero(whole)


def _hashes(hashed: np.ndarray, size: int, lang: str) -> np.ndarray:
    """64-bit hashes of phrases (rows of word hashes) of a language."""
    out = np.full(len(hashed), U64(word_hash(lang.encode())) + U64(size))
    for i in range(size):
        out = mix(out * U64(0x9E3779B97F4A7C15) + hashed[:, i])
    return out


def _taken(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    return np.stack([words[at + i] for i in range(size)], axis=1)


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of all parts and how often each occurs; empties the list."""
    values = np.concatenate(parts)
    parts.clear()
    values.sort()
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def _spelled(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def shard_counts(table: DataFrame, shards: int, bits: int, longest: int) -> DataFrame:
    """(shard, lang, bucket, hashes, counts, words): what the tasks of each shard counted.

    A bucket is the first ``bits`` bits of a phrase's hash; ``hashes`` holds the 32
    bits after them and ``counts`` one byte each, 255 for more. Bucket -1 has the
    number of words. Phrases with equal bits count as one, which can only make
    more candidates.
    """
    def counted(found: dict[str, list[np.ndarray]]) -> Iterator[tuple]:
        for lang, parts in found.items():
            short, counts = _counted(parts)
            bucket = (short >> U64(32)).astype(np.int32)
            low, counts = short.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
            edge = np.flatnonzero(np.diff(bucket)) + 1
            for a, b in zip(np.r_[0, edge].tolist(), np.r_[edge, len(bucket)].tolist()):
                if b > a:
                    yield lang, int(bucket[a]), low[a:b].tobytes(), counts[a:b].tobytes(), 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        reader, found, size, words = _Words(), {}, 0, {}

        def rows(made: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            columns = list(zip(*made))
            if columns:
                kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(columns[0]), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["shard", "lang", "bucket", "hashes", "counts", "words"])

        for texts in _read(batches):
            for lang, own in texts.items():
                numbers = reader.read(own)
                hashed = np.array(reader.hashed, U64)
                words[lang] = words.get(lang, 0) + int(np.count_nonzero(numbers))
                for n in range(2, longest + 1):
                    made = _hashes(hashed[_taken(numbers, n, _grams(numbers, n))], n, lang) >> U64(32 - bits)
                    found.setdefault(lang, []).append(made)
                    size += len(made)
            if reader.full():
                reader.forget()
            if size >= HELD:
                yield from rows(counted(found))
                found, size = {}, 0
        yield from rows(counted(found))
        yield from rows((lang, -1, b"", b"", n) for lang, n in words.items())

    return table.mapInArrow(work, "shard int, lang string, bucket int, hashes binary, counts binary, words long")


def candidate_filter(counted: DataFrame, support: int, bits: int) -> np.ndarray:
    """Bits that are set for every phrase that is frequent in some shard; of ``FILTER_BITS`` whatever the corpus.

    A phrase of a shard is frequent if its share of the shard's words in its
    language is at least the support's share of all such words.
    """
    own = counted.filter("bucket < 0 AND words > 0").groupBy("lang", "shard").agg(F.sum("words").alias("own"))
    every = own.groupBy("lang").agg(F.sum("own").alias("every"))
    # the least whole count f with f * every >= support * own
    least = own.join(every, "lang").select("lang", "shard", F.expr(
        f"greatest(1, (cast({support} as decimal(20,0)) * own + every - 1) div every)").cast("int").alias("least"))
    least = settle(least, "local-support")
    width = FILTER_BITS - bits      # bits of the filter that belong to a bucket

    def mine(group: pa.Table) -> pa.Table:
        frequent = np.zeros(1 << width, bool)
        group = group.sort_by([("lang", "ascending"), ("shard", "ascending")])
        lang, shard = group["lang"].to_pylist(), group["shard"].to_pylist()
        starts = [i for i in range(len(lang)) if i == 0 or (lang[i], shard[i]) != (lang[i - 1], shard[i - 1])]
        low, times, support = group["hashes"].to_pylist(), group["counts"].to_pylist(), group["least"].to_pylist()
        for a, b in zip(starts, [*starts[1:], len(lang)]):
            keys = np.frombuffer(b"".join(low[a:b]), np.uint32)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], np.frombuffer(b"".join(times[a:b]), np.uint8)[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            # 255 stands for 255 or more, far above any local support it is compared with
            often = np.add.reduceat(counts.astype(np.int64), first) >= min(support[a], 255)
            frequent[keys[first[often]] >> np.uint32(32 - width)] = True
        return pa.table({"bucket": group["bucket"][:1], "bits": pa.array([np.packbits(frequent).tobytes()], pa.binary())})

    joined = counted.filter("bucket >= 0").drop("words").join(least, ["lang", "shard"])
    mined = joined.groupBy("bucket").applyInArrow(mine, "bucket int, bits binary")
    marked = np.zeros((1 << bits, 1 << max(0, width - 3)), np.uint8)
    for r in mined.toLocalIterator():       # 16 MB in all
        marked[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return marked.reshape(-1)


def exact_counts(table: DataFrame, marked: np.ndarray, longest: int) -> DataFrame:
    """(lang, phrase, size, f): exact counts of all words and of all phrases that pass the filter."""
    shared = table.sparkSession.sparkContext.broadcast(marked)

    def spelled(reader: _Words, lang: str, size: int, key: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(key), 50_000):
            part = key[a:a + 50_000]
            words = ([reader.word[n] for n in (part >> 21 * (size - 1 - i) & NUMBER).tolist()] for i in range(size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array([b" ".join(p) for p in zip(*words)], pa.binary()).cast(pa.string()),
                 pa.array([size] * len(part), pa.int32()), pa.array(f[a:a + 50_000].astype(np.int64))], ["lang", "phrase", "size", "f"])

    def counted(reader: _Words, found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, size), parts in found.items():
            key, f = _counted(parts)
            yield from spelled(reader, lang, size, key, f)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, passes = _Words(), shared.value
        found, held = {}, 0
        for texts in _read(batches):
            for lang, own in texts.items():
                numbers = reader.read(own)
                hashed = np.array(reader.hashed, U64)
                for size in range(1, longest + 1):
                    at = _grams(numbers, size)
                    if size > 1:
                        bit = _hashes(hashed[_taken(numbers, size, at)], size, lang) >> U64(64 - FILTER_BITS)
                        at = at[(passes[(bit >> U64(3)).astype(np.int64)] >> (7 - (bit & U64(7)).astype(np.uint8)) & 1).astype(bool)]
                    key = numbers[at]
                    for i in range(1, size):
                        key = key << 21 | numbers[at + i]
                    found.setdefault((lang, size), []).append(key)
                    held += len(key)
            if held >= HELD or reader.full():
                yield from counted(reader, found)
                found, held = {}, 0
                if reader.full():
                    reader.forget()
        yield from counted(reader, found)

    found = table.mapInArrow(work, "lang string, phrase string, size int, f long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = 10, longest: int = 3, absorb: int = 50,
                 shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that stand for themselves.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
    those into words at spaces and tabs. A candidate is a phrase of 2 to
    ``longest`` (3 at most) words with ``a`` >= ``support`` occurrences in its language;
    overlapping ones count. Of its cuts the one with the lowest
    floor(1000000 * a * a / (l * r)) counts, the first of equal ones; l and r are the
    occurrences of the parts. A candidate inside a longer one with at least
    ``absorb`` per cent of its occurrences is dropped. A null language is ``und``;
    null and empty texts hold nothing; repeated rows count each time; an empty
    table gives none. Only the named columns are read.
    """
    if not 2 <= longest <= 3:
        raise ValueError("phrases have 2 or 3 words at most")
    table = _spelled(docs, lang, text)
    size = table.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # two phrases begin at each word, of five bytes or more
    bits = min(FILTER_BITS - 8, max(2, (size * (longest - 1) // 5 // ENTRIES).bit_length()))
    counted = settle(shard_counts(table, shards, bits, longest), "shard-counts")
    counts = settle(exact_counts(table, candidate_filter(counted, support, bits), longest)
                    .filter(f"size = 1 OR f >= {support}"), "phrase-counts")
    return scored(counts, longest, absorb)


def scored(counts: DataFrame, longest: int, absorb: int) -> DataFrame:
    """The candidates among exact counts with their best cuts, less those that longer ones hold."""
    total = counts.filter("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    cuts = counts.filter("size > 1").withColumn("w", F.split("phrase", " ")).select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.expr(
            "transform(sequence(1, size - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') as left, array_join(slice(w, k + 1, size), ' ') as right))")).alias("c"))
    cuts = cuts.select("lang", "phrase", "size", "a", "c.k", "c.left", "c.right")
    part = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(18,0))"
    score = F.expr(f"({wide('a')} * {wide('a')} * cast(1000000 as decimal(7,0))) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    best = best.select("lang", "phrase", "size", "a", "b.l", "b.r", "b.score")
    if longest > 2:
        words = F.split("phrase", " ")
        pairs = F.array(F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " "))
        longer = (counts.filter("size = 3").select("lang", F.explode(F.array_distinct(pairs)).alias("phrase"), "f")
                  .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
        best = best.join(longer, ["lang", "phrase"], "left").filter(
            f"size > 2 OR longer IS NULL OR 100 * cast(longer as decimal(18,0)) < {absorb} * {wide('a')}")
    return best.join(total, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def first_phrases(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language by score, occurrences and phrase, with their ``rank``."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_per_group(found, ["lang"], order, most).withColumn("rank", F.col("row_no").cast("long")).drop("row_no")

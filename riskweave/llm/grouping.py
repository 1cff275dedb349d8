"""Best-fit packing by linear grouping.

Only the number of pieces of each length decides the packing, so the plan is
made from at most ``capacity`` counts, whatever the corpus holds: large lengths
are rounded up inside groups of equal cardinality, a linear programme over
configurations of the few rounded sizes is solved by column generation, actual
lengths take the rounded places, and the small lengths go by best fit into what
is left. The plan is a table of runs: the pieces of length L with ranks in
[from, to) go to consecutive sequences at one offset. Pieces are ranked within
their length by counts per (length, salt), so no length is sorted in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.text import raw_texts, slices
from riskweave.llm.tokens import chunk_tokenizer, public_path
from riskweave.session import settle

CAPACITY = 2048
SMALL = 3           # lengths up to capacity / SMALL are small
GROUPS = (64, 128, 256)        # rounded sizes: the best plan of these is taken
STALLED = 40        # pivots without a saving that end the programme
PRICED = 1024       # pooled configurations priced at once
ROWS_PER_SALT = 500


# ---------------------------------------------------------------- pieces

def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
           key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every document.

    A document is the ids of its text and ``end_id``; a null or empty text is
    ``end_id`` alone. Only documents longer than ``capacity`` are cut. Repeated
    rows and null keys are documents like others. ``tokenizer`` is a path that
    exists on every executor; by default the public word vocabulary's.
    """
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if keep_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_tokenizer(tokenizer or public_path("word_bpe_49k.json")).encode_batch
        for batch in slices(batches):
            ids, ends = encode(raw_texts(batch.column(1)))
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            at = 0
            for i, end in enumerate(ends.tolist()):
                doc = np.append(ids[at:end], np.uint32(end_id)).astype("<u4")
                at = end
                for p, s in enumerate(range(0, len(doc), capacity)):
                    part = doc[s:s + capacity]
                    row.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, text).mapInArrow(cut, schema)


# ---------------------------------------------------------------- the plan

def _best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    smallest = int(sizes.min())
    for room in range(smallest, capacity + 1):
        fits = sizes <= room
        worth = np.where(fits, best[room - np.minimum(sizes, room)] + values, -1.0)
        k = int(worth.argmax())
        if worth[k] > best[room - 1] + 1e-12:
            best[room], last[room] = worth[k], k
        else:
            best[room], last[room] = best[room - 1], -1
    counts = np.zeros(len(sizes), np.int64)
    room = capacity
    while room >= smallest:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= int(sizes[last[room]])
    return float(best[capacity]), counts


def _first_configurations(size: np.ndarray, capacity: int) -> np.ndarray:
    """One column per pair of sizes, completed greedily with the largest sizes that still fit."""
    n = len(size)
    i, j = np.triu_indices(n)
    keep = size[i] + size[j] <= capacity
    i, j = i[keep], j[keep]
    columns = np.zeros((n, len(i)))
    every = np.arange(len(i))
    np.add.at(columns, (i, every), 1)
    np.add.at(columns, (j, every), 1)
    room = capacity - size[i] - size[j]
    for k in range(n - 1, -1, -1):
        times = room // size[k]
        columns[k] += times
        room = room - times * size[k]
    return columns


def _inverse(basis: np.ndarray) -> np.ndarray:
    """Gauss-Jordan inverse by rank-one updates.

    ``np.linalg.inv`` waits forever for its threads in a process that imported
    numpy before it started the JVM, so no LAPACK routine runs here.
    """
    n = len(basis)
    work = np.concatenate([basis, np.eye(n)], axis=1)
    for k in range(n):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        row = work[k] / work[k, k]
        factor = work[:, k].copy()
        held = np.flatnonzero(factor)       # a basis of few-size configurations is sparse
        work[held] -= factor[held, None] * row
        work[k] = row
    return work[:, n:]


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 60) -> list[tuple[np.ndarray, int]]:
    """Configurations of the sizes and how often each is used, never beyond the demand.

    Revised simplex on the covering programme over a pool of columns, to which
    the most valuable configuration (a knapsack over the duals) is added until
    none helps; fractions are rounded down and the rest is left to best fit.
    Slightly unequal demands keep the simplex from turning in circles, and it
    ends after ``STALLED`` pivots that save nothing: any basis is a valid plan.
    """
    size = np.array(sizes, np.int64)
    need = np.array(demand, float) * (1 + 1e-6 * np.arange(1, len(size) + 1) / len(size))
    basis = np.diag((capacity // size).astype(float))
    pool = np.ascontiguousarray(_first_configurations(size, capacity).T)
    inverse = np.diag(1 / basis.diagonal())
    use = inverse @ need
    pivots = knapsacks = stalled = at = 0
    least = use.sum()
    while pivots < 8 * len(size) and stalled < STALLED:
        duals = np.maximum(inverse.sum(0), 0.0)
        column = None
        for _ in range(0, len(pool), PRICED):       # a part of the pool at a time, from where the last one ended
            part = pool[at:at + PRICED]
            worth = part @ duals
            at = at + PRICED if at + PRICED < len(pool) else 0
            best = int(worth.argmax())
            if worth[best] > 1 + 1e-6:
                column = part[best]
                break
        if column is None:
            if knapsacks == rounds:
                break
            knapsacks += 1
            value, column = _best_configuration(size, duals, capacity)
            if value <= 1 + 1e-6:
                break
        move = inverse @ column
        ratio = np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = column
        pivots += 1
        if pivots % 30 == 0:
            inverse = _inverse(basis)
        else:
            row = inverse[leave] / move[leave]
            inverse = inverse - np.outer(move, row)
            inverse[leave] = row
        use = np.maximum(inverse @ need, 0.0)
        stalled = 0 if use.sum() < least * (1 - 1e-7) else stalled + 1
        least = min(least, use.sum())
    left = np.array(demand, np.int64)
    out = []
    for j in np.argsort(-use):
        column = basis[:, j].round().astype(np.int64)
        held = column > 0
        times = int(min(np.floor(use[j] + 1e-9), (left[held] // column[held]).min()))
        if times > 0:
            left -= column * times
            out.append((column, times))
    return out


class _Plan:
    """Runs of equal sequences by free room, and the runs of ranks placed so far."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.next_rank: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int]] = []      # length, first rank, first sequence, offset
        self.spans: list[int] = []                           # how many ranks each run holds
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)   # room -> (first sequence, count)
        self.rooms: list[int] = []                           # sorted rooms that are open
        self.sequences = 0

    def put(self, length: int, first: int, count: int, offset: int) -> None:
        self.runs.append((length, self.next_rank[length], first, offset))
        self.spans.append(count)
        self.next_rank[length] += count
        self.left[length] -= count

    def release(self, room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if not self.open[room]:
                bisect.insort(self.rooms, room)
            self.open[room].append((first, count))

    def new(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def best_fit(self, length: int) -> None:
        """Puts all that is left of ``length`` where the room left over is least."""
        while self.left.get(length, 0) > 0:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                per = self.capacity // length
                full, rest = divmod(self.left[length], per)
                for times, held in ((full, per), (1, rest)):
                    if times and held:
                        first = self.new(times)
                        for i in range(held):
                            self.put(length, first, times, i * length)
                        self.release(self.capacity - held * length, first, times)
                continue
            room = self.rooms[at]
            first, count = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(at)
            took = min(count, self.left[length])
            self.put(length, first, took, self.capacity - room)
            self.release(room - length, first, took)
            self.release(room, first + took, count - took)

    def fill(self, column: np.ndarray, times: int, sizes: list[int], large: list[int]) -> None:
        """Uses one configuration ``times`` times with actual lengths.

        Each place takes the longest piece left that its rounded size admits,
        the last place the longest that fits what the others really left.
        ``large`` are the sorted lengths with pieces left.
        """
        places = [sizes[g] for g in np.flatnonzero(column)[::-1] for _ in range(int(column[g]))]
        first = self.new(times)
        runs = [(0, times, 0)]          # sequences [a, b) of this configuration and their fill
        for k, size in enumerate(places):
            grown = []
            for a, b, used in runs:
                room = self.capacity - used
                while a < b:
                    at = bisect.bisect_right(large, room if k == len(places) - 1 else min(size, room)) - 1
                    if at < 0:
                        grown.append((a, b, used))
                        break
                    length = large[at]
                    took = min(b - a, self.left[length])
                    self.put(length, first + a, took, used)
                    grown.append((a, a + took, used + length))
                    if not self.left[length]:
                        large.pop(at)
                    a += took
            runs = grown
        for a, b, used in runs:
            self.release(self.capacity - used, first + a, b - a)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS, small: int = SMALL) -> dict[str, np.ndarray]:
    """Places all pieces of the given lengths (1 to ``capacity``), with as few sequences as one of ``groups`` needs."""
    return min((grouped_plan(counts, capacity, g, small) for g in groups), key=lambda made: made["sequences"][0])


def grouped_plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> dict[str, np.ndarray]:
    """The plan with ``groups`` rounded sizes, sorted by (length, first rank)."""
    made = _Plan(counts, capacity)
    full = counts.get(capacity, 0)
    if full:
        made.put(capacity, made.new(full), full, 0)
    large = sorted(x for x, n in counts.items() if capacity // small < x < capacity and n > 0)
    total = sum(counts[x] for x in large)
    if total:
        members: dict[int, list[int]] = defaultdict(list)
        seen = 0
        for x in large:
            members[(seen + counts[x] // 2) * groups // total].append(x)
            seen += counts[x]
        lists = [members[g] for g in sorted(members)]
        sizes, demand = [m[-1] for m in lists], [sum(counts[x] for x in m) for m in lists]
        rest = list(large)
        for column, times in configurations(sizes, demand, capacity):
            made.fill(column, times, sizes, rest)
        for x in reversed(rest):
            made.best_fit(x)
    for x in sorted((x for x, n in counts.items() if x <= capacity // small and n > 0), reverse=True):
        made.best_fit(x)
    runs = np.array(made.runs, np.int64).reshape(-1, 4)
    ranks = np.array(made.spans, np.int64)
    order = np.lexsort((np.arange(len(runs)), runs[:, 0])) if len(runs) else np.empty(0, np.int64)
    return {"length": runs[order, 0], "rank": runs[order, 1], "sequence": runs[order, 2], "offset": runs[order, 3],
            "count": ranks[order], "sequences": np.array([made.sequences])}


# ---------------------------------------------------------------- on Spark

def pack(cut: DataFrame, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS, small: int = SMALL) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    The plan has at most a few runs per configuration and length, a number set
    by ``capacity``, ``groups`` and ``small`` and not by the rows; it is what
    every executor gets. An empty table stays empty.
    """
    spark = cut.sparkSession
    columns = cut.columns
    held = settle(cut.withColumn("__deal", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(counts, capacity, groups, small)
    keys = spark.sparkContext.broadcast((made["length"] << 44 | made["rank"], made["rank"], made["sequence"], made["offset"]))

    salts = ",".join(str(-(-counts.get(x, 0) // ROWS_PER_SALT) or 1) for x in range(1, capacity + 1))
    dealt = held.withColumn("__salt", F.expr(f"cast(pmod(__deal, array({salts})[cast(length - 1 as int)]) as int)"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    within = Window.partitionBy("length", "__salt").orderBy("__deal")
    ranked = (dealt.withColumn("__rank", F.row_number().over(within)).join(offsets, ["length", "__salt"])
              .withColumn("__rank", F.col("__rank") - 1 + F.col("__before")).select(*columns, "__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first_rank, sequence, offset = keys.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(np.int64)
            length = batch.column(columns.index("length")).to_numpy(zero_copy_only=False)
            run = np.searchsorted(key, length << 44 | rank, "right") - 1
            out = [batch.column(i) for i in range(len(columns))]
            out += [pa.array(sequence[run] + rank - first_rank[run], pa.int64()), pa.array(offset[run], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(pieces(docs, tokenizer, capacity), capacity)


def write_packed(docs: DataFrame, path: str, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Writes one row per sequence: its ids in place order and where each piece starts."""
    placed = pack(pieces(docs, tokenizer, capacity, keep_ids=True), capacity)
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("starts")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)

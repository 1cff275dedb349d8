"""Packed token-id rows by best-fit decreasing with a segment-tree search for room.

Each task tokenises its documents and packs windows of pieces: the longest
first, each into the fullest sequence that still has room, found by one walk up
and down a segment tree over the free room. What ends a window half empty goes
into the next one. Nothing is shuffled and a task holds one window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from riskweave.llm.text import raw_texts, slices
from riskweave.llm.tokens import chunk_tokenizer, public_path

CAPACITY = 2048
END_ID = 49407
WINDOW = 1_000_000      # tokens packed at once
FULL_ENOUGH = 0.97      # sequences below this share go into the next window


class RoomTree:
    """How many open sequences have each free room; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A sequence with the least room of at least ``need``, and that room."""
        at, count = need + self.size, self.count
        while not count[at]:
            while at & 1:           # a right child: go up until there is a right neighbour
                at >>= 1
                if at <= 1:
                    return None
            if at <= 1:
                return None
            at += 1                 # the subtree of larger rooms
            if count[at]:
                break
        while at < self.size:
            at <<= 1
            if not count[at]:
                at += 1
        room = at - self.size
        self._change(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of piece numbers; equal lengths keep their order."""
    tree, out = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        found = tree.take(need)
        if found is None:
            found = (len(out), capacity)
            out.append([])
        sequence, room = found
        out[sequence].append(i)
        if room > need:
            tree.add(room - need, sequence)
    return out


def packed_rows(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                pad_id: int = 0, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per sequence of ``capacity`` ids.

    sequence_id; ids (binary, little-endian unsigned 16-bit, or 32-bit where the
    vocabulary, ``end_id``, ``pad_id`` or ``capacity`` goes beyond 65,536, padded with
    ``pad_id``); n_tokens; cu_seqlens (0 and the end of each piece);
    position_ids (binary like ids, counting from 0 in each piece, 0 in the
    padding); doc_ids and starts (the document of each piece and how many of its
    ids come before). A document is the ids of its text and ``end_id``; null and
    empty texts are ``end_id`` alone. Only documents longer than ``capacity``
    are cut, and their pieces joined by ``starts`` give them back. Repeated rows
    and null keys are documents like others; an empty table gives no row.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"sequence_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_ids binary, "
              f"doc_ids array<{kind}>, starts array<long>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = chunk_tokenizer(tokenizer or public_path("word_bpe_49k.json"))
        encode = vocabulary.encode_batch
        width = "<u2" if max(vocabulary.size, end_id + 1, pad_id + 1, capacity) <= 1 << 16 else "<u4"
        base = TaskContext.get().partitionId() << 33
        made = 0
        pool: list[tuple] = []      # (ids, document, start)
        held = 0

        def pack(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pool, held, made
            sequences = best_fit_decreasing([len(p[0]) for p in pool], capacity)
            rows, back, spare = [], [], 0
            for s in sequences:
                used = sum(len(pool[i][0]) for i in s)
                if not last and used < FULL_ENOUGH * capacity and spare + used <= window // 2:
                    back += [pool[i] for i in s]
                    spare += used
                else:
                    rows.append(([pool[i] for i in s], used))
            for at in range(0, len(rows), 256):
                yield _rows(rows[at:at + 256], base + made, capacity, pad_id, batch_type, width)
                made += len(rows[at:at + 256])
            pool, held = back, spare

        batch_type = None
        for batch in slices(batches):
            batch_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            ids, ends = encode(raw_texts(batch.column(1)))
            at = 0
            for k, end in zip(keys, ends.tolist()):
                doc = np.append(ids[at:end], np.uint32(end_id)).astype(width)
                at = end
                for start in range(0, len(doc), capacity):
                    pool.append((doc[start:start + capacity], k, start))
                held += len(doc)
            if held >= window:
                yield from pack(False)
        if pool:
            yield from pack(True)

    return docs.select(key, text).mapInArrow(work, schema)


def _rows(rows: list[tuple[list, int]], first: int, capacity: int, pad_id: int, kind: pa.DataType, width: str) -> pa.RecordBatch:
    ids = np.full((len(rows), capacity), pad_id, width)
    positions = np.zeros((len(rows), capacity), width)
    ends, keys, starts = [], [], []
    for r, (parts, used) in enumerate(rows):
        sizes = [len(p[0]) for p in parts]
        edge = np.cumsum([0, *sizes])
        ids[r, :used] = np.concatenate([p[0] for p in parts])
        positions[r, :used] = np.arange(used) - np.repeat(edge[:-1], sizes)
        ends.append(edge.tolist())
        keys.append([p[1] for p in parts])
        starts.append([p[2] for p in parts])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first, first + len(rows))), pa.array([x.tobytes() for x in ids], pa.binary()),
         pa.array([used for _, used in rows], pa.int32()), pa.array(ends, pa.list_(pa.int32())),
         pa.array([x.tobytes() for x in positions], pa.binary()), pa.array(keys, pa.list_(kind)), pa.array(starts, pa.list_(pa.int64()))],
        ["sequence_id", "ids", "n_tokens", "cu_seqlens", "position_ids", "doc_ids", "starts"])


def write_packed_rows(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the rows as Parquet under ``path`` and reads them back."""
    packed_rows(docs, **options).write.parquet(path)
    return docs.sparkSession.read.parquet(path)

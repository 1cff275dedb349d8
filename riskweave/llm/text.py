"""Helpers shared by the text operators: batches of raw text, interned words, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

ROWS = 256          # documents taken out of an Arrow batch at a time
U64 = np.uint64


class Interner(dict):
    """Maps a key to ``make(key)`` and forgets everything once ``limit`` keys are held.

    A bounded cache: forgetting costs time, never a different result.
    """

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (three xor-shift-multiply rounds)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each run of ``n`` word hashes; a shorter text has one for all its words."""
    if not len(words):
        return words
    n = min(n, len(words))
    count = len(words) - n + 1
    out = np.full(count, n, U64)
    for i in range(n):
        out = mix(out * U64(0x9E3779B97F4A7C15) + words[i:i + count])
    return out


def signed_votes(hashes: np.ndarray, lanes: int, weights: np.ndarray | None = None, block: int = 1 << 15) -> np.ndarray:
    """Per bit of ``lanes`` 64-bit words: the weights of hashes that set it less those that don't."""
    total = float(len(hashes) if weights is None else weights.sum())
    ones = np.zeros(lanes * 64)
    for at in range(0, len(hashes), block):
        part = hashes[at:at + block]
        for lane in range(lanes):
            h = part if lane == 0 else mix(part + U64(lane * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
            bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64)
            if weights is None:
                ones[lane * 64:lane * 64 + 64] += bits.sum(0, dtype=np.int64)
            else:
                ones[lane * 64:lane * 64 + 64] += weights[at:at + block].astype(np.float32) @ bits.astype(np.float32)
    return 2 * ones - total


def pack_bits(votes: np.ndarray) -> np.ndarray:
    """64-bit words whose bits are set where the vote is above zero, first bit highest."""
    return np.packbits(votes > 0).view(">u8").astype(U64)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

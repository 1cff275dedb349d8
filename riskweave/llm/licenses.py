"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment confirms them.

Templates are put in classes by a stride of at least their number of shingles.
Windows of two strides, one stride apart, hold every template of their class
whole somewhere, which bounds the Jaccard similarity of template and window from
below; the number of bands follows from that bound and the wanted probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.text import U64, Interner, mix, raw_texts, shingle_hashes, slices, word_hash

SHINGLE = 2             # words
ROWS = 1                # MinHash values of a band
PROBABILITY = 0.9999    # of meeting a template in a band at the least similarity that counts
CONTAINED = 0.8         # share of the template's shingles in the window
BLOCK = 4               # the smallest stride, in shingles

# fixed values: license notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                      "following conditions are met",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
EDGE = b" \t\"'`()[]{}<>,;:!?|*#&$%-_."


def bands_for(similarity: float, rows: int = ROWS, probability: float = PROBABILITY) -> int:
    """Bands needed to meet at ``similarity`` with ``probability``."""
    if similarity >= 1:
        return 1
    return max(1, math.ceil(math.log(1 - probability) / math.log(1 - similarity ** rows)))


def _key(chunk: bytes) -> int:
    word = chunk.strip(EDGE).lower()
    return word_hash(word) if word else 0


def _words(text: bytes | None, cache: Interner) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that have more than punctuation, and their places among the chunks."""
    chunks = text.split() if text else []
    hashes = np.fromiter(map(cache.__getitem__, chunks), U64, len(chunks))
    at = np.flatnonzero(hashes)
    return hashes[at], at


def _minhash(hashes: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th order of the shingles: an odd multiplier, the high half."""
    odd = mix(np.array([k + 1], U64))[0] | U64(1)
    return (hashes * odd) >> U64(32)


class Scanner:
    """Templates by stride, with their MinHash values per band."""

    def __init__(self, templates: Mapping[str, str], contained: float, rows: int, probability: float):
        cache = Interner(_key)
        self.contained, self.rows = contained, rows
        self.classes: dict[int, list[tuple[str, np.ndarray]]] = {}
        self.places: dict[str, dict[int, list[int]]] = {}       # of each shingle in its template
        for name, text in sorted(templates.items()):
            words, _ = _words(text.encode(), cache)
            ordered = shingle_hashes(words, SHINGLE)
            shingles = np.unique(ordered)
            if len(shingles):
                places = self.places.setdefault(name, {})
                for place, s in enumerate(ordered.tolist()):
                    places.setdefault(s, []).append(place)
                stride = BLOCK
                while stride < len(words):
                    stride *= 2
                self.classes.setdefault(stride, []).append((name, shingles))
        self.bands = {}
        for stride, held in self.classes.items():
            # the least similarity: the wanted part of the smallest template inside a window of others
            least = min(len(s) * contained / (2 * stride + (1 - contained) * len(s)) for _, s in held)
            self.bands[stride] = bands_for(min(1.0, least), rows, probability)
        self.signs = {stride: np.array([[_minhash(s, k).min() for k in range(self.bands[stride] * rows)] for _, s in held])
                      for stride, held in self.classes.items()}

    def scan(self, words: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(template, first word, end, containment) of each occurrence."""
        if not len(words):
            return []
        shingles = shingle_hashes(words, SHINGLE)
        starts = np.arange(0, len(shingles), BLOCK)
        most = max(b for b in self.bands.values()) * self.rows
        low = np.stack([np.minimum.reduceat(_minhash(shingles, k), starts) for k in range(most)])
        out = []
        for stride, held in sorted(self.classes.items()):
            per = stride // BLOCK
            edges = np.arange(0, low.shape[1], per)
            strides = np.minimum.reduceat(low[:self.bands[stride] * self.rows], edges, axis=1)
            windows = np.minimum(strides, np.concatenate([strides[:, 1:], strides[:, -1:]], axis=1))
            for (name, own), sign in zip(held, self.signs[stride]):
                equal = (windows == sign[:, None]).reshape(-1, self.rows, windows.shape[1]).all(1).any(0)
                found = {}
                for at in (np.flatnonzero(equal) * stride).tolist():
                    hits = at + np.flatnonzero(np.isin(shingles[at:at + 2 * stride], own))
                    if len(np.unique(shingles[hits])) / len(own) >= self.contained:
                        found[at] = hits
                if found:
                    out += self._occurrences(name, len(own), shingles, found, 2 * stride)
        return out

    def _occurrences(self, name: str, size: int, shingles: np.ndarray, found: Mapping[int, np.ndarray],
                     width: int) -> list[tuple[str, int, int, float]]:
        """The windows' hits one occurrence at a time: one ends where the template's order starts anew.

        Hits outside such occurrences, for instance where sentences changed
        places, still count as one where they alone hold enough of the template.
        """
        hits = np.unique(np.concatenate(list(found.values())))
        places, runs, last = self.places[name], [], 0
        for at, s in zip(hits.tolist(), shingles[hits].tolist()):
            later = next((p for p in places[s] if p > last), None) if runs and at - runs[-1][0] < width else None
            if later is None:
                runs.append([at])
            else:
                runs[-1].append(at)
            last = places[s][0] if later is None else later

        def share(at: np.ndarray) -> float:
            return len(np.unique(shingles[at])) / size

        whole = [r for r in map(np.array, runs) if share(r) >= self.contained]
        out = [(name, int(r[0]), int(r[-1]) + SHINGLE, share(r)) for r in whole]
        taken = np.concatenate(whole) if whole else hits[:0]
        rest = None
        for _, inside in sorted(found.items()):
            left = inside[~np.isin(inside, taken)]
            if len(left) and share(left) >= self.contained:
                now = (name, int(left[0]), int(left[-1]) + SHINGLE, share(left))
                if rest is not None and now[1] < rest[2]:     # the neighbouring window saw it, too
                    now = (name, rest[1], max(now[2], rest[2]), max(now[3], rest[3]))
                    out.pop()
                rest = now
                out.append(now)
        return sorted(out, key=lambda o: o[1:3])


def license_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text",
                  contained: float = CONTAINED, rows: int = ROWS, probability: float = PROBABILITY) -> DataFrame:
    """(key, license, start_word, end_word, containment) of every occurrence in every row.

    Notices that follow one another, even without a word between them, are
    occurrences of their own. Words are runs without ASCII white space, without
    punctuation at their edges and of any case; places count runs from 0, the end is exclusive.
    Null and empty texts have none; repeated rows are scanned alike; texts are
    scanned whole. ``templates`` is part of the program's setting, not of the data.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = dict(templates)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, cache = Scanner(held, contained, rows, probability), Interner(_key)
        for batch in slices(batches):
            row, out = [], []
            for i, t in enumerate(raw_texts(batch.column(1))):
                words, at = _words(t, cache)
                for name, first, end, share in scanner.scan(words):
                    row.append(i)
                    out.append((name, int(at[first]), int(at[min(end, len(at)) - 1]) + 1, share))
            cache.trim()
            if out:
                names, first, end, share = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(names), pa.array(first, pa.int64()),
                     pa.array(end, pa.int64()), pa.array(share, pa.float64())], [key, "license", "start_word", "end_word", "containment"])

    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, license string, start_word long, end_word long, containment double")

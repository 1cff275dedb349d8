"""Token ids of whole texts by a public tokenizer file.

White space always ends a piece of the word tokenizer, so a text is cut at
ASCII white space and each distinct chunk is encoded once per cache life by the
tokenizer's own normaliser, pre-tokenizer and model. The ids equal those of
encoding the whole text with ``add_special_tokens=False``. A chunk that holds
the text of an added token (``<|endoftext|>``) is left to the tokenizer itself,
which gives it the added token's id.
"""

from __future__ import annotations

from array import array
from itertools import chain
from unicodedata import is_normalized

import numpy as np

CACHE_CHUNKS = 600_000
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"      # ASCII marks but the apostrophe, which starts pieces of its own
ODD_CASE = "\u03a3\u0130"      # letters whose lower case depends on more than themselves


def _byte_signs() -> dict[int, str]:
    """The sign that byte-level models use for each byte: itself where it prints, else the next one from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_SIGNS = _byte_signs()


class ChunkTokenizer:
    """Encodes batches of UTF-8 texts; memory is bounded by the cache and the batch."""

    def __init__(self, path: str, cache: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        self._normalize = whole.normalizer.normalize_str
        self._split = whole.pre_tokenizer.pre_tokenize_str
        self._model = whole.model.tokenize
        self._whole = whole
        self._added = [t.content.lower().encode() for t in whole.get_added_tokens_decoder().values()]
        # whether letters with marks behind them can be or end in an added token
        self._lettered = any(t.decode()[:1].isalpha() or not t.decode().rstrip(TAIL) for t in self._added)
        self.size = whole.get_vocab_size()
        self._cache = cache
        self._pieces: dict[str, list[int]] = {}
        self._at: dict[bytes, int] = _Chunks(self)
        self._ids, self._starts = array("I"), array("q", [0])

    def _encode(self, chunk: bytes) -> list[int]:
        text = chunk.decode("utf-8")
        body = text.rstrip(TAIL)
        if (self._lettered or not body.isalpha()) and any(a in chunk.lower() for a in self._added):
            return self._whole.encode(text, add_special_tokens=False).ids
        if not (body.isalpha() and (text.isascii() or is_normalized("NFC", text) and ODD_CASE[0] not in text and ODD_CASE[1] not in text)):
            return [t.id for p, _ in self._split(self._normalize(text)) for t in self._model(p)]
        # a run of letters and a run of marks are the two pieces that the pre-tokenizer would cut
        out: list[int] = []
        for p in (body.lower(), text[len(body):]):
            if p:
                ids = self._pieces.get(p)
                if ids is None:
                    spelled = p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_SIGNS)
                    ids = self._pieces[p] = [t.id for t in self._model(spelled)]
                out += ids
        return out

    def add(self, chunk: bytes) -> int:
        at = len(self._starts) - 1
        self._ids.extend(self._encode(chunk))
        self._starts.append(len(self._ids))
        return at

    def encode_batch(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (uint32), and where each text ends."""
        if len(self._at) > self._cache:
            self._at.clear()
            self._pieces.clear()
            self._ids, self._starts = array("I"), array("q", [0])
        look = self._at.__getitem__
        chunks = [t.split() if t else [] for t in texts]
        doc_chunks = np.cumsum([len(c) for c in chunks], dtype=np.int64)
        which = np.fromiter(map(look, chain.from_iterable(chunks)), np.int64, int(doc_chunks[-1]) if len(chunks) else 0)
        starts = np.frombuffer(self._starts, np.int64)
        sizes = starts[which + 1] - starts[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(starts[which] - (ends - sizes), sizes) + np.arange(total)
        ids = np.frombuffer(self._ids, np.uint32)[take] if total else np.empty(0, np.uint32)
        doc_ends = np.concatenate([[0], ends])[doc_chunks] if len(chunks) else np.empty(0, np.int64)
        del starts
        return ids, doc_ends.astype(np.int64)


class _Chunks(dict):
    def __init__(self, owner: ChunkTokenizer):
        super().__init__()
        self._owner = owner

    def __missing__(self, chunk: bytes) -> int:
        at = self[chunk] = self._owner.add(chunk)
        return at


_loaded: dict[str, ChunkTokenizer] = {}


def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer for each path and Python worker."""
    if path not in _loaded:
        _loaded[path] = ChunkTokenizer(path)
    return _loaded[path]


def forget_tokenizers() -> None:
    """Frees the caches of a worker whose next tasks encode nothing."""
    _loaded.clear()


def public_path(name: str) -> str:
    """Where the public vocabulary ``name`` lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)

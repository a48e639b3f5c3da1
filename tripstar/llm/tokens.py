"""Token ids of whole texts for byte-level BPE vocabularies, with a bounded cache of words.

A blank between two non-blank characters always begins a new piece of a byte-level BPE,
so a text may be cut there and each part encoded by itself with the same ids. Parts repeat,
hence most are found in the cache; when it is full, unseen parts are encoded each time.
The ranks files hold the same vocabularies as the JSON files of the `tokenizers` library,
which is several times slower on short parts; tests hold the ids of both equal.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

CACHED_PARTS = 200_000
END_OF_TEXT = "<|endoftext|>"
_ADJACENT = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


class Encoder:
    """Ids of texts by one vocabulary; ``end_of_text`` is the id of the one special token."""

    def __init__(self, ranks: str, end_of_text: int | None, cached_parts: int = CACHED_PARTS):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            pairs = [line.split() for line in lines]
        self.encoding = tiktoken.Encoding(
            ranks,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={} if end_of_text is None else {END_OF_TEXT: end_of_text},
        )
        self.special = end_of_text is not None
        self.parts: dict[str, bytes] = {}
        self.cached_parts = cached_parts
        self.n_bytes = np.zeros(self.encoding.max_token_value + 1, dtype=np.int64)
        for token, rank in pairs:
            self.n_bytes[int(rank)] = len(base64.b64decode(token))

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of unseen parts, each after a blank; kept while the cache has room."""
        # white space may join its neighbours: such parts are encoded one by one
        odd = [p for p in parts if not p or p[0].isspace() or p[-1].isspace()]
        plain = list(set(parts).difference(odd))
        learned = {p: self._one(" " + p) for p in odd}
        if plain:  # one call for all; token lengths tell where each part ends
            ids = np.array(self.encoding.encode_ordinary(" " + " ".join(plain)), dtype="<u4")
            part_ends = np.cumsum([len(p.encode()) + 1 for p in plain])
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), part_ends) + 1
            raw, ends = ids.tobytes(), (cuts * 4).tolist()
            learned.update(zip(plain, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=False))
        if len(self.parts) + len(learned) <= self.cached_parts:
            self.parts.update(learned)
        return learned

    def _one(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        known = self.parts.get
        out: list[bytes | None] = []
        open_texts, unseen = [], []
        for i, text in enumerate(texts):
            if self.special and END_OF_TEXT in text:
                ids = self.encoding.encode(text, allowed_special="all")
                out.append(np.array(ids, dtype="<u4").tobytes())
                continue
            if _ADJACENT.search(text):
                parts = [p[1:] if k else p for k, p in enumerate(_CUT.split(text))]
            else:
                parts = text.split(" ")
            first = self._one(parts[0])
            del parts[0]
            found = list(map(known, parts))
            if None in found:
                unseen += [p for p, ids in zip(parts, found, strict=True) if ids is None]
                open_texts.append((i, first, parts, found))
                out.append(None)
            else:
                out.append(first + b"".join(found))
        if unseen:
            learned = self._learn(unseen)
            for i, first, parts, found in open_texts:
                rest = [learned[p] if ids is None else ids for p, ids in zip(parts, found, strict=True)]
                out[i] = first + b"".join(rest)
        return out


def in_batches(texts: Iterable[str], n_chars: int = 1_000_000):
    """Runs of texts of about so many characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > n_chars:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


@lru_cache(maxsize=4)
def encoder(ranks: str, end_of_text: int | None = None) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(ranks, end_of_text)


class Counter:
    """Token counts of texts under several vocabularies at once.

    Parts are looked up once; what is kept for a part is its counts packed into one integer,
    ``BITS`` bits each, so that the counts of a text are one sum.
    """

    BITS = 40

    def __init__(self, ranks: tuple[str, ...], cached_parts: int = CACHED_PARTS):
        self.encodings = [Encoder(name, None).encoding for name in ranks]
        self.cached_parts = cached_parts
        self.parts: dict[str, int] = {}

    def _one(self, text: str) -> int:
        return sum(len(e.encode_ordinary(text)) << (self.BITS * i) for i, e in enumerate(self.encodings))

    def count(self, text: str) -> list[int]:
        """Number of tokens under each vocabulary; special tokens are ordinary text."""
        if _ADJACENT.search(text):
            parts = [p[1:] if k else p for k, p in enumerate(_CUT.split(text))]
        else:
            parts = text.split(" ")
        total = self._one(parts[0])
        del parts[0]
        found = list(map(self.parts.get, parts))
        if None in found:
            fresh = {p: self._one(" " + p) for p, n in zip(parts, found, strict=True) if n is None}
            if len(self.parts) + len(fresh) <= self.cached_parts:
                self.parts.update(fresh)
            found = [fresh[p] if n is None else n for p, n in zip(parts, found, strict=True)]
        total += sum(found)
        mask = (1 << self.BITS) - 1
        return [total >> (self.BITS * i) & mask for i in range(len(self.encodings))]


@lru_cache(maxsize=2)
def counter(ranks: tuple[str, ...]) -> Counter:
    """One counter per worker process and set of vocabularies."""
    return Counter(ranks)

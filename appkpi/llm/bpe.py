"""Byte-level BPE: a priority queue of merge ranks over a doubly linked list of symbols.

Every neighbouring pair that has a rank waits in a heap. The lowest rank, leftmost first, is merged;
its neighbours get new pairs, and entries whose symbols have changed since are skipped when they
come up. So a word of n bytes costs n log n, whatever its length. Words that come again inside a
task are looked up. Decoding concatenates the vocabulary's byte strings.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from appkpi.llm.common import map_rows
from appkpi.llm.tokens import BYTE_LEVEL_WORDS, UNUSUAL, Words, byte_letters

# Fixed value: how the byte-level vocabulary cuts a text into words, with any letters.
ANY_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Encoder and decoder of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        byte_of = {c: b for b, c in byte_letters().items()}

        def plain(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        ids = model["vocab"]
        self.first = [ids[byte_letters()[b]] for b in range(256)]
        # For each left symbol the ranks of its pairs, by right symbol; and what a rank makes.
        self.rank: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[left]][ids[right]] = rank
            self.made.append(ids[left + right])
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        texts = {i: plain(t) for t, i in ids.items()}
        texts.update({i: t.encode() for t, i in special.items()})
        self.text_of = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")").split
        self.usual_cut = re.compile(BYTE_LEVEL_WORDS).findall
        self.unusual = re.compile(UNUSUAL).search
        self.any_cut = regex.compile(ANY_WORDS).findall
        self.known = Words(lambda word: self.merge(word.encode()))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word. A heap entry is a rank with a position in its low bits."""
        symbols, rank = [self.first[b] for b in word], self.rank
        n = len(symbols)
        low = 12 if n <= 4096 else 40
        mask = (1 << low) - 1
        heap, i, a = [], 0, symbols[0]
        for b in symbols[1:]:
            ranks = rank[a]
            if b in ranks:
                heap.append(ranks[b] << low | i)
            a = b
            i += 1
        if not heap:
            return symbols
        heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            entry = heappop(heap)
            i = entry & mask
            j = after[i]
            a = symbols[i]
            if a < 0 or j >= n:
                continue
            ranks, b = rank[a], symbols[j]
            # Stale if a merge has changed either symbol since the entry was made.
            if ranks.get(b) != entry >> low:
                continue
            made = self.made[entry >> low]
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                ranks, b = rank[made], symbols[k]
                if b in ranks:
                    heappush(heap, ranks[b] << low | i)
            h = before[i]
            if h >= 0:
                ranks = rank[symbols[h]]
                if made in ranks:
                    heappush(heap, ranks[made] << low | h)
        return [s for s in symbols if s >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as 16-bit numbers in the machine's order."""
        packed = []
        for part in self.split_special(text):
            if part in self.special:
                packed.append(self.special[part].to_bytes(2, sys.byteorder))
            elif part:
                words = self.any_cut(part) if self.unusual(part) else self.usual_cut(part)
                packed.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(packed)

    def decode(self, ids) -> str:
        """The text; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each row's whole text; null texts count as empty, with no ids."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        bpe = byte_bpe(path)
        for doc_id, text in found:
            yield doc_id, memoryview(bpe.encode(text or "")).cast("H").tolist()

    return map_rows(docs, ["doc_id", "text"], "doc_id long, ids array<int>", rows)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` of each row's ``ids``; null ids count as none."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        bpe = byte_bpe(path)
        for doc_id, ids in found:
            yield doc_id, bpe.decode(ids or [])

    return map_rows(encoded, ["doc_id", "ids"], "doc_id long, text string", rows)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (32-bit little-endian) and of the decoded text.

    Encodes and decodes in one pass over the texts, so that the ids, which are several times the
    size of the result, never leave the task.
    """

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import hashlib

        import numpy as np

        bpe = byte_bpe(path)
        for doc_id, text in found:
            packed = bpe.encode(text or "")
            ids = memoryview(packed).cast("H")
            yield (
                doc_id,
                len(ids),
                hashlib.sha256(np.frombuffer(packed, "<u2").astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(bpe.decode(ids).encode()).hexdigest(),
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs, ["doc_id", "text"], schema, rows)

"""64-bit hashes of the words of a text, in whole numpy passes.

A word is a run of bytes other than blanks. Its hash is a polynomial in its bytes modulo 2**64,
taken from running sums over the text, then mixed; equal words have equal hashes wherever they are.
"""

from __future__ import annotations

from functools import lru_cache

BLANKS = b" \t\n\r\x0b\x0c"
# Bytes that are hashed in one pass, which bounds the tables of powers.
PIECE_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _tables():
    import numpy as np

    inverse = pow(BASE, -1, 1 << 64)
    up = np.full(PIECE_BYTES, BASE, np.uint64)
    down = np.full(PIECE_BYTES, inverse, np.uint64)
    up[0] = down[0] = 1
    is_word = np.ones(256, np.int8)
    is_word[list(BLANKS)] = 0
    return np.multiply.accumulate(up), np.multiply.accumulate(down), is_word


def hash_words(raw: bytes):
    """Hashes of the words of ``raw``, in order, as unsigned 64-bit numbers."""
    return hash_words_and_starts(raw, 0)[0]


def hash_words_and_starts(raw: bytes, most: int):
    """Hashes of the words, and of their first ``most`` bytes, from the same running sums."""
    import numpy as np

    found = []
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        if end < len(raw):
            # Cut after the last blank; a word that fills a piece is hashed by itself.
            cut = max(raw.rfind(bytes((c,)), at, end) for c in BLANKS)
            if cut < 0:
                cuts = [raw.find(bytes((c,)), end) for c in BLANKS]
                end = min((c for c in cuts if c >= 0), default=len(raw))
                found.append(_long_word(raw[at:end], most))
                at = end
                continue
            end = cut + 1
        found.append(_hash_piece(raw[at:end], most))
        at = end
    if len(found) == 1:
        return found[0]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _long_word(word: bytes, most: int):
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(word)], np.uint64), _hash_piece(word[: most or 1], 0)[0]


def hash_texts(raws: list[bytes]):
    """Hashes of the words of all texts, in order, and how many words each text has."""
    import numpy as np

    raw = b"\n".join(raws)
    if len(raws) == 1 or len(raw) > PIECE_BYTES:
        found = [hash_words(r) for r in raws]
        return np.concatenate([np.zeros(0, np.uint64), *found]), np.array([len(x) for x in found], np.int64)
    starts, ends = _edges(raw)
    # Each text ends with a blank of its own.
    borders = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]))
    return _hash_piece(raw, 0, (starts, ends))[0], np.diff(borders, prepend=0)


def _edges(raw: bytes):
    import numpy as np

    is_word = _tables()[2]
    edge = np.flatnonzero(np.diff(is_word[np.frombuffer(raw, np.uint8)], prepend=np.int8(0), append=np.int8(0)))
    return edge[::2], edge[1::2]


def _hash_piece(raw: bytes, most: int, edges=None):
    import numpy as np

    up, down, _ = _tables()
    b = np.frombuffer(raw, np.uint8)
    starts, ends = edges or _edges(raw)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    before, scale, size = sums[starts], down[starts], ends - starts
    # The length keeps words apart whose bytes happen to sum up to the same number.
    words = mix(((sums[ends] - before) * scale) ^ size.astype(np.uint64))
    if not most:
        return words, words
    size = np.minimum(size, most)
    return words, mix(((sums[starts + size] - before) * scale) ^ size.astype(np.uint64))


def mix(h):
    """Spreads every bit over the whole number."""
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))

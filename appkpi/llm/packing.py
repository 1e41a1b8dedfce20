"""Packing along a space-filling curve.

A document's token ids are counted with hashed signs into ``DIMENSIONS`` numbers; their Gaussian
ranks are a cell of a grid, and the cell's place on the Hilbert curve is the document's key. Sorted
by key, like documents are neighbours, and they are laid end to end along the curve and cut every
2048 ids. Only the last sequence is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import map_rows, numbered, settle
from appkpi.llm.tokens import encoded, library_coder

SEQUENCE = 2048
END_ID = 1
DIMENSIONS = 3
GRID_BITS = 16


def hilbert_key(cell: list[int], bits: int = GRID_BITS) -> int:
    """Place of a grid cell on the Hilbert curve through a cube of side 2**bits."""
    # Skilling's transposition, from the highest bit down.
    x, n = list(cell), len(cell)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    key = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ t) >> b & 1)
    return key


def projections(ids: int = 1 << 16):
    """For each token id one number of mean 0 and variance 1 per dimension."""
    import numpy as np

    return np.random.default_rng(3).choice([-1.0, 1.0], (DIMENSIONS, ids)).astype(np.float32)


def curve_key(ids, signs) -> int:
    """Hilbert key of a document by its 16-bit ids: of the directions in which its ids lean."""
    import math

    if not len(ids):
        return 0
    import numpy as np

    kinds, counts = np.unique(ids, return_counts=True)
    weights = np.sqrt(counts)
    lean = signs[:, kinds] @ weights / math.sqrt(float(counts.sum()))
    top = (1 << GRID_BITS) - 1
    cell = [min(top, int((1 + math.erf(v / math.sqrt(2))) / 2 * (1 << GRID_BITS))) for v in lean]
    return hilbert_key(cell)


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``key``, ``n`` and ``ids`` (16-bit, little-endian, with the end id) of each row."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        coder, signs = library_coder(path), projections()
        end = END_ID.to_bytes(2, "little")
        for doc_id, raw in encoded(coder, found):
            yield doc_id, curve_key(np.frombuffer(raw, "<u2"), signs), len(raw) // 2 + 1, raw + end

    return map_rows(docs, ["doc_id", "text"], "doc_id long, key long, n long, ids binary", rows)


PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids (16-bit), doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone. Rows may repeat or lack ids: every row is packed by
    itself; ties on the curve go by doc_id, then by the ids themselves. Other columns are not read.
    """
    tokens = settle(
        tokenize(docs, path).withColumn("row", F.monotonically_increasing_id()), "tokens"
    )
    order = [F.col("key"), F.col("doc_id"), F.crc32("ids"), F.col("row")]
    # Only numbers are sorted; the ids meet their place by row.
    line = tokens.select("key", "doc_id", "row", "n", F.crc32("ids").alias("crc"))
    order[2] = F.col("crc")
    placed = numbered(line, order, F.col("n")).select("row", "before")

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, ids, n, before in found:
            start = 0
            while start < n:
                at = before + start
                length = min(n - start, sequence - at % sequence)
                part = ids[2 * start : 2 * (start + length)]
                yield doc_id, start, length, part, n, at // sequence, at % sequence
                start += length

    return map_rows(tokens.join(placed, "row"), ["doc_id", "ids", "n", "before"], PIECE, rows)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32``, of the ids as 32-bit little-endian numbers, for ``ids``."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import zlib

        import numpy as np

        for *left, ids in found:
            yield *left, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = ", ".join(f"{c} long" for c in [*names, "ids_crc32"])
    return map_rows(pieces, [*names, "ids"], schema, rows)


def sequences(pieces: DataFrame, sequence: int = SEQUENCE, pad: int = 0) -> DataFrame:
    """``sequence_id`` and its ``ids``, padded to full length; a sequence is at most 2048 pieces."""
    whole = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for sequence_id, parts in found:
            ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u2").astype(np.int64)
            yield sequence_id, [*ids.tolist(), *[pad] * (sequence - len(ids))]

    return map_rows(whole, ["sequence_id", "parts"], "sequence_id long, ids array<int>", rows)

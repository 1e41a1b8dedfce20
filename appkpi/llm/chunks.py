"""Texts packed into rows of some MB, and what such chunks ask of the whole corpus.

A chunk is a row of a written table, so its number stands for the same texts in every later step.
A step that needs to know about every n-gram or window of the corpus sends one row of keys per
chunk and bucket, not one row per key, and gets its answer as one row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import map_rows, settle

CHUNK_BYTES = 1 << 20
# A null id counts as the largest number there is.
NO_ID = (1 << 63) - 1
CHUNK = (
    "chunk long, n_bytes long, ids array<long>, langs array<string>, sizes array<int>, "
    "copies array<int>, data binary"
)


def pack_texts(docs: DataFrame, most: int = CHUNK_BYTES, find_copies: bool = False) -> DataFrame:
    """The written chunks of ``docs``: ids, languages and lengths of the texts, and the texts.

    A chunk holds texts of up to ``most`` bytes, or one longer text. A null text is an empty one, and
    ``langs`` is null where ``docs`` has no such column. Other columns are not read. With ``find_copies``,
    ``copies`` has the places of the texts that a smaller doc_id has as a whole.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("id"), lang.alias("lang"), F.col("text").cast("binary").alias("text")
    )
    copy = F.lit(False)
    if find_copies:
        rows = rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
        least = settle(
            rows.where("text is not null").groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("last"))
            .where("least < last").drop("last"),
            "copied-texts",
        )
        # Spark broadcasts the copied texts' hashes if they are few, and shuffles otherwise.
        rows = rows.join(least, ["h1", "h2"], "left")
        copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    rows = rows.withColumn("copy", copy)

    def pack(found: Iterator[tuple]) -> Iterator[tuple]:
        import zstandard
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=6)
        number, size = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def flush() -> tuple:
            ids, langs, texts, copy = zip(*held, strict=True)
            return (
                number,
                size,
                list(ids),
                list(langs),
                [len(t) for t in texts],
                [k for k, c in enumerate(copy) if c],
                squeeze.compress(b"".join(texts)),
            )

        for doc_id, own, text, copied in found:
            text = text or b""
            if held and size + len(text) > most:
                yield flush()
                number, size, held = number + 1, 0, []
            held.append((doc_id, own, text, copied))
            size += len(text)
        if held:
            yield flush()

    return settle(map_rows(rows, ["id", "lang", "text", "copy"], CHUNK, pack), "chunks")


def unpack_texts(sizes: list[int], data: bytes) -> list[bytes]:
    import zstandard

    whole = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, sum(sizes)))
    texts, at = [], 0
    for size in sizes:
        texts.append(whole[at : at + size])
        at += size
    return texts


def bucket_count(chunks: DataFrame, bytes_each: int = 16 << 20) -> int:
    """Buckets for the keys of ``chunks``: one for every so many bytes of text."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return 1 + total // bytes_each


def by_bucket(keys, buckets: int) -> Iterator[tuple[int, slice, object]]:
    """Distinct 64-bit keys by bucket: number, place in the order, and the order itself."""
    import numpy as np

    of = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]

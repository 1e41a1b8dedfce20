"""SimHash near-duplicates: fingerprints of shingles, linked through pigeonring chains.

Two 64-bit fingerprints that differ in at most ``bits`` places are linked. The fingerprint is cut
into ``SEGMENTS`` segments in a ring. If the differences sum to at most t over m segments, some
segment starts a chain whose first 1, 2, 3 ... segments differ in at most t/m, 2t/m, 3t/m ... bits.
So only pairs with such a chain are looked at:

- the chain's first segment differs in t/m < 1 bits, hence is equal, and its second in at most one
  bit more, hence one half of it is equal as well. Segment and half are the key of a bucket;
- inside a bucket the chain is lengthened segment by segment, and a pair leaves when a prefix
  exceeds its budget; the full Hamming distance is taken of those that are left.

Documents with the same fingerprint are one row in all of this. A bucket of any size is compared
in blocks (``common.in_blocks``), and leaves a task as a spanning forest, not as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import Forest, by_group, components, in_blocks, map_rows, settle

SHINGLE_WORDS = 4
BITS = 4
SEGMENTS = 5
LINKS = "a long, b long"


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the SimHash of the text's word shingles, as a signed long.

    A null text and a text without words have fingerprint zero. A text of fewer words than a
    shingle has one shingle, the whole sequence. A bit on which the shingles tie is zero.
    """

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in texts:
            yield doc_id, fingerprint(text, words)

    return map_rows(docs, ["doc_id", "text"], "doc_id long, fp long", rows)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = memoryview(b" ".join(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    first = starts[: len(last)]
    hashes = np.array(
        [xxh64_intdigest(joined[a:b], 42) for a, b in zip(first.tolist(), last.tolist(), strict=True)],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def buckets(prints: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``fp`` once for each (chain start, half of the next segment), with the bits that must be equal."""
    bounds = segment_bounds(segments)

    def cut(at: int, width: int):
        return F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1)

    keys = []
    for start, (at, width) in enumerate(bounds):
        then, next_width = bounds[(start + 1) % segments]
        half = next_width // 2
        for part, (b, w) in enumerate(((then, half), (then + half, next_width - half))):
            keys.append(
                F.struct(
                    F.lit(2 * start + part).alias("chain"),
                    F.shiftleft(cut(at, width), 32).bitwiseOR(cut(b, w)).alias("bits"),
                )
            )
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.chain", "k.bits", "fp")


def link_block(fps, chain: int, bits: int = BITS, segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``fps``, as pairs of positions.

    Every pair of positions is reached by a shift of the array against itself. Pairs that are
    already in one tree are passed over; the others go along the chain, budget by budget.
    """
    import numpy as np

    forest, n = Forest(len(fps)), len(fps)
    masks, last = [], 0
    bounds, start = segment_bounds(segments), chain // 2
    for length in range(1, segments):
        at, width = bounds[(start + length - 1) % segments]
        last |= ((1 << width) - 1) << at
        masks.append((np.uint64(last), length * bits // segments))
    masks.append((np.uint64(2**64 - 1), bits))
    for shift in range(1, n):
        i = np.flatnonzero(forest.label[:-shift] != forest.label[shift:])
        differing = fps[i] ^ fps[i + shift]
        for mask, budget in masks:
            keep = np.bitwise_count(differing & mask) <= budget
            i, differing = i[keep], differing[keep]
            if not len(i):
                break
        if len(i):
            forest.add(i, i + shift)
    return forest.joined


def links(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links ``a`` - ``b`` that connect all ``fp`` within ``bits`` of each other; ``fp`` must be distinct."""
    if bits >= segments:
        raise ValueError("a chain's first segment must be equal: take more segments than bits")
    keys = ["chain", "bits"]
    cells = in_blocks(buckets(prints, segments), keys, F.xxhash64("fp"))
    # A block is compared with itself wherever it meets another block.
    cells = cells.where("cell_a < cell_b or (cell_a = 0 and block = 0)")
    group = ["chain", "bits", "cell_a", "cell_b"]
    placed = cells.repartition(*group).sortWithinPartitions(*group)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for key, members in by_group(found, 4):
            if len(members) < 2:
                continue
            fps = np.array([m[0] for m in members], np.int64)
            for a, b in link_block(fps.view(np.uint64), key[0], bits, segments):
                yield int(fps[a]), int(fps[b])

    return map_rows(placed, [*group, "fp"], LINKS, rows)


def near_duplicates(docs: DataFrame, bits: int = BITS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fingerprint`` in hex, ``component_id``: the smallest doc_id reachable by links.

    One row per row of ``docs``. Repeated rows and copies have the same fingerprint and so the same
    component. Rows with a null doc_id take part; they never name a component, which is null
    where no other member has an id. An empty table gives no rows; other columns are not read.
    """
    prints = settle(fingerprints(docs, words), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fp")
    joined = components(links(distinct.select("fp"), bits))
    member = settle(
        distinct.join(joined, distinct.fp == joined.node, "left").select(
            "fp", "least_id", F.coalesce("root", "fp").alias("root")
        ),
        "fp-roots",
    )
    named = settle(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "named")
    of_fp = settle(member.join(named, "root").select("fp", "component_id"), "fp-components")
    return prints.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, bits: int = BITS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each component left, all columns unchanged.

    The row with the smallest doc_id stays, of rows that share it the one with the smallest text.
    Null ids count as larger than any; a component of null ids alone keeps one row as well.
    """
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("h"),
        "text",
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    prints = settle(
        map_rows(
            rows,
            ["id", "h", "text"],
            "id long, h long, fp long",
            lambda found: ((i, h, fingerprint(text, words)) for i, h, text in found),
        ),
        "fingerprints",
    )
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    distinct = settle(prints.groupBy("fp").agg(F.min(rank).alias("best")), "distinct-fp")
    joined = components(links(distinct.select("fp"), bits))
    best = settle(
        distinct.join(joined, distinct.fp == joined.node, "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.id").alias("best_id"), F.col("best.h").alias("best_h")),
        "kept-rows",
    )
    chosen = rows.drop("text").join(
        best.hint("merge"), rows.id.eqNullSafe(best.best_id) & (rows.h == best.best_h), "left_semi"
    )
    # Rows equal in id and text are one document.
    return chosen.dropDuplicates(["id", "h"]).select("row.*")

"""A Merkle manifest of a dataset, stored as blocks in van Emde Boas layout.

Rows are the leaves of one tree per source, the roots of these the leaves of another. Trees are
ternary, and every one is cut into aligned subtrees of height ``HEIGHT``, the blocks. A block is one row:
its nodes lie in van Emde Boas order, so the subtree is split at half its height, the top part comes first
and then the bottom parts from left to right, each laid out the same way. Where a node lies follows from
its depth and place alone (``addresses``), for building as for reading siblings, whatever is cached.

The roots of blocks are the leaves of the next level of blocks, until one is left. Proofs go the other
way: each level hands its entries the siblings above them, so no task needs more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appkpi.llm.common import by_group, map_rows, settle

HEIGHT = 6
FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Leaves that one task puts in order.
TASK_ROWS = 200_000
BLOCK = (
    "grp string, block long, n int, height int, nodes binary, root binary, "
    "keys array<string>, changed array<binary>"
)
PATH = "grp string, block long, lefts array<binary>, rights array<binary>"


def field_digest(docs: DataFrame, text: Column | None = None) -> Column:
    """SHA-256 in hex of the fields: ``-`` for null, else UTF-8 bytes, ``:`` and the value."""

    def told(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string") if name in docs.columns else F.lit(None).cast("string")
        value = text if name == "text" and text is not None else value
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[told(name) for name in FIELDS]), 256)


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``grp`` (the source, null first), ``key``, ``id``, ``digest`` and ``changed``, a later digest of the row.

    ``changed`` is the text found later; null where the row was not looked at again.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    later = F.lit(None).cast("binary") if changed is None else F.when(
        changed.isNotNull(), F.unhex(field_digest(docs, changed))
    )
    return docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("grp"),
        F.col("doc_id").alias("id"),
        F.col("doc_id").cast("string").alias("key"),
        F.unhex(field_digest(docs)).alias("digest"),
        later.alias("changed"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, their number in ``grp`` in ascending ``order``.

    Range partitions count their groups inside the tasks. A group that goes on from an earlier partition
    is the first one of its partition, so one number per task is added.
    """
    rows = settle(rows, "merkle-rows")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS)
    keys = ["grp", *order]
    ranged = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    names = ["grp", "key", "digest", "changed"]
    schema = "grp string, key string, digest binary, changed binary, part long, inside long"

    def count(found: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part, group, inside = TaskContext.get().partitionId(), None, 0
        for row in found:
            if row[0] != group:
                group, inside = row[0], 0
            yield *row, part, inside
            inside += 1

    counted = settle(map_rows(ranged, names, schema, count), "merkle-counted")
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("grp", "part")
        .agg(F.count("*").alias("_n"))
        .select("grp", "part", F.sum("_n").over(earlier).alias("base"))
        .where("base > 0")
    )
    # At most one row per task of the range partitioning.
    return counted.join(F.broadcast(starts), ["grp", "part"], "left").select(
        *names, (F.col("inside") + F.coalesce("base", F.lit(0))).alias("place")
    )


def subtree_nodes(levels: int) -> int:
    return (FANOUT**levels - 1) // (FANOUT - 1)


def _address(depth: int, place, levels: int):
    if levels == 1:
        return place * 0
    top = levels // 2
    if depth < top:
        return _address(depth, place, top)
    bottom, width = levels - top, FANOUT ** (depth - top)
    inside = _address(depth - top, place % width, bottom)
    return subtree_nodes(top) + place // width * subtree_nodes(bottom) + inside


@lru_cache(maxsize=16)
def addresses(height: int) -> list[list[int]]:
    """Where the nodes of each depth lie, root first, in a subtree of this height."""
    import numpy as np

    return [_address(d, np.arange(FANOUT**d), height + 1).tolist() for d in range(height + 1)]


def counts(n: int, height: int) -> list[int]:
    """Nodes that exist at each depth above ``n`` leaves."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // FANOUT))
    return out[::-1]


def lay_out(digests: list[bytes], height: int) -> bytes:
    """The nodes of a subtree, 32 bytes each, in van Emde Boas order; places without a node are zero."""
    at, some = addresses(height), counts(len(digests), height)
    nodes = [b"0" * 64] * subtree_nodes(height + 1)
    for place, digest in zip(at[height], digests, strict=False):
        nodes[place] = digest.hex().encode()
    for depth in range(height - 1, -1, -1):
        below = [nodes[a] for a in at[depth + 1][: some[depth + 1]]]
        for i in range(some[depth]):
            run = b"".join(below[FANOUT * i : FANOUT * i + FANOUT])
            nodes[at[depth][i]] = sha256(run).hexdigest().encode()
    return bytes.fromhex(b"".join(nodes).decode())


def siblings(nodes: bytes, n: int, height: int) -> list[list[tuple[bytes, bytes]]]:
    """For each depth below the root, the digests in hex left and right of every node in its run."""
    at, some = addresses(height), counts(n, height)
    told = nodes.hex().encode()
    out = []
    for depth in range(1, height + 1):
        row = [told[64 * a : 64 * a + 64] for a in at[depth][: some[depth]]]
        own = []
        for i in range(len(row)):
            first = i - i % FANOUT
            own.append((b"".join(row[first:i]), b"".join(row[i + 1 : first + FANOUT])))
        out.append(own)
    return out


def blocks(entries: DataFrame, height: int) -> DataFrame:
    """The blocks over ``grp``, ``place``, ``digest`` (and ``key``, ``changed``).

    A block is raised to its full height, but for the first: if that one is not full, it is the only one.
    """
    size = FANOUT**height
    cut = entries.withColumn("block", F.expr(f"place div {size}"))
    ordered = cut.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")

    def build(found: Iterator[tuple]) -> Iterator[tuple]:
        for (grp, block), rows in by_group(found, 2):
            digests, keys, changed = (list(c) for c in zip(*rows, strict=True))
            own = height
            if not block:
                own = 0
                while FANOUT**own < len(digests):
                    own += 1
            nodes = lay_out(digests, own)
            # The root comes first in this layout.
            yield grp, block, len(digests), own, nodes, nodes[:32], keys, changed

    names = ["grp", "block", "digest", "key", "changed"]
    return settle(map_rows(ordered, names, BLOCK, build), "merkle-blocks")


def tree(entries: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Levels of blocks, from those over ``entries`` to one block per group."""
    levels = [blocks(entries, height)]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = levels[-1].select(
            "grp", F.col("block").alias("place"), F.col("root").alias("digest"),
            F.lit(None).cast("string").alias("key"), F.lit(None).cast("binary").alias("changed"),
        )
        levels.append(blocks(above, height))
    return levels


def descend(levels: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The lowest blocks with ``lefts`` and ``rights``, the siblings above them from their roots up.

    ``above``: PATH of the group's root, ``block`` being 0.
    """

    def step(found: Iterator[tuple]) -> Iterator[tuple]:
        for grp, block, n, own_height, nodes, lefts, rights in found:
            first = block * FANOUT**height
            for k, own in enumerate(entry_paths(nodes, n, own_height)):
                yield grp, first + k, [x[0] for x in own] + lefts, [x[1] for x in own] + rights

    names = ["grp", "block", "n", "height", "nodes", "lefts", "rights"]
    for level in levels[:0:-1]:
        above = settle(map_rows(level.join(above, ["grp", "block"]), names, PATH, step), "merkle-paths")
    return levels[0].join(above, ["grp", "block"])


def entry_paths(nodes: bytes, n: int, height: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """The (left, right) siblings of each leaf of a block, from the leaf to below the block's root."""
    by_depth = siblings(nodes, n, height)[::-1]
    for k in range(n):
        own = []
        for row in by_depth:
            own.append(row[k])
            k //= FANOUT
        yield own


@dataclass
class Manifest:
    """Blocks of the sources' trees, blocks of the tree over their roots, and its root in hex.

    ``root`` is null for a table without rows.
    """

    height: int
    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The trees over ``leaves``: one per source in ascending doc_id, one over the sources' roots.

    A null doc_id comes first in its source, and rows with one doc_id go by their digests.
    """
    sources = tree(placed(rows, ["id", "digest"]), height)
    roots = sources[-1].select(
        F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("grp").alias("id"),
        F.col("root").alias("digest"), F.lit(None).cast("binary").alias("changed"),
    )
    top = tree(placed(roots, ["id"]), height)
    root = top[-1].select(F.lower(F.hex("root"))).first()
    return Manifest(height, sources, top, root and root[0])


PROOF = (
    "grp string, key string, leaf string, subroot string, proof_sha256 string, folded_root string"
)


def proofs(of: Manifest) -> DataFrame:
    """Of each leaf: its digest, its source's root, the digest of its siblings up to the root, and the root
    that these siblings give with the leaf as it was found later (as it was, where it has no ``changed``)."""
    spark = of.top[0].sparkSession
    none = "cast(array() as array<binary>)"
    start = spark.range(1).selectExpr("'' grp", "0L block", f"{none} lefts", f"{none} rights")

    def of_source(found: Iterator[tuple]) -> Iterator[tuple]:
        for n, height, nodes, keys, lefts, rights in found:
            for key, own in zip(keys, entry_paths(nodes, n, height), strict=True):
                yield key, 0, [x[0] for x in own] + lefts, [x[1] for x in own] + rights

    names = ["n", "height", "nodes", "keys", "lefts", "rights"]
    above = settle(map_rows(descend(of.top, start, of.height), names, PATH, of_source), "merkle-sources")

    def fold(found: Iterator[tuple]) -> Iterator[tuple]:
        for grp, n, height, nodes, keys, changed, lefts, rights, root in found:
            at = addresses(height)[height]
            upper = list(zip(lefts, rights, strict=True))
            tail = b"".join(a + b for a, b in upper)
            for k, own in enumerate(entry_paths(nodes, n, height)):
                leaf = nodes[32 * at[k] : 32 * at[k] + 32].hex()
                told = changed[k].hex() if changed[k] else leaf
                folded = told.encode()
                for left, right in (*own, *upper):
                    folded = sha256(left + folded + right).hexdigest().encode()
                proof = sha256(b"".join(a + b for a, b in own) + tail).hexdigest()
                yield grp, keys[k], leaf, root, proof, folded.decode()

    subroots = of.sources[-1].select("grp", F.lower(F.hex("root")).alias("subroot"))
    lowest = descend(of.sources, above, of.height).join(subroots, "grp")
    names = ["grp", "n", "height", "nodes", "keys", "changed", "lefts", "rights", "subroot"]
    return map_rows(lowest, names, PROOF, fold)


def verify(docs: DataFrame, changed: Column, height: int = HEIGHT) -> DataFrame:
    """Whether each row, its text replaced by ``changed`` where that is not null, still proves to be in ``docs``.

    One row per row: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified. Null values
    are part of the digest, so a null and an empty text differ. Rows equal in all fields are leaves of their
    own. Columns beside the fields are not read, fields that ``docs`` lacks count as null.
    """
    built = manifest(leaves(docs, changed), height)
    root = F.lit(built.root)
    return proofs(built).select(
        F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).alias("source"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )

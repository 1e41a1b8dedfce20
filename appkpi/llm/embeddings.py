"""Embedding near-duplicates by cross-polytope hashing.

A vector is scaled to length 1, and turned by three rounds of random signs and a fast Hadamard
transform. Its hash is the axis, with sign, nearest to the turned vector; ``hashes`` of them make
the key of a bucket in each of ``tables`` tables. A vector lies in one bucket per table and probes
those of its next nearest axes as well. Pairs that meet are verified by cosine.

Equal vectors are one row throughout. A bucket of any size is compared in blocks. A pair that meets
in several places is counted at the first, which both vectors' keys tell without looking anything
up, so links are counted inside tasks and never listed; groups leave a task as spanning forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import Forest, by_group, components, in_blocks, map_rows, settle

LEAST_COSINE = 0.98
AXES = 4
# Rows of a block that are compared with another block at a time.
TILE = 512


def shape_for(rows: int) -> tuple[int, int]:
    """(hashes, tables): buckets stay small as the table grows, and the chance to miss a pair tiny.

    At cosine 0.98 in 64 dimensions a vector's four nearest axes hold the other's nearest one with
    chance 0.978; a pair at that very limit is missed by all tables with chance 1e-6 or less.
    """
    hashes, space = 1, 128
    while rows > space * 4096:
        hashes, space = hashes + 1, space * 128
    tables = 1
    while (1 - 0.978**hashes) ** tables > 1e-6:
        tables += 1
    return hashes, tables


def hadamard(x):
    """Fast Walsh-Hadamard transform of the rows of ``x``, scaled to keep lengths."""
    import numpy as np

    n = x.shape[1]
    h = 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def probes(unit, hashes: int, tables: int):
    """Keys of each vector: an array (vectors, tables, AXES ** hashes); the first is its own bucket's."""
    import numpy as np

    dims = 1 << max(1, (unit.shape[1] - 1).bit_length())
    padded = np.zeros((len(unit), dims))
    padded[:, : unit.shape[1]] = unit
    axes = min(AXES, dims)
    random = np.random.default_rng([5, dims])
    keys = []
    for _ in range(tables):
        near = []
        for _ in range(hashes):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * random.choice([-1.0, 1.0], dims))
            top = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :axes]
            near.append(2 * top + (np.take_along_axis(turned, top, 1) < 0))
        combined = [
            sum(near[j][:, pick[j]] * (2 * dims) ** j for j in range(hashes))
            for pick in product(range(axes), repeat=hashes)
        ]
        keys.append(np.stack(combined, axis=1))
    return np.stack(keys, axis=1).astype(np.int64)


def unit_vector(values):
    """The vector at length 1 in double precision, or None where it has no direction."""
    import numpy as np

    if values is None or len(values) == 0 or None in values:
        return None
    x = np.array(values, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt((x * x).sum())


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id) of each row.

    Vectors link where their labels are equal and not null, they have equally many components, and
    their cosine is ``least`` or more. Null, empty and zero vectors and those with null or
    non-finite components link with nothing. Rows that repeat a vector link with each other; a null
    vec_id takes part and names no component. Other columns are not read.
    """
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("string").alias("label"))
    usable = settle(map_rows(rows, ["vec_id", "label", "embedding"],
                             "vec_id long, label string, dims int, unit binary", _units), "units")
    same = ["label", "dims", "unit"]
    distinct = settle(
        usable.where("label is not null and unit is not null")
        .groupBy(*same)
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    found = settle(linked(distinct, *shape_for(distinct.count()), least), "linked")
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    others = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    member = settle(
        distinct.join(others, "node", "left")
        .join(roots, "node", "left")
        .select(
            *same, "least_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        ),
        "members",
    )
    named = settle(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "named")
    of_unit = settle(member.join(named, "root").drop("root", "least_id"), "vector-components")
    component = F.coalesce("component_id", "vec_id")
    return usable.join(of_unit, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _units(found: Iterator[tuple]) -> Iterator[tuple]:
    for vec_id, label, values in found:
        unit = unit_vector(values)
        # Adding 0 makes both zeros one.
        yield vec_id, label, None if unit is None else len(unit), None if unit is None else (unit + 0.0).tobytes()


LINKED = "node long, other long, links long"
PLACED = "label string, dims int, tab int, bucket long, own boolean, node long, copies long, unit binary, keys binary"


def linked(distinct: DataFrame, hashes: int, tables: int, least: float) -> DataFrame:
    """Rows (node, null, links): vectors linked with ``node``; and (node, other, 0): a spanning forest."""

    def place(rows: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for batch in batched(rows, 1024):
            for dims in sorted({r[1] for r in batch}):
                own = [r for r in batch if r[1] == dims]
                unit = np.frombuffer(b"".join(r[4] for r in own), np.float64).reshape(len(own), -1)
                for (label, _, node, copies, raw), keys in zip(
                    own, probes(unit, hashes, tables), strict=True
                ):
                    packed = keys.tobytes()
                    for table, near in enumerate(keys.tolist()):
                        for j, bucket in enumerate(near):
                            yield label, dims, table, bucket, j == 0, node, copies, raw, packed

    placed = map_rows(distinct, ["label", "dims", "node", "copies", "unit"], PLACED, place)
    group = ["label", "dims", "tab", "bucket"]
    cells = in_blocks(placed, group, F.xxhash64("node"))
    cell = [*group, "cell_a", "cell_b"]
    names = [*cell, "block", "own", "node", "copies", "unit", "keys"]
    together = cells.repartition(*cell).sortWithinPartitions(*cell)

    def compare(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, members in by_group(rows, 6):
            yield from compare_cell(key, members, tables, least)

    return map_rows(together, names, LINKED, compare)


def compare_cell(key: tuple, members: list[tuple], tables: int, least: float) -> Iterator[tuple]:
    """Links of one cell; pairs that met in an earlier place are verified but not counted again."""
    import numpy as np

    _, _, table, _, cell_a, cell_b = key
    if len(members) < 2 or not any(m[1] for m in members):
        return
    block, own, node, copies = (np.array([m[j] for m in members]) for j in range(4))
    unit = np.frombuffer(b"".join(m[4] for m in members), np.float64).reshape(len(members), -1)
    keys = np.frombuffer(b"".join(m[5] for m in members), np.int64).reshape(len(members), tables, -1)
    forest, links = Forest(len(members)), np.zeros(len(members), np.int64)
    for at in range(0, len(members), TILE):
        for to in range(at, len(members), TILE):
            close = unit[at : at + TILE] @ unit[to : to + TILE].T >= least
            i, j = np.nonzero(close)
            i, j = i + at, j + to
            keep = (i < j) & (own[i] | own[j]) & (node[i] != node[j])
            if cell_a != cell_b:
                keep &= block[i] != block[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            forest.add(i, j)
            # Of a pair in which each probes the other's bucket, the bucket of the smaller counts.
            mine, yours = keys[i], keys[j]
            first = np.ones(len(i), bool)
            for t in range(table):
                first &= ~(met(mine[:, t], yours[:, t]))
            both = met_at(mine[:, table], yours[:, table]) & met_at(yours[:, table], mine[:, table])
            both &= own[i] != own[j]
            smaller = np.where(node[i] < node[j], own[i], own[j])
            first &= ~both | smaller
            np.add.at(links, i[first], copies[j[first]])
            np.add.at(links, j[first], copies[i[first]])
    for at in np.flatnonzero(links).tolist():
        yield int(node[at]), None, int(links[at])
    for a, b in forest.joined:
        yield int(node[a]), int(node[b]), 0


def met_at(mine, yours):
    """Whether one probes the other's own bucket."""
    return (mine == yours[:, :1]).any(axis=1)


def met(mine, yours):
    return met_at(mine, yours) | met_at(yours, mine)

"""Labelled rows for the classifiers, which learn from all of them, a shard at a time.

A shard is some thousand rows that a hash of their ids picks, so it does not depend on where rows were.
Every shard trains a copy of the model; a grouping over all shards averages the changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import by_group, discard, map_rows, settle

# One labelled row in this many trains nothing: thresholds and probabilities are set on these.
CALIBRATION_SHARE = 5
# Weights that travel together in a row.
BLOCK = 8
# The most bits of the broadcast map of labelled ids (8 MB); with more ids it lets more other rows through.
MOST_MARKS = 1 << 26
# Changes are added up as whole numbers of this size, so that the sum depends on no order.
UNIT = 2.0**-32


def clear_labels(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """``doc_id`` and ``y`` of ids with one label; those that carry both or none are left out."""
    return (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_y"))
        .where("y = _y")
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce("lang", F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"))


def _one_per_id(found: DataFrame) -> DataFrame:
    one = F.min(F.struct(F.xxhash64("text"), "text", "lang", "y")).alias("r")
    return found.groupBy("doc_id").agg(one).select("doc_id", "r.text", "r.lang", "r.y")


def likely_labelled(docs: DataFrame, clear: DataFrame, n: int) -> DataFrame:
    """All rows of ``docs`` whose id is one of the ``n`` in ``clear``, and a few others, told by a map of hash bits.

    So the texts of the others are not shuffled for a join with ``clear``.
    """
    marks = min(MOST_MARKS, max(1 << 16, 1 << (16 * n).bit_length()))
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(marks)) + 1
    number, place = F.bitmap_bucket_number(mark), F.bitmap_bit_position(mark)
    maps = clear.groupBy(number.alias("_map")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    byte = F.expr("conv(hex(substring(_bits, CAST(_place DIV 8 AS INT) + 1, 1)), 16, 10)").cast("int")
    return (
        docs.withColumns({"_map": number, "_place": place})
        .join(F.broadcast(maps), "_map")
        .where(F.getbit(byte, F.expr("CAST(_place % 8 AS INT)")) == 1)
        .drop("_map", "_place", "_bits")
    )


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, shard_rows: int
) -> DataFrame:
    """``shard``, ``doc_id``, ``held``, ``text``, ``lang`` and ``y`` of every labelled document.

    Rows that are ``held`` are for calibration. Of the rows with one id that with the smallest hash of
    its text is taken. ``lang`` is '' where ``docs`` has none. Shards have about ``shard_rows`` rows.
    """
    clear = clear_labels(labels, label, allowed)
    n = clear.count()
    shards = max(1, -(-n // shard_rows))
    found = _one_per_id(likely_labelled(_texts(docs), clear, n).join(clear, "doc_id"))
    return found.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"),
        "doc_id",
        (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(CALIBRATION_SHARE)) == 0).alias("held"),
        "text",
        "lang",
        "y",
    )


def class_counts(rows: DataFrame) -> dict[tuple[bool, int], int]:
    """How many rows there are by ``held`` and ``y``."""
    return {(r.held, r.y): r["count"] for r in rows.groupBy("held", "y").count().collect()}


def averaged(
    rows: DataFrame,
    columns: list[str],
    width: int,
    learn: Callable[[int, list[tuple]], Iterator[tuple]],
    name: str,
) -> tuple:
    """Block numbers and, for each, the mean change over the shards that changed it.

    ``rows`` have a ``shard`` and a ``doc_id``. ``learn`` turns a shard's number and its rows of
    ``columns``, by id, into block numbers with ``width`` changes each. No block is sent by every
    shard to one task: tasks add up their shards first.
    """
    import numpy as np

    def run(found: Iterator[tuple]) -> Iterator[tuple]:
        for (shard,), own in by_group(found, 1):
            for block, changes in learn(shard, own):
                yield block, *changes

    names = [f"v{i}" for i in range(width)]
    dealt = rows.select("shard", "doc_id", *columns).repartition("shard").sortWithinPartitions("shard", "doc_id")
    schema = ", ".join(["block int", *[f"{v} long" for v in names]])
    sent = map_rows(dealt, ["shard", *columns], schema, run)
    total = settle(sent.groupBy("block").agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in names]), name)
    got = total.toArrow()
    discard(total)
    blocks = got["block"].to_numpy().astype(np.int64)
    sums = np.stack([got[v].to_numpy() for v in names], 1) if len(blocks) else np.zeros((0, width))
    return blocks, sums * UNIT / np.maximum(1, got["n"].to_numpy())[:, None]


def changed_blocks(before, after) -> Iterator[tuple]:
    """Numbers and changes, in units, of the rows of two arrays that differ."""
    import numpy as np

    changes = np.rint((after - before) / UNIT).astype(np.int64)
    blocks = np.flatnonzero(changes.any(axis=1))
    return zip(blocks.tolist(), changes[blocks].tolist(), strict=True)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int
) -> DataFrame:
    """``text``, ``lang`` and ``y`` of at most ``per_class`` labelled documents of each class, for a look.

    No model is fitted on it. The rows with the smallest hashes of their ids are taken, so the sample is the same on every
    run. Ids that carry both labels or none are left out. Of the rows with one id that with the smallest
    hash of its text is taken. ``lang`` is '' where ``docs`` has none.
    """
    clear = clear_labels(labels, label, allowed)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [clear.where(F.col("y") == y).orderBy(*by_hash).limit(per_class) for y in (0, 1)]
    # At most 2 * per_class rows of two numbers.
    return _one_per_id(_texts(docs).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id"))

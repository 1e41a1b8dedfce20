"""Keeping a latest-version table up to date from new rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from appkpi.operators.latest import keep_latest
from appkpi.sources.files import path_exists, remove_folder, write_finished
from appkpi.sources.versions import newest_version, read_version, write_version
from appkpi.streaming.landing import checkpoint_folder


def _with_current(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None,
    partition_by: str | None,
) -> DataFrame:
    """The latest versions among the batch and the days of the table that it touches."""
    new = keep_latest(batch, keys, order_by)
    if partition_by:
        # the calendar bounds this list; a literal filter prunes the other folders
        days = [r[0] for r in batch.select(partition_by).distinct().collect()]
        touched = F.col(partition_by).isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col(partition_by).isNull()
        current = current.filter(touched)
    return keep_latest(current.unionByName(new), keys, order_by)


def _stream_of(spark: SparkSession) -> str:
    """Equal over restarts of one checkpoint, another for a new one: a restart finds its own
    finished work, and a stream that begins anew cannot mistake an old one's for its own."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _merge_batch(
    batch: DataFrame,
    path: str,
    work: str,
    number: int,
    keys: Sequence[str],
    order_by: Sequence[str] | None,
    partition_by: str | None,
) -> None:
    spark = batch.sparkSession
    stream = _stream_of(spark)
    staged = f"{work}/stream={stream}/batch={number}"
    # This batch is under way, so the one before it is done for good.
    remove_folder(spark, f"{work}/stream={stream}/batch={number - 1}")
    if not write_finished(spark, staged):
        if path_exists(spark, path):
            current = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
            new = _with_current(current, batch, keys, order_by, partition_by)
        else:
            new = keep_latest(batch, keys, order_by)
        new.write.mode("overwrite").parquet(staged)
    writer = spark.read.parquet(staged).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _merge_version(
    batch: DataFrame,
    path: str,
    number: int,
    keys: Sequence[str],
    order_by: Sequence[str] | None,
    partition_by: str | None,
) -> None:
    spark = batch.sparkSession
    name = f"{_stream_of(spark)}/{number}"
    if newest_version(spark, path)[1] != name:
        new = _with_current(read_version(spark, path, batch.schema), batch, keys, order_by, partition_by)
        write_version(new, path, partition_by, name)


def stream_latest(
    rows: DataFrame,
    path: str,
    work: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    partition_by: str | None = None,
    checkpoint: str | None = None,
    versioned: bool = False,
) -> StreamingQuery:
    """Folds a stream of versions into the table at ``path`` and stops.

    Per batch: the touched days of the table and the batch's rows are reduced to the latest
    version, written to ``work``, and the finished copy replaces those days. Without
    ``partition_by`` (keys that can move between days) the whole table is replaced.

    There is no operator state to grow, and a batch may be repeated: latest-of is
    idempotent, and a run that stopped while replacing finds its finished copy in ``work``.
    Copies carry the stream's id and are removed once the next batch begins, so ``work`` may be
    shared and used again. ``partition_by`` is a day or another column of few values per batch.

    ``versioned`` tables are for readers that run meanwhile: each batch is written once, as a version
    of the days it touches, and ``read_version`` sees it whole or not at all; ``work`` is not used.
    """
    if partition_by and partition_by not in keys:
        raise ValueError(f"{partition_by!r} must be part of the key, or rows could move")
    return (
        rows.writeStream.foreachBatch(
            lambda batch, number: _merge_version(batch, path, number, keys, order_by, partition_by)
            if versioned
            else _merge_batch(batch, path, work, number, keys, order_by, partition_by)
        )
        .option(
            "checkpointLocation",
            checkpoint or checkpoint_folder(rows.sparkSession, f"latest{path}"),
        )
        .trigger(availableNow=True)
        .start()
    )

"""Landing only the files that have not been landed yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from appkpi.operators.latest import LANDED_ROW
from appkpi.sources.files import path_exists
from appkpi.sources.landing import INGEST_DAY, STREAM_BATCH, Load, blank_for_null, stamp


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A stream's progress folder, in the shared folder the cluster names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; pass a checkpoint folder")
    return f"{root.rstrip('/')}/{name}"


def _land_batch(batch: DataFrame, path: str, number: int) -> None:
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    (
        batch.withColumn(INGEST_DAY, F.to_date("_ingested_at"))
        .withColumn(STREAM_BATCH, F.lit(f"{stream}-{number}"))
        .withColumn(LANDED_ROW, F.monotonically_increasing_id())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGEST_DAY, STREAM_BATCH)
        .parquet(path)
    )


def stream_csv_to_raw(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    path: str,
    load: Load,
    checkpoint: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Appends the new CSV files of ``folder`` to a raw table and stops.

    The checkpoint remembers the files. Each batch has a folder of its own below its day, named by stream and
    batch, and its load time is kept with its progress: a batch that is repeated after a failure replaces
    what it had written, so no file is missed or landed twice. Rows are numbered within the batch as
    ``append_raw`` numbers them, so ties settle alike. Such a table is written by streams only.
    """
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} was written by a file sink, whose list of files hides others; land into a new table")
    schema = StructType([StructField(c, StringType()) for c in columns])
    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder, header=True, enforceSchema=False, multiLine=True, quote='"', escape='"')
    )
    stamped = stamp(blank_for_null(files), load).withColumn(
        "_ingested_at", F.current_timestamp()
    )
    return (
        stamped.writeStream.foreachBatch(lambda batch, number: _land_batch(batch, path, number))
        .option("checkpointLocation", checkpoint or checkpoint_folder(spark, f"land{path}"))
        .trigger(availableNow=True)
        .start()
    )

"""Tables that are replaced while they are read.

``path/version=N`` holds what write N made, with a folder per day if the table has days. A small
list, ``path/_versions/N``, names the folders that make up the table as of write N; it appears in
one step, once they are complete. Readers take the newest list, so they see a write whole or not
at all, and days that a write doesn't touch stay where they are. The last ``KEEP`` lists and their
folders remain: a reader loses its files only if it runs through as many writes.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from appkpi.sources.files import first_bytes, folder_names, path_exists, remove_folder

KEEP = 2
# A list has a line per day, so that many days' names fit.
LIST_BYTES = 1 << 26


def _lists(spark: SparkSession, path: str) -> list[int]:
    folder = f"{path}/_versions"
    names = folder_names(spark, folder) if path_exists(spark, folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def _list(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(first_bytes(spark, f"{path}/_versions/{number:010d}", LIST_BYTES))


def newest_version(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number of the newest write, 0 if there is none, and the name its writer gave it."""
    numbers = _lists(spark, path)
    return (numbers[-1], _list(spark, path, numbers[-1])["name"]) if numbers else (0, None)


def read_version(spark: SparkSession, path: str, schema: StructType, number: int | None = None) -> DataFrame:
    """The table as of its newest write, or of an earlier one that is kept; without writes it has no rows."""
    numbers = _lists(spark, path)
    if not numbers:
        return spark.createDataFrame([], schema)
    folders = _list(spark, path, numbers[-1] if number is None else number)["folders"]
    paths = [f"{path}/version={n}/{day}".rstrip("/") for day, n in folders.items()]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.fieldNames())


def write_version(
    df: DataFrame, path: str, partition_by: str | None = None, name: str | None = None, keep: int = KEEP
) -> int:
    """Replaces the table, or with ``partition_by`` the days that ``df`` has, and returns the write's number.

    ``df`` may read the table itself. A write that stopped halfway left nothing that readers see;
    repeating it is safe. Of two writes at the same time one fails and changes nothing.
    """
    spark = df.sparkSession
    numbers = _lists(spark, path)
    last = numbers[-1] if numbers else 0
    number, folder = last + 1, f"{path}/version={last + 1}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    if partition_by:
        folders = _list(spark, path, last)["folders"] if last else {}
        days = [d for d in folder_names(spark, folder) if d.startswith(f"{partition_by}=")]
        folders |= dict.fromkeys(days, number)
    else:
        folders = {"": number}
    _publish(spark, path, number, json.dumps({"name": name, "folders": folders}))
    _remove_old(spark, path, [*numbers, number], keep)
    return number


def _publish(spark: SparkSession, path: str, number: int, text: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target, draft = hadoop(f"{path}/_versions/{number:010d}"), hadoop(f"{path}/_versions/draft-{number}")
    storage = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = storage.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if storage.exists(target) or not storage.rename(draft, target):
        raise RuntimeError(f"another writer has published version {number} of {path}")


def _remove_old(spark: SparkSession, path: str, numbers: list[int], keep: int) -> None:
    """Removes all but the last ``keep`` lists, and the folders that only those name."""
    old, kept = numbers[:-keep], numbers[-keep:]
    used = {(n, day) for k in kept for day, n in _list(spark, path, k)["folders"].items()}
    for k in old:
        for day, n in _list(spark, path, k)["folders"].items():
            if (n, day) not in used:
                remove_folder(spark, f"{path}/version={n}/{day}".rstrip("/"))
        remove_folder(spark, f"{path}/_versions/{k:010d}")

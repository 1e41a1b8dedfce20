"""Landing: report files become append-only raw tables whose source columns are all text.

Nothing is typed or rejected here, so no value is lost; typing is the staging tables' job.
Empty cells are landed as ``''`` and not as NULL, because ``''`` keys match in the joins
downstream and NULL keys do not.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from appkpi.operators.latest import LANDED_ROW
from appkpi.sources.files import first_line, path_exists, remove_empty

log = logging.getLogger(__name__)

INGEST_DAY = "_ingest_date"
# Folder below the day in tables that a stream writes: the stream and its batch.
STREAM_BATCH = "_stream_batch"
# Files whose headers are looked up at the same time.
HEADER_THREADS = 16
METADATA = {
    "_ingested_at": "timestamp",
    "_source": "string",
    "_app_id": "string",
    "_platform": "string",
    "_run_id": "string",
    "_extract_from": "date",
    "_extract_to": "date",
}


@dataclass(frozen=True)
class Load:
    """What is known about one load. Time and run id are set once, on the driver."""

    source: str
    extract_from: date
    extract_to: date
    app_id: str = ""
    platform: str = ""
    ingested_at: datetime = field(default_factory=lambda: datetime.now(UTC))
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))


# ---- headers -------------------------------------------------------------------------


def snake_case(header: str, slash: bool = False) -> str:
    """Header to column name. Monthly statistics files also map ``/``."""
    name = header.strip().lower().replace(" ", "_").replace("-", "_")
    return name.replace("/", "_") if slash else name


def snake_headers(df: DataFrame, slash: bool = False) -> DataFrame:
    return df.toDF(*[snake_case(c, slash) for c in df.columns])


def files_by_header(
    spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8"
) -> list[list[str]]:
    """File names grouped by their header line; files without one are left out.

    Of each file only the beginning is opened, several files at a time; the names are those that
    the driver lists for any read. So the content is read once, by the load itself.
    """
    files = sorted(unquote(name) for name in spark.read.text(paths).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for name, line in zip(files, pool.map(lambda f: first_line(spark, f, encoding), files), strict=True):
            if line:
                groups.setdefault(line, []).append(name)
    return [groups[line] for line in sorted(groups)]


def _read_by_header(
    spark: SparkSession,
    paths: str | Sequence[str],
    read: Callable[..., DataFrame],
    encoding: str = "UTF-8",
) -> DataFrame:
    frames = [read(group) for group in files_by_header(spark, paths, encoding)]
    if not frames:  # no file has a line
        return spark.createDataFrame([], StructType())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---- readers -------------------------------------------------------------------------


def blank_for_null(df: DataFrame) -> DataFrame:
    """Spark reads an empty cell as NULL; the raw contract is the empty string."""
    return df.na.fill("")


def read_csv_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "UTF-8",
    mixed_headers: bool = False,
    file_column: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, kept verbatim: quoted commas and newlines, optional byte-order mark.

    A file whose header differs from the first one's fails the read instead of shifting
    its columns; ``mixed_headers=True`` reads each group of equal headers by itself.
    ``file_column`` adds the name of the file a row comes from. With ``multi_line=False``, for
    files without line ends inside cells, a large file is read in splits.
    """

    def read(files: str | Sequence[str]) -> DataFrame:
        df = spark.read.csv(
            files,
            header=True,
            inferSchema=False,
            enforceSchema=False,
            multiLine=multi_line,
            quote='"',
            escape='"',
            encoding=encoding,
        )
        return df.withColumn(file_column, F.col("_metadata.file_path")) if file_column else df

    df = _read_by_header(spark, paths, read, encoding) if mixed_headers else read(paths)
    return blank_for_null(df)


def read_tsv_report(
    spark: SparkSession, paths: str | Sequence[str], mixed_headers: bool = False
) -> DataFrame:
    """Tab-separated text, plain or gzip. Tabs split, nothing quotes; short rows are padded.

    A gzip file is read by one task whatever its size; the rebalancing write of
    :func:`append_raw` evens the pieces out.
    """

    def read(files: str | Sequence[str]) -> DataFrame:
        df = spark.read.csv(
            files,
            sep="\t",
            header=True,
            inferSchema=False,
            enforceSchema=False,
            quote="",
            escape="",
        )
        return snake_headers(df)

    df = _read_by_header(spark, paths, read) if mixed_headers else read(paths)
    return blank_for_null(df)


def read_json_rows(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Iterable[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """JSON objects, one row each, every top-level value as text; nested values as JSON text.

    Without ``columns`` the union of the top-level keys is found by an extra pass, sorted.
    ``multi_line=False`` reads one object per line, in splits.
    """
    if columns is None:
        probe = spark.read.json(paths, multiLine=multi_line, primitivesAsString=True)
        columns = sorted(probe.columns)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return blank_for_null(spark.read.json(paths, schema=schema, multiLine=multi_line))


# ---- stamp, align, append ------------------------------------------------------------


def stamp(df: DataFrame, load: Load) -> DataFrame:
    """Adds the seven load columns, constant over the load."""
    return df.withColumns(
        {
            "_ingested_at": F.lit(load.ingested_at).cast("timestamp"),
            "_source": F.lit(load.source),
            "_app_id": F.lit(load.app_id),
            "_platform": F.lit(load.platform),
            "_run_id": F.lit(load.run_id),
            "_extract_from": F.lit(load.extract_from).cast("date"),
            "_extract_to": F.lit(load.extract_to).cast("date"),
        }
    )


def align_to_table(df: DataFrame, table_columns: Sequence[str]) -> DataFrame:
    """The table's columns only: unknown ones are dropped, missing ones are NULL.

    Names match without regard to case, as everywhere in the engine.
    """
    have = {c.lower(): c for c in df.columns}
    known = {c.lower() for c in table_columns}
    dropped = sorted(c for c in df.columns if c.lower() not in known)
    if dropped:
        log.warning("dropping columns the table does not have: %s", dropped)
    return df.select(
        *[
            F.col(f"`{have[c.lower()]}`").alias(c)
            if c.lower() in have
            else F.lit(None).cast(METADATA.get(c, "string")).alias(c)
            for c in table_columns
        ]
    )


def table_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Columns of an existing raw table, or None if there is none yet."""
    if not path_exists(spark, path):
        return None
    try:
        stored = spark.read.parquet(path).columns
        return [c for c in stored if c not in (INGEST_DAY, STREAM_BATCH, LANDED_ROW)]
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any file
            return None
        raise


def append_raw(df: DataFrame, path: str) -> int:
    """Appends stamped rows to a raw table, one folder per load day; returns the row count.

    Rows are numbered as they are written: the number settles ties between versions of a key.

    The count is observed during the write, so the input is read once. Rows are rebalanced
    before it: thousands of small report files and single unsplittable ones both end up as
    files of the advisory size.
    """
    counted = Observation()
    (
        df.withColumn(INGEST_DAY, F.to_date("_ingested_at"))
        .withColumn(LANDED_ROW, F.monotonically_increasing_id())
        .hint("rebalance")
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy(INGEST_DAY)
        .parquet(path)
    )
    return counted.get["rows"]


def land(df: DataFrame, path: str, load: Load) -> int:
    """Stamp, align to the table if it exists, append. An input without rows writes nothing.

    The input is read once: the rows are counted as they are written, and a write of no rows leaves
    no file but the mark of its end, which goes as well if the table was not there before.
    """
    stamped = stamp(df, load)
    existing = table_columns(df.sparkSession, path)
    if existing is not None:
        stamped = align_to_table(stamped, existing)
    rows = append_raw(stamped, path)
    if not rows:
        log.warning("no rows for %s, nothing written", path)
        if existing is None:
            remove_empty(df.sparkSession, path)
    return rows


def land_many(jobs: Sequence[tuple[str, Callable[[], int]]]) -> dict[str, int]:
    """Runs every landing job; one bad input does not stop the others, all are reported.

    The jobs are driver-side closures over :func:`land`; the rows stay on the executors.
    """
    done: dict[str, int] = {}
    failed: list[str] = []
    for name, job in jobs:
        try:
            done[name] = job()
        except Exception as error:  # reported below, together
            log.error("%s failed: %s", name, error)
            failed.append(name)
    if failed:
        raise RuntimeError(f"landing failed for {len(failed)} of {len(jobs)} input(s): {failed}")
    return done

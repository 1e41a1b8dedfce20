"""Monthly store statistics: one CSV per report and month, UTF-16 or UTF-8."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.operators.combine import union_branches
from appkpi.operators.date_windows import in_date_range, months_between_dates
from appkpi.sources.files import first_bytes, path_exists
from appkpi.sources.landing import read_csv_report, snake_headers

log = logging.getLogger(__name__)

# Fixed values: (folder, file suffix, raw table).
MONTHLY_REPORTS = (
    ("stats/installs", "overview", "raw_gcs_installs"),
    ("stats/crashes", "overview", "raw_gcs_crashes"),
    ("stats/store_performance", "country", "raw_gcs_store_performance_country"),
    ("stats/store_performance", "traffic_source", "raw_gcs_store_performance_traffic"),
)
MONTHLY_SOURCE = "play_console_gcs"
UTF16_MARKS = (b"\xff\xfe", b"\xfe\xff")
# A header line lies within this many bytes of a file.
HEADER_BYTES = 1 << 16


def expected_months(
    spark: SparkSession, folder: str, suffix: str, package: str, date_from: date, date_to: date
) -> DataFrame:
    """Every month of the range with its file, encoding and header; NULL path if missing.

    Files are asked for by name, one a month, so other months and packages are neither listed nor
    opened, and of a file only the beginning is read.
    """
    report = folder.rstrip("/").split("/")[-1]
    found = []
    for row in months_between_dates(spark, date_from, date_to).collect():
        path = f"{folder.rstrip('/')}/{report}_{package}_{row['month']}_{suffix}.csv"
        if not path_exists(spark, path):
            found.append((row["month"], None, None, None))
            continue
        begin = first_bytes(spark, path, HEADER_BYTES)
        utf16 = begin[:2] in UTF16_MARKS
        text = begin.decode("utf-16" if utf16 else "utf-8", "ignore")
        found.append((row["month"], path, utf16, text.split("\n")[0]))
    return spark.createDataFrame(found, "month string, path string, utf16 boolean, header string")


def read_monthly_stats(
    spark: SparkSession, folder: str, suffix: str, package: str, date_from: date, date_to: date
) -> DataFrame | None:
    """Rows of one report in the range, for one package; None if no month has a file.

    What comes to the driver is the header of each month of the range. Files are read in groups
    of equal encoding and header, so that a column added in some month does not shift the
    others.
    """
    months = expected_months(spark, folder, suffix, package, date_from, date_to).collect()
    for missing in sorted(m["month"] for m in months if m["path"] is None):
        log.warning("no %s %s file for %s", folder, suffix, missing)
    groups: dict[tuple[bool, str], list[str]] = {}
    for m in months:
        if m["path"] is not None:
            groups.setdefault((m["utf16"], m["header"]), []).append(m["path"])
    if not groups:
        return None
    frames = []
    for (utf16, _), paths in sorted(groups.items()):
        encoding = "UTF-16" if utf16 else "UTF-8"
        df = read_csv_report(spark, sorted(paths), encoding, file_column="_gcs_blob")
        frames.append(snake_headers(df, slash=True))
    columns = {c: None for frame in frames for c in frame.columns}
    rows = union_branches(*[_fill_columns(frame, list(columns)) for frame in frames])
    return rows.filter(F.col("package_name") == F.lit(package)).filter(
        in_date_range("date", date_from.isoformat(), date_to.isoformat())
    )


def _fill_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(
        *[F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in columns]
    )

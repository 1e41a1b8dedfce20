"""Data tests on a table.

All row-level tests of a table are one aggregate over one scan; a uniqueness test is one
grouping each. A report row says how many rows (or keys) break the test.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    breaks: Callable[[], Column] | None = None  # None: a uniqueness test
    severity: str = ERROR
    sql: str = ""  # what ``breaks`` tests, as plain SQL

    @property
    def label(self) -> str:
        return f"{self.kind}:{','.join(self.columns)}"

    def warn(self) -> Check:
        """The same test, reported without failing the build."""
        return replace(self, severity=WARN)


def not_null(column: str) -> Check:
    return Check("not_null", (column,), lambda: F.col(column).isNull(), sql=f"{column} IS NULL")


def unique(*columns: str) -> Check:
    """One column: NULLs are ignored. Several: NULL counts as a value."""
    return Check("unique" if len(columns) == 1 else "unique_combination", columns)


def accepted_values(column: str, values: Sequence[object]) -> Check:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return Check(
        "accepted_values",
        (column,),
        lambda: ~F.col(column).isin(*values),
        sql=f"{column} NOT IN ({listed})",
    )


def accepted_range(
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
) -> Check:
    """NULL passes."""

    def breaks() -> Column:
        c = F.col(column)
        tests = []
        if low is not None:
            tests.append(c < low if inclusive else c <= low)
        if high is not None:
            tests.append(c > high if inclusive else c >= high)
        return reduce(lambda a, b: a | b, tests)

    equal = "" if inclusive else "="
    limits = [f"{column} <{equal} {low}"] if low is not None else []
    limits += [f"{column} >{equal} {high}"] if high is not None else []
    return Check("accepted_range", (column,), breaks, sql=" OR ".join(limits))


def is_true(column: str, condition: str) -> Check:
    """``condition`` completes the column, as in ``is_true("cost", ">= 0")``; NULL passes."""
    return Check(
        "expression_is_true",
        (column,),
        lambda: ~F.expr(f"`{column}` {condition}"),
        sql=f"NOT ({column} {condition})",
    )


REPORT = ("table", "test", "columns", "severity", "failures", "status")


def _report_row(table: str, check: Check, failures: Column) -> list[Column]:
    failed = failures > 0
    status = F.when(failed, F.lit("warn" if check.severity == WARN else "fail")).otherwise("pass")
    return [
        F.lit(table).alias("table"),
        F.lit(check.kind).alias("test"),
        F.lit(",".join(check.columns)).alias("columns"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        status.alias("status"),
    ]


def _row_tests(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(
        *[F.count_if(c.breaks()).alias(f"t{i}") for i, c in enumerate(checks)]
    )
    rows = [
        F.struct(*_report_row(table, c, F.col(f"t{i}"))) for i, c in enumerate(checks)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _unique_test(df: DataFrame, table: str, check: Check) -> DataFrame:
    keys = df.select(*check.columns)
    if len(check.columns) == 1:
        keys = keys.filter(F.col(check.columns[0]).isNotNull())
    repeated = keys.groupBy(*check.columns).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        *_report_row(table, check, F.col("n"))
    )


def quality_report(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per test: table, test, columns, severity, failures, status."""
    row_tests = [c for c in checks if c.breaks is not None]
    parts = [_row_tests(df, table, row_tests)] if row_tests else []
    parts += [_unique_test(df, table, c) for c in checks if c.breaks is None]
    if not parts:
        raise ValueError(f"no tests for {table}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def raise_on_errors(report: DataFrame) -> None:
    """Fails if a test of severity ``error`` failed. The report has a row per test."""
    failed = report.filter(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r['table']}.{r['columns']} {r['test']}: {r['failures']}" for r in failed]
        raise RuntimeError(f"{len(failed)} data test(s) failed: " + "; ".join(sorted(lines)))

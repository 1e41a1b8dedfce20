"""Building tables, lazily or stored."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from appkpi.plans.catalog import SEED, TABLES, needed, raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.quality import freshness_report, quality_report, raise_on_errors
from appkpi.quality.expectations import EXPECTATIONS, FRESHNESS
from appkpi.quality.freshness import newest_loads
from appkpi.session import require_utc
from appkpi.sources.files import path_exists
from appkpi.sources.landing import land_many
from appkpi.sources.seeds import event_mapping
from appkpi.sources.tables import publish_view, read_raw, read_table, write_table


def table(name: str, raw: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """One table as a lazy plan over the raw tables; Catalyst sees the whole chain."""
    if name in raw:
        return raw[name]
    if name == SEED:
        return event_mapping(spark)
    spec = TABLES[name]
    return spec.build(*[table(i, raw, spark) for i in spec.inputs])


def build_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    mapping: DataFrame | None = None,
    names: Sequence[str] | None = None,
    day_folders: bool = True,
) -> dict[str, DataFrame]:
    """Full refresh of every table (or ``names`` and what they read) under ``root``, published as views too.

    ``day_folders=False`` stores a copy that is read whole, as data tests read it. Its rows stay where the
    grouping or window before them put them: adaptive execution has packed small parts there already.

    Stored tables are read back by their readers, so a lost executor costs the tasks of
    the table being written and not the chain behind it.
    """
    require_utc(spark)
    lookup = event_mapping(spark) if mapping is None else mapping
    done = {SEED: publish_view(lookup, SEED)}
    for name in needed(names):
        spec = TABLES[name]
        df = spec.build(*[done[i] if i in done else raw[i] for i in spec.inputs])
        if spec.stored:
            path = f"{root}/{name}"
            if day_folders:
                write_table(df, path, spec.partition_by, spec.cluster_by)
            else:
                df.write.mode("overwrite").parquet(path)
            df = read_table(spark, path, df.schema)
        done[name] = publish_view(df, name)
    return done


def run_data_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The data tests of every table in ``tables``, one report.

    Give stored tables: each test then reads its columns, and none repeats the plan behind the table.
    """
    reports = [
        quality_report(df, name, EXPECTATIONS[name])
        for name, df in tables.items()
        if name in EXPECTATIONS
    ]
    return reduce(lambda a, b: a.unionByName(b), reports)


def refresh(
    spark: SparkSession,
    raw_root: str,
    table_root: str,
    as_of: datetime,
    landing: Sequence[tuple[str, Callable[[], int]]] = (),
) -> dict[str, DataFrame]:
    """A whole run: land, build, test. Raw tables lie at ``raw_root/<dataset>/<table>``.

    Returns the tables with two more, ``data_tests`` and ``freshness``. A failed landing job
    or a failed test of severity error raises, the latter after everything is built.
    """
    require_utc(spark)
    land_many(landing)

    def path(name: str) -> str:
        return f"{raw_root}/{name.replace('.', '/')}"

    raw = {name: read_raw(spark, path(name)) for name in map(raw_name, CONTRACTS)}
    tables = build_all(spark, raw, table_root)
    write_table(run_data_tests(tables), f"{table_root}/data_tests")
    tests = read_table(spark, f"{table_root}/data_tests")
    raise_on_errors(tests)
    # landed tables that no table reads have an age as well
    unread = [n for n in FRESHNESS if n not in raw and path_exists(spark, path(n))]
    landed = {n: newest_loads(spark, path(n)) for n in [*raw, *unread]}
    ages = freshness_report(landed, FRESHNESS, as_of)
    return {**tables, "data_tests": tests, "freshness": ages}

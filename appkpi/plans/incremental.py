"""Refreshing stored tables from new loads alone.

A run finds the loads that no earlier run has folded in, folds them into the staging tables, and passes
the days they touch on from table to table. Of every table only those days are read, computed and
replaced; other days' files stay as they are. A table whose rows can move between days (a review changes
its date), or that has no days, is built anew, and so are the tables that read it.

Loads count as done when every table is. A run that stops before finds them again and ends in the same
state, because folding a load twice changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.operators.latest import INGESTED_AT, LANDED_ROW, RUN_ID
from appkpi.operators.retention import OFFSETS
from appkpi.plans.catalog import SEED, TABLES, Table, needed, raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.plans.staging import latest_typed, stage_in_app_events, typed, with_extras
from appkpi.session import require_utc
from appkpi.sources.files import path_exists, remove_folder, write_finished
from appkpi.sources.landing import INGEST_DAY, STREAM_BATCH
from appkpi.sources.seeds import event_mapping
from appkpi.sources.tables import read_raw, write_table

EVENTS = "stg_appsflyer_in_app_events"
# Loads that arrive this many days after a later one are still found.
LATE_DAYS = 2
# Days of a table that depend on a day of its input: the input's day less each of these.
DAYS_BACK: dict[tuple[str, str], tuple[int, ...]] = {("mart_appsflyer_retention", EVENTS): OFFSETS}


@dataclass
class Days:
    """Days of a table that may have changed; ``all`` if any may. None is the folder of rows without a day."""

    days: set[date | None] = field(default_factory=set)
    all: bool = False

    def __bool__(self) -> bool:
        return self.all or bool(self.days)

    def add(self, other: Days, back: Iterable[int] = (0,)) -> None:
        self.all = self.all or other.all
        for day in other.days:
            self.days |= {None if day is None else day - timedelta(n) for n in back}

    def test(self, column: str, ahead: Iterable[int] = (0,)) -> Column:
        """Whether ``column`` is one of the days, as literals that prune folders."""
        wanted = {d + timedelta(n) for d in self.days if d is not None for n in ahead}
        found = F.col(column).isin(sorted(wanted))
        return found | F.col(column).isNull() if None in self.days else found


def day_column(name: str) -> str | None:
    """The column by whose days a table is refreshed."""
    return "event_date" if name == EVENTS else TABLES[name].partition_by if name in TABLES else None


# ---- loads ---------------------------------------------------------------------------


def new_loads(spark: SparkSession, raw_path: str, done_path: str, late_days: int = LATE_DAYS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the loads not done yet, and those loads, or None if there are none.

    Only the folders from ``late_days`` before the newest load that is done are read.
    """
    raw = spark.read.parquet(raw_path)
    if path_exists(spark, done_path):
        done = spark.read.parquet(done_path)
        newest = done.agg(F.max(F.to_date(INGESTED_AT))).first()[0]
        if newest is not None:
            raw = raw.filter(F.col(INGEST_DAY) >= F.lit(newest - timedelta(late_days)))
            recent = done.filter(F.to_date(INGESTED_AT) >= F.lit(newest - timedelta(late_days)))
            same = (raw[INGESTED_AT].eqNullSafe(recent[INGESTED_AT])) & raw[RUN_ID].eqNullSafe(recent[RUN_ID])
            raw = raw.join(recent, same, "left_anti")
    # one row a load
    loads = raw.select(INGESTED_AT, RUN_ID).distinct()
    found = loads.collect()
    if not found:
        return raw, None
    return raw.drop(INGEST_DAY, STREAM_BATCH), spark.createDataFrame(found, loads.schema)


def _load_key(loads: DataFrame) -> str:
    """Names a set of loads: a repeated run finds what it had finished."""
    rows = sorted(str(tuple(r)) for r in loads.collect())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:24]


# ---- folding and replacing -----------------------------------------------------------


def touched_days(rows: DataFrame, column: str | None) -> Days:
    """The days of ``rows``; the calendar bounds what comes to the driver."""
    if column is None:
        return Days(all=True)
    return Days({r[0] for r in rows.select(column).distinct().collect()})


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def replace_days(staged: DataFrame, path: str, spec: Table) -> None:
    """Puts finished rows in place of the days that they hold."""
    order = [c for c in spec.cluster_by if c != spec.partition_by]
    (
        staged.hint("rebalance", spec.partition_by)
        .sortWithinPartitions(spec.partition_by, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(spec.partition_by)
        .parquet(path)
    )


def fold(spark: SparkSession, name: str, rows: DataFrame, path: str, staged: str) -> Days:
    """Folds new raw rows into a staging table with a key; the days that changed.

    The days' latest versions are computed from the stored rows and the new ones. They are written to
    ``staged`` first: whatever happens while the table is replaced, the finished copy is there.
    """
    spec = TABLES[name]
    new = typed(rows, name)
    days = touched_days(new, spec.partition_by)
    if not write_finished(spark, staged):
        current = _stored(spark, path)
        if current is not None:
            kept = current if days.all else current.filter(days.test(spec.partition_by))
            new = kept.select(*[c for c in new.columns if c in kept.columns]).unionByName(new, allowMissingColumns=True)
        with_extras(latest_typed(new, name), name).write.mode("overwrite").parquet(staged)
    finished = spark.read.parquet(staged)
    if spec.partition_by:
        replace_days(finished, path, spec)
    else:
        write_table(finished, path, None, spec.cluster_by)
    return days


def changed_days(name: str, changed: Mapping[str, Days]) -> Days:
    """The days of a table that follow from those of its inputs."""
    out = Days()
    for i in TABLES[name].inputs:
        if i not in changed:
            continue
        if changed[i] and (TABLES[name].partition_by is None or day_column(i) is None):
            out.all = True
        out.add(changed[i], DAYS_BACK.get((name, i), (0,)))
    return out


def rebuild(name: str, days: Days, inputs: Mapping[str, DataFrame], path: str) -> None:
    """Computes and replaces ``days`` of a table from those days of its inputs, or the whole table."""
    spec = TABLES[name]
    if days.all:
        write_table(spec.build(*[inputs[i] for i in spec.inputs]), path, spec.partition_by, spec.cluster_by)
        return
    cut = []
    for i in spec.inputs:
        column = day_column(i)
        ahead = DAYS_BACK.get((name, i), (0,))
        cut.append(inputs[i] if column is None else inputs[i].filter(days.test(column, ahead)))
    replace_days(spec.build(*cut).filter(days.test(spec.partition_by)), path, spec)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(LANDED_ROW)


def refresh_new_loads(
    spark: SparkSession,
    raw_root: str,
    table_root: str,
    names: Sequence[str] | None = None,
    mapping: DataFrame | None = None,
    late_days: int = LATE_DAYS,
) -> tuple[dict[str, DataFrame], dict[str, Days]]:
    """The tables (all, or ``names`` and what they read) after folding in every new load, and what changed.

    Raw tables lie at ``raw_root/<dataset>/<table>``, as ``append_raw`` stores them. The result equals a full
    refresh. A raw table that is not there yet leaves the tables that read it out. ``_done`` and ``_staged``
    below ``table_root`` keep the loads that are done and finished copies.
    """
    require_utc(spark)
    lookup = event_mapping(spark) if mapping is None else mapping
    tables: dict[str, DataFrame] = {SEED: lookup}
    changed: dict[str, Days] = {}
    pending: list[tuple[str, DataFrame, str]] = []
    for name in needed(names):
        spec, path = TABLES[name], f"{table_root}/{name}"
        if name in CONTRACTS:
            raw_path = f"{raw_root}/{raw_name(name).replace('.', '/')}"
            if not path_exists(spark, raw_path):
                continue
            done = f"{table_root}/_done/{name}"
            rows, loads = new_loads(spark, raw_path, done, late_days)
            if loads is not None:
                staged = f"{table_root}/_staged/{name}-{_load_key(loads)}"
                pending.append((done, loads, staged))
                if name == EVENTS:
                    changed[name] = touched_days(typed(rows, name), day_column(name))
                else:
                    changed[name] = fold(spark, name, rows, path, staged)
            if name == EVENTS:
                tables[name] = stage_in_app_events(read_raw(spark, raw_path), lookup)
            else:
                tables[name] = _read(spark, path)
            continue
        if any(i not in tables for i in spec.inputs):
            continue
        days = changed_days(name, changed)
        if not path_exists(spark, path):
            days.all = True
        if days:
            changed[name] = days
            rebuild(name, days, tables, path)
        tables[name] = _read(spark, path)
    for done, loads, staged in pending:
        loads.coalesce(1).write.mode("append").parquet(done)
        remove_folder(spark, staged)
    return tables, changed

"""Latest version per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

INGESTED_AT = "_ingested_at"
RUN_ID = "_run_id"
# Numbers the rows of a load once they are stored, so that reruns see the same order.
LANDED_ROW = "_landed_row"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    tie_break: Sequence[str] | None = None,
    sort_by_hash: bool = False,
) -> DataFrame:
    """One row per key: the one loaded last. NULL keys form a group of their own.

    All rows of one load carry the same load time, so two rows of a load can share a key.
    The default order settles those ties the same way on every run: run id, then the row's
    stored number. Rows that were stored without one go by a hash of the ``tie_break``
    columns, by default of the whole row. ``order_by`` replaces the order with SQL sort
    expressions such as ``"ts DESC"``.

    Spark turns ``row_number() = 1`` into a per-key limit on both sides of the shuffle, so
    a key that holds a large share of the rows sends one row per map task, not all of them.

    That limit sorts every row. ``sort_by_hash`` puts a hash of the keys first, which settles
    most comparisons by Spark's eight-byte sort prefix without a look at the rows. The result is
    then spread by hash and keys: a grouping on the keys that follows needs a shuffle of its own.
    """
    if order_by is None:
        order_by = [f"{INGESTED_AT} DESC"]
        if RUN_ID in df.columns:
            order_by.append(f"{RUN_ID} DESC")
        hashed = df.columns if tie_break is None else tie_break
        if LANDED_ROW in df.columns:
            # one narrow column: readers of few columns parse few
            order_by.append(f"{LANDED_ROW} DESC")
        elif hashed:
            order_by.append(f"xxhash64({_names(hashed)}) DESC")
    group = f"xxhash64({_names(keys)}), {_names(keys)}" if sort_by_hash else _names(keys)
    version = f"row_number() OVER (PARTITION BY {group} ORDER BY {', '.join(order_by)})"
    return (
        df.selectExpr("*", f"{version} AS __version").filter("__version = 1").drop("__version")
    )


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)

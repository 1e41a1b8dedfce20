from __future__ import annotations

import sys
import uuid
from datetime import UTC, date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from appkpi.session import get_spark  # noqa: E402
from appkpi.sources.landing import METADATA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "appkpi-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def raw(spark):
    """Raw rows from dicts: text columns, and load columns with defaults."""

    def build(rows: list[dict], columns: list[str] | None = None):
        own = columns or list(
            dict.fromkeys(k for r in rows for k in r if k not in METADATA)
        )
        load = {
            "_ingested_at": datetime(2026, 6, 20, tzinfo=UTC),
            "_source": "test",
            "_app_id": "app",
            "_platform": "android",
            "_run_id": "run-1",
            "_extract_from": date(2026, 6, 1),
            "_extract_to": date(2026, 6, 30),
        }
        schema = ", ".join(
            [f"`{c}` string" for c in own] + [f"`{c}` {t}" for c, t in METADATA.items()]
        )
        data = [
            tuple(r.get(c) for c in own) + tuple(r.get(c, load[c]) for c in METADATA) for r in rows
        ]
        return spark.createDataFrame(data, schema)

    return build


def as_dicts(df, *order):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((r[c] is None, str(r[c])) for c in order or df.columns))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def day(n: int, month: int = 6) -> date:
    return date(2026, month, n)


def at(n: int, hour: int = 0) -> datetime:
    return datetime(2026, 6, n, hour, tzinfo=UTC)

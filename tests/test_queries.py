"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from conftest import plan_of

import __spark_entry__ as entry_points
from workloads.check import compare
from workloads.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated tables")


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF_DIR, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("dash_")))
def test_no_plan_deals_rows_out_by_turns(spark, name):
    assert "RoundRobin" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_a_dashboard_parses_only_the_rates_it_shows(spark):
    plan = plan_of(QUERIES["dash_acquisition_by_os_version"](spark, SF_DIR))
    assert "crashRate7dUserWeighted" not in plan and "crashRate_ci_lower" not in plan

"""Registered queries: equal to DuckDB, and planned for scale."""

import os

import pytest

from __spark_entry__ import entry
from check import connect, differences
from mendlake.plans.catalog import QUERIES
from mendlake.plans.checks import CHECKS
from mendlake.session import shared_dir

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 13 and {"group_name", "n_entries", "percent"} == set(rows[0].asDict())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_duckdb(spark, duck, name):
    assert differences(spark, duck, SMALL, name) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plan(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["fixes_by_category"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_comment" not in plan
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("Exchange hashpartitioning") == 3  # one for the fixture's markers


class Session:
    """The two settings that decide on the shared folder."""

    def __init__(self, folder, master):
        self.conf = self
        self.sparkContext = self
        self.folder, self.master = folder, master

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default


def test_shared_folder_comes_from_the_session():
    assert shared_dir(Session("/mnt/shared/cp/", "spark://host:7077"), "x").startswith("/mnt/shared/cp/x-")
    assert shared_dir(Session("/mnt/shared/cp", "local[4]"), "x").startswith("/mnt/shared/cp/x-")
    assert os.path.isdir(shared_dir(Session(None, "local[4]"), "x"))
    with pytest.raises(ValueError):
        shared_dir(Session(None, "spark://host:7077"), "x")

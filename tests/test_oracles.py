"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry.__module__ == "__spark_entry__"


def test_plans_have_no_cross_join_and_no_global_window(spark):
    from tests.conftest import plan_of

    for name, run in entry.queries().items():
        plan = plan_of(run(spark, SF_DIR))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        for line in plan.split("\n"):
            assert not ("Window [" in line and "], []" in line), name

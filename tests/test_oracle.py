"""Every query with check SQL gives the same rows in DuckDB, and no plan pairs all rows."""

import pytest

from forumtide.plans.catalog import load_all
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql_and_pairs_nothing(spark, con, name):
    query = QUERIES[name]
    frame = query.run(spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    actual = frame.toPandas()
    if query.sql is not None:
        assert difference(actual, con.execute(query.sql).df()) is None


def test_ranking_limits_groups_before_the_shuffle(spark):
    plan = QUERIES["cumulative_top"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan and "PushedFilters: [IsNotNull(o_orderdate)" in plan


def test_as_of_join_is_a_hash_aggregate(spark):
    plan = QUERIES["as_of_counters"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "LessThanOrEqual(l_shipdate" in plan


def test_scans_read_only_needed_columns(spark):
    plan = QUERIES["high_water"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "o_totalprice" not in plan


def test_every_inventory_id_has_a_query():
    covered = {i for q in QUERIES.values() for i in q.ids}
    wanted = (
        [f"SRC-{i}" for i in range(1, 10)] + [f"FLT-{i}" for i in (1, 2, 3, 5, 6, 7, 8, 9)]
        + [f"MRG-{i}" for i in range(1, 11)] + [f"JOIN-{i}" for i in range(1, 10)]
        + [f"AGG-{i}" for i in range(1, 13)] + [f"WIN-{i}" for i in range(1, 5)]
        + [f"TOP-{i}" for i in range(1, 4)] + [f"SET-{i}" for i in range(1, 4)]
        + [f"FN-{i}" for i in (1, 2, 3, 4, 5, 6, 8)] + [f"TXT-{i}" for i in range(1, 12)]
        + ["OPS-1", "OPS-2"] + [f"STR-{i}" for i in range(1, 6)] + [f"RIS-{i}" for i in (1, 2, 3)]
        + ["DAY-1", "DAY-2", "DRV-1", "DRV-2", "RET-1", "REV-1", "CSV-1", "CLU-1", "REC-1"]
    )
    assert set(wanted) - covered == set()

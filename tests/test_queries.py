"""Every registered query next to its SQL twin, and plan checks on all of them."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_every_twin_has_a_query(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["doc_id", "resource_name", "alias", "match_count", "mean_confidence"]


@pytest.mark.parametrize("name", ["mentions_dedup", "candidate_articles", "numeric_chunks", "block_labels", "range_join_bundles", "phrase_index_hits"])
def test_no_cross_product(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

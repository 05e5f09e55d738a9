"""Every registered query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SF
from tests.plan_audit import audit, scans

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

# thresholds that the smallest data set does not reach
MAY_BE_EMPTY = {"alerts_drop", "alerts_surge", "frequent_removals", "alerts_death", "graph_k_hop"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    flags = set(audit(df))
    assert not flags & {"cartesian", "nested loop"}, flags
    diff = compare(df, con, ORACLES[name])
    assert diff is None or (diff == "EMPTY result" and name in MAY_BE_EMPTY), diff


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).limit(1).collect()


@pytest.mark.parametrize("name,most", [("channel_ratio", 4), ("risk_features", 3), ("member_tier", 1), ("plan_matrix", 2)])
def test_person_and_claim_rows_are_read_once(spark, name, most):
    """Persons, claims, endorsements and months are stand-ins over one table; only risk_features reads one, the persons, twice."""
    assert 0 < scans(QUERIES[name](spark, SF), "lineitem") <= most


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"ent_id", "effective_policy"}
    assert set(ORACLES) <= set(QUERIES)

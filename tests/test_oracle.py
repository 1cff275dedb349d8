"""Every registered query against its SQL twin, and the registry's contract."""

import __spark_entry__ as entry
import pytest
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# too few rows at this size for these to have a result
MAY_BE_EMPTY = {"drift_ratio_alert", "candidate_alert", "model_loaded_alert", "latency_alert", "error_ratio_alert",
                "unseen_customers"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    faults = compare(entry.queries()[name](spark, SF), con, SQL[name])
    if name in MAY_BE_EMPTY:
        faults = [f for f in faults if f != "both sides are empty"]
    assert not faults


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4 and sum(r["n_rows"] for r in rows) == 200


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())

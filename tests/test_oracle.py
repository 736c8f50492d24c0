"""Every registered query against its SQL oracle, and the control figures of the fixtures."""

import os

import pytest

from phasediff.verify.compare import differences, oracle_connection
from phasediff.verify.oracle import oracles
from phasediff.verify.queries import registered
from tests.conftest import DATA

ORACLES = oracles()
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(DATA)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize(
    "name", ["object_summary", "position_changes", "ladder_with_pillar", "savings_block"]
)
def test_salted_joins_give_the_same_results(spark, con, monkeypatch, name):
    """The way taken when a dimension is too large to broadcast."""
    monkeypatch.setattr("phasediff.operators.joins.BROADCAST_LIMIT_BYTES", 0)
    df = QUERIES[name](spark, DATA)
    assert "_salt" in df._jdf.queryExecution().executedPlan().toString()
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.skipif(not DATA.endswith("sf0.001"), reason="figures of the smallest tables")
def test_control_figures(fx):
    row = fx.budget_line.selectExpr(
        "count(1) AS n",
        "count(amount_start) AS s",
        "count(amount_end) AS e",
        "CAST(sum(amount_start) AS STRING) AS ss",
        "CAST(sum(amount_end) AS STRING) AS se",
    ).first()
    assert tuple(row) == (6000, 5669, 5727, "269170490.47", "271340688.16")
    assert fx.pos_start.count() == fx.pos_end.count() == 1350
    assert fx.pos_all_start.count() == fx.pos_all_end.count() == 1500
    pairs = fx.budget_line.select("service_id", "object_id").distinct()
    assert pairs.count() < 10 * pairs.select("service_id").distinct().count()
    counts = [df.count() for df in fx.pos_phases.values()]
    assert counts == [1350, 1320, 1350, 1290]
    assert fx.sheet_row.count() == 125
    assert fx.cur_expend.count() == 3421


def test_change_counts(spark, fx):
    from phasediff.plans.positions import position_changes

    found = dict(position_changes(fx.pos_start, fx.pos_end).groupBy("change_type").count().collect())
    if DATA.endswith("sf0.001"):
        assert found == {
            "create": 75,
            "eliminate": 150,
            "service_to": 171,
            "service_from": 171,
            "fund_to": 24,
            "fund_from": 23,
            "reclass_to": 109,
        }
    assert found["service_to"] == found["service_from"]


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert {*QUERIES} <= {*contract.queries()} and {*ORACLES} <= {*contract.oracle_sql()}
    assert {*contract.oracle_sql()} <= {*contract.queries()}
    without = {*contract.queries()} - {*contract.oracle_sql()}
    checked = contract.corpus.CHECKED_BY_TESTS if contract.corpus else ()
    assert without == {*checked}
    assert os.path.isdir(DATA)


def test_sheet_keys_reads_every_row_of_every_sheet(spark, con, fx):
    """Twelve rows of each service; the thirteenth stands on a tab without a service."""
    services = fx.service.count()
    assert QUERIES["sheet_keys"](spark, DATA).count() == 12 * services
    assert len(con.execute(ORACLES["sheet_keys"]).fetchall()) == 12 * services

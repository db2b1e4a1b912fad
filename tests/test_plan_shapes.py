"""The physical plans hold what the design relies on."""

import pytest
from conftest import SMALL

from ledgerlens.operators import bets, loads, users
from ledgerlens.plans import adapters as A
from ledgerlens.plans import queries as Q

WRITING = {"ingest_reports", "ingest_ledger", "pending_files", "manifest_upsert", "report_bundle", "bundle_refresh",
           "stream_loads_daily", "stream_ingest"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.catalogue()) - WRITING))
def test_no_pairing_of_all_rows(spark, name):
    text = plan(Q.catalogue()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_dedup_cuts_groups_before_the_shuffle(spark):
    text = plan(Q.catalogue()["ledger_dedup_last"](spark, SMALL))
    assert text.count("WindowGroupLimit") == 2


def test_top_lists_never_sort_everything(spark):
    facts, people = Q.events(spark, SMALL), A.event_users(spark, SMALL)
    assert "TakeOrderedAndProject" in plan(users.contact_top(facts, people))
    assert "WindowGroupLimit" in plan(users.game_top_users(facts, people))


def test_scans_read_few_columns(spark):
    text = plan(bets.revenue_daily(Q.orders(spark, SMALL)))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_custkey" not in schema and "o_orderkey" not in schema


def test_period_bounds_reach_the_scan(spark):
    text = plan(loads.period_kpis(Q.events(spark, SMALL), *Q.PERIOD))
    pushed = text.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_retention_reads_the_ledger_once(spark):
    assert plan(users.channel_retention(Q.events(spark, SMALL))).count("FileScan") == 1

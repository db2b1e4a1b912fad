"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import differences
from conftest import SMALL

import __spark_entry__ as spark_entry
from ledgerlens.plans.oracles import oracles
from ledgerlens.plans.queries import catalogue

QUERIES, ORACLES = catalogue(), oracles()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert differences(spark, SMALL, name, QUERIES[name], ORACLES[name]) == []


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(ORACLES) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["Fecha_Dia", "MODO", "Retail"]


@pytest.fixture
def strange_session(spark):
    settings = {
        "spark.sql.session.timeZone": "America/Sao_Paulo",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    ["before_after", "period_kpis", "mean_daily_deposit", "bonus_by_type", "bonus_rates", "game_calendar",
     "milestone_counts", "channel_retention", "monthly_growth", "dayfirst_parse", "reactivated_users"],
)
def test_results_do_not_depend_on_the_session(strange_session, name):
    assert differences(strange_session, SMALL, name, QUERIES[name], ORACLES[name]) == []

"""Report tables: hand-made edge rows and the cross-table invariants."""

from datetime import date, datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from ledgerlens.functions.rules import Rules
from ledgerlens.operators import bets, bonus, kpis, loads, users
from ledgerlens.operators.classify import daily_rollup
from ledgerlens.operators.common import day_range, month_range
from ledgerlens.plans import adapters as A
from ledgerlens.plans import queries as Q

MODO, TJ = "Carga saldo desde MODO", "Carga saldo desde TJ"


def test_null_keys_and_empty_sums(facts):
    f = facts(
        (1, "2025-03-01 10:00:00", MODO, 1, "x", None),
        (2, None, MODO, 2, "x", 5),
        (3, "2025-03-02 10:00:00", TJ, None, "x", 7),
        (4, "2025-03-02 11:00:00", "Retiro", 1, "x", 9),
    )
    assert rows(loads.loads_daily_amount_pivot(f)) == [
        (date(2025, 3, 1), 0.0, 0.0), (date(2025, 3, 2), 0.0, 7.0)
    ]
    assert rows(loads.loads_daily_count_pivot(f)) == [(date(2025, 3, 1), 0, 0), (date(2025, 3, 2), 0, 1)]
    assert rows(loads.avg_deposit_daily(f)) == [
        (date(2025, 3, 1), None, None), (date(2025, 3, 2), None, 7.0)
    ]
    assert rows(loads.loads_daily_channel(f)) == [
        (date(2025, 3, 1), "MODO", 0, 0.0, 1), (date(2025, 3, 2), "Retail", 1, 7.0, 0)
    ]
    assert {r[0]: r[1:] for r in rows(loads.loads_by_channel(f))} == {"MODO": (1, 2, 5.0), "Retail": (1, 0, 7.0)}
    assert rows(loads.withdrawals_daily(f)) == [(date(2025, 3, 2), 1, 9.0, 1)]
    values = dict(rows(kpis.kpi_summary(f)))
    assert values["Promedio depósito $"] == 6.0
    assert values["Usuarios únicos (cualquier mov.)"] == 2.0
    assert values["Usuarios únicos que recargaron"] == 2.0


def test_empty_ledger(facts):
    f = facts()
    assert rows(loads.loads_daily_amount_pivot(f)) == []
    assert set(dict(rows(kpis.kpi_summary(f))).values()) == {0.0}
    assert rows(loads.before_after(f)) == [("Before 07/07/2025", 0.0, 0.0), ("After 07/07/2025", 0.0, 0.0)]
    assert rows(bets.game_calendar(f)) == []
    assert [r[1] for r in rows(users.milestone_counts(f))] == [0] * 6
    assert rows(loads.period_kpis(f, datetime(2025, 1, 1), datetime(2025, 2, 1)))[0][:3] == (0.0, 0, 0)
    assert rows(bonus.bonus_detail(f)) == []


def test_milestones_split_before_and_after(facts):
    f = facts(
        (1, "2025-07-06 23:59:59", MODO, 1, "x", 1), (2, "2025-07-07 00:00:00", MODO, 2, "x", 2),
        (3, "2025-07-08 00:00:00", "Jugada", 2, "Jugada - Loto", 4), (4, None, MODO, 3, "x", 8),
        (5, "2025-04-13 10:00:00", "Jugada", 3, "Jugada - Quini  6", 16),
    )
    assert rows(loads.before_after(f)) == [("Before 07/07/2025", 1.0, 16.0), ("After 07/07/2025", 2.0, 4.0)]
    assert [r[1] for r in rows(users.milestone_counts(f))] == [2, 1, 1, 1, 1, 1]


def test_game_may_meet_several_patterns(facts):
    f = facts(
        (1, "2025-03-01", "Jugada", 1, "Jugada - Loto y Quini6", 3), (2, "2025-03-01", "Jugada", 1, "TOMBOLA", 4)
    )
    assert rows(bets.game_player_summary(f)) == [
        ("Loto_Plus", 1, 1, 3.0), ("Quini6", 1, 1, 3.0), ("Tombola", 1, 1, 4.0)
    ]


def test_calendar_fills_gaps_and_blanks_the_outside(facts):
    f = facts((1, "2025-03-01", "Jugada", 1, "A", 1), (2, "2025-03-04", "Jugada", 1, "A", 1))
    got = rows(bets.game_calendar(f, start=date(2025, 3, 2), end=date(2025, 3, 4)))
    assert [r[2] for r in got] == [None, 0, 0, 1]


def test_ranges(facts):
    f = facts(
        (1, "2025-03-01 00:00:00", "Jugada", 1, "A", 1), (2, "2025-03-02 00:00:00", "Jugada", 1, "A", 2),
        (3, "2025-03-02 10:00:00", "Jugada", 2, "A", 4),
    )
    start, end = datetime(2025, 3, 1), datetime(2025, 3, 2)
    assert day_range(f, "ts", start, end).count() == 2
    assert day_range(f, "ts", start, end, inclusive_end=True).count() == 3
    assert month_range(f, "month", datetime(2025, 3, 20), datetime(2025, 3, 25)).count() == 3
    kept = loads.period_kpis(f, start, end).first()
    assert (kept["Usuarios_Apostadores"], kept["Recaudacion_Periodo"]) == (1, 7.0)
    assert loads.period_kpis(f, start, end, inclusive_end=True).first()["Usuarios_Apostadores"] == 2


def test_top_text_and_ties(facts, registry):
    people = registry((1, "a", "a@x", None), (2, "b", "b@x", None), (3, None, "c@x", None))
    f = facts(*[(i, "2025-03-01", "Jugada", doc, "A", 1000) for i, doc in enumerate([2, 1, 3, 4])])
    got = rows(bets.dynamic_top(f, people, "A", datetime(2025, 3, 1), datetime(2025, 3, 1), as_text=True))
    assert got == [(1, "a", "a@x", "$1,000.00", 1), (2, "b", "b@x", "$1,000.00", 1)]


@pytest.fixture(scope="module")
def event_facts(spark):
    cached = Q.events(spark, SMALL).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def order_facts(spark):
    cached = Q.orders(spark, SMALL).cache()
    yield cached
    cached.unpersist()


def by_key(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_daily_pivots_add_up_to_the_kpis(event_facts):
    value = dict(rows(kpis.kpi_summary(event_facts)))
    amount = loads.loads_daily_amount_pivot(event_facts).agg(F.sum("MODO"), F.sum("Retail")).first()
    count = loads.loads_daily_count_pivot(event_facts).agg(F.sum("MODO"), F.sum("Retail")).first()
    assert amount[0] == pytest.approx(value["Monto MODO $"]) and amount[1] == pytest.approx(value["Monto Retail $"])
    assert (count[0], count[1]) == (value["Recargas - MODO"], value["Recargas - Retail"])
    assert value["Promedio depósito $"] == pytest.approx(sum(amount) / sum(count))


def test_before_after_splits_the_daily_series(event_facts):
    start = A.EVENT_RULES.channel_start.date()
    total = {True: 0.0, False: 0.0}
    for r in loads.loads_daily_amount_pivot(event_facts).collect():
        total[r["Fecha_Dia"] >= start] += r["MODO"] + r["Retail"]
    got = rows(loads.before_after(event_facts, A.EVENT_RULES))
    assert [r[1] for r in got] == [pytest.approx(total[False]), pytest.approx(total[True])]


def test_average_is_blank_only_without_loads(event_facts):
    amount, count = by_key(loads.loads_daily_amount_pivot(event_facts)), by_key(loads.loads_daily_count_pivot(event_facts))
    for day, means in by_key(loads.avg_deposit_daily(event_facts)).items():
        for mean, a, n in zip(means, amount[day], count[day]):
            assert (mean is None) if n == 0 else mean == pytest.approx(a / n)


def test_channel_daily_equals_the_pivot_column(event_facts):
    pivot = {d: v[0] for d, v in by_key(loads.loads_daily_amount_pivot(event_facts)).items() if v[0]}
    assert {d: v[1] for d, v in by_key(loads.channel_daily(event_facts)).items()} == pivot


def test_game_month_counts_and_spend(order_facts):
    months = {(r[0], r[1]): (r[2], r[4]) for r in bets.top_games_month(order_facts).collect()}
    assert {(r[0], r[1]): r[2] for r in bets.bets_month_game(order_facts).collect()} == {
        k: v[0] for k, v in months.items()
    }
    spend, revenue = {}, {}
    for (month, _), (_, amount) in months.items():
        spend[month] = spend.get(month, 0) + amount
    for day, (amount,) in by_key(bets.revenue_daily(order_facts)).items():
        revenue[f"{day:%Y-%m}"] = revenue.get(f"{day:%Y-%m}", 0) + amount
    assert spend == {m: pytest.approx(v) for m, v in revenue.items()}


def test_retention_rate(spark, order_facts):
    for r in users.cohort_retention(order_facts, A.order_users(spark, SMALL)).collect():
        assert r[3] == pytest.approx(100 * r[2] / r[1]) and r[4] is None and r[2] <= r[1]


def test_bonus_funnel_narrows(event_facts):
    detail = bonus.bonus_detail(event_facts)
    daily = by_key(bonus.bonus_daily(event_facts))
    for r in bonus.bonus_kpis(bonus.bonus_daily(event_facts), detail).collect():
        day, granted, amount, played, spent, loaded, signup, deposit = r
        assert granted >= played >= spent >= loaded and signup + deposit == granted
        assert daily[day] == (granted, amount, signup, deposit)


REPORTS = {
    "client_month_game": bets.client_month_game, "top_games_total": bets.top_games_total,
    "top_games_month": bets.top_games_month, "game_player_summary": bets.game_player_summary,
    "loads_daily_channel": loads.loads_daily_channel, "avg_deposit_daily": loads.avg_deposit_daily,
    "channel_daily": loads.channel_daily, "withdrawals_daily": loads.withdrawals_daily,
    "winners": loads.winners, "game_day_detail": bets.game_day_detail, "weekday_totals": bets.weekday_totals,
    "channel_retention": users.channel_retention, "monthly_growth": users.monthly_growth,
    "milestone_counts": lambda f: users.milestone_counts(f, A.EVENT_RULES),
    "before_after": lambda f: loads.before_after(f, A.EVENT_RULES), "kpi_summary": kpis.kpi_summary,
    "loads_by_channel": loads.loads_by_channel, "bets_per_user": bets.bets_per_user,
    "new_channel_users": users.new_channel_users, "bonus_daily": bonus.bonus_daily,
    "period_kpis": lambda f: loads.period_kpis(f, *Q.PERIOD), "game_calendar": bets.game_calendar,
}


@pytest.mark.parametrize("name", REPORTS)
def test_rollup_gives_the_same_report(event_facts, name):
    report, rules = REPORTS[name], Rules()
    assert rules.channels == ("MODO", "Retail")
    assert sorted(rows(report(daily_rollup(event_facts))), key=repr) == sorted(rows(report(event_facts)), key=repr)


def test_sums_never_wrap(spark):
    from ledgerlens.operators import loads as L

    facts = spark.sql(
        "SELECT date'2025-01-01' AS day, true AS is_load, 'MODO' AS channel, 1 AS n, id AS doc_id,"
        " 9000000000000000000 AS cents FROM range(5)"
    )
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert L.loads_daily_channel(facts).first()["Monto"] == 4.5e17
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_a_rollup_cannot_be_cut_inside_a_day(event_facts):
    from datetime import datetime

    start, end = datetime(2024, 1, 5, 10), datetime(2024, 1, 9)
    assert loads.period_kpis(event_facts, start, end).count() == 1
    with pytest.raises(ValueError, match="roll-up"):
        loads.period_kpis(daily_rollup(event_facts), start, end)
    assert loads.period_kpis(daily_rollup(event_facts), datetime(2024, 1, 5), end).count() == 1

import random
from datetime import datetime, timedelta

import pytest
from conftest import at, movement, rows

from ledgerlens.functions.rules import Rules
from ledgerlens.operators import kpis, users
from ledgerlens.operators.classify import classify
from ledgerlens.operators.dedup import keep_one, upsert
from ledgerlens.schema import LEDGER

MODO, TJ = "Carga saldo desde MODO", "Carga saldo desde TJ"


def test_first_non_null_value_per_column(facts):
    f = facts(
        (3, "2025-03-02 10:00:00", "Jugada", 1, "late", 5), (2, "2025-03-01 10:00:00", None, 1, "first", None),
        (1, "2025-03-01 10:00:00", "Retiro", 1, None, None), (9, None, "Premio", 1, "no time", 8),
        (4, None, "Premio", 2, "only", 1), (5, "2025-03-01", "Premio", None, "x", 1),
    )
    got = sorted(rows(users.first_movement(f)))
    assert got == [
        (1, at("2025-03-01 10:00:00"), 1, "Retiro", "first", 5.0), (2, None, 4, "Premio", "only", 1.0)
    ]


def test_retention_bounds(facts):
    def user(doc, *bets):
        return [(doc * 10, "2025-03-01 12:00:00", MODO, doc, "x", 1)] + [
            (doc * 10 + i, b, "Jugada", doc, "A", 1) for i, b in enumerate(bets, start=1)
        ]

    f = facts(
        *user(1, "2025-03-01 12:00:00"), *user(2, "2025-03-02 12:00:00"), *user(3, "2025-03-02 12:00:01"),
        *user(4, "2025-03-31 12:00:00"), *user(5, "2025-03-31 12:00:01"), *user(6),
        *user(7, "2025-03-01 11:00:00", "2025-03-01 12:00:01"), (90, "2025-03-01", TJ, 9, "x", 1),
        (80, None, MODO, 8, "x", 1), (81, "2025-03-05", "Jugada", 8, "A", 1),
    )
    got = {
        r["Documento"]: (r["Es_Nuevo"], r["Jugo_Posterior"], r["Jugo_Dia_Sig"], r["Jugo_Mes_Sig"])
        for r in users.channel_retention(f).collect()
    }
    assert got == {
        1: (True, False, False, False), 2: (True, True, True, True), 3: (True, True, False, True),
        4: (True, True, False, True), 5: (True, True, False, False), 6: (True, False, False, False),
        7: (False, True, True, True), 8: (False, False, False, False),
    }
    assert rows(users.new_channel_users(f)) == [(6,)]


def test_growth_keeps_months_with_new_users(facts):
    f = facts(
        (1, "2025-01-05", "Retiro", 1, "x", 1), (2, "2025-02-05", "Jugada", 1, "x", 1),
        (3, "2025-03-05", "Jugada", 2, "x", 1), (4, "2025-03-06", "Premio", 3, "x", 1), (5, None, "Jugada", 4, "x", 1),
    )
    assert rows(users.monthly_growth(f)) == [("2025-01", 1, 1, None), ("2025-03", 2, 3, 1)]


def brute_first_event(data):
    out = {}
    for doc in {r[3] for r in data}:
        mine = [(r[1], r[2]) for r in data if r[3] == doc]
        bets = [t for t, k in mine if k == "Jugada"]
        if bets:
            first = min(bets)
            later = [t for t, k in mine if k == MODO and t > first]
            out[doc] = (first, min(later, default=None), min((t for t in bets if t > first), default=None))
    return out


def test_first_event_against_brute_force(spark):
    rng, start = random.Random(7), datetime(2025, 1, 1)
    data = [
        movement(i, None, rng.choice(["Jugada", MODO]), rng.choice([1, 1, 2, 3, 4]), "x", 1) for i in range(300)
    ]
    data = [(r[0], start + timedelta(hours=rng.randrange(60)), *r[2:]) for r in data]
    data += [(1000, start, "Jugada", 50, "x", None), (1001, start, MODO, 51, "x", None)]
    f = classify(spark.createDataFrame(data, LEDGER))
    assert {r[0]: tuple(r[1:]) for r in users.first_event(f).collect()} == brute_first_event(data)


def test_cohorts(facts, registry):
    f = facts(
        (1, "2025-03-01", "Jugada", 1, "x", 1), (2, "2025-03-02", "Jugada", 1, "x", 1), (3, "2025-06-03", MODO, 1, "x", 1),
        (4, "2025-03-01", "Jugada", 2, "x", 1), (5, "2025-03-03", MODO, 2, "x", 1),
        (6, "2025-03-02", MODO, 3, "x", 1), (7, "2025-03-03", "Jugada", 3, "x", 1), (8, "2025-03-04", "Jugada", 3, "x", 1),
    )
    people = registry(
        (1, "a", "", "2025-01-15"), (2, "b", "", "2025-01-20"), (3, "c", "", "2025-02-01"),
        (4, "d", "", "2025-02-01"), (5, "e", "", None),
    )
    assert rows(users.cohort_retention(f, people)) == [("2025-01", 2, 1, 50.0, None), ("2025-02", 1, 0, 0.0, None)]


def test_reactivated_new_and_inactive(facts, registry):
    f = facts(
        (1, "2025-07-08", MODO, 1, "x", 1), (2, "2025-07-10", MODO, 1, "x", 1), (3, "2025-07-01", MODO, 2, "x", 1),
        (4, "2025-07-09", MODO, 2, "x", 1), (5, "2025-07-09", TJ, 3, "x", 1), (6, "2025-07-09", MODO, 4, "x", 1),
        (7, "2025-07-09", MODO, None, "x", 1),
    )
    people = registry(
        (1, "a", "a@", "2022-01-01"), (2, "b", "b@", "2022-01-01"), (3, "c", "c@", "2022-01-01"),
        (4, "d", "d@", "2025-07-07"), (5, "e", "e@", "2025-07-06"), (1, "a2", "a@", "2023-01-01"),
    )
    got = sorted(rows(users.reactivated_users(f, people)))
    assert [(r[0], r[2], r[4]) for r in got] == [(1, "a", at("2025-07-08")), (1, "a2", at("2025-07-08"))]
    assert [r[0] for r in rows(users.new_users_since(people))] == [4]
    assert rows(users.new_users_total(people)) == [("Total Nuevos Usuarios desde 07/07/2025", 1)]
    assert [r[0] for r in rows(users.inactive_users(f, people))] == [5]
    assert dict(rows(kpis.activity_kpis(f, people)))["Usuarios Inactivos (sin mov.)"] == 2.0


def test_contacts(facts, registry):
    f = facts(*[(i, "2025-03-01", "Jugada", i % 13, "Jugada - Loto", i) for i in range(60)])
    people = registry(*[(i, f"u{i}", "", None) for i in range(1, 12)])
    top = rows(users.contact_top(f, people))
    assert len(top) == 10 and [r[0] for r in top[:2]] == [1, 2]
    best = rows(users.game_top_users(f, people))
    assert len(best) == 10 and {r[0] for r in best} == {"Loto_Plus"}


@pytest.mark.parametrize("keep, expected", [("last", [(None, "z"), (1, "b"), (2, "c")]), ("first", [(None, "y"), (1, "a"), (2, "c")])])
def test_keep_one(spark, keep, expected):
    data = [(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "y", 4), (None, "z", 5)]
    df = spark.createDataFrame(data, "k int, v string, o int")
    got = rows(keep_one(df, ["k"], ["o"], keep).select("k", "v"))
    assert sorted(got, key=lambda r: (r[0] or 0)) == expected


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    assert set(rows(upsert(old, new, ["k"]))) == {(1, "a"), (2, "B"), (3, "C"), (None, "N")}
    assert set(rows(upsert(old, new, ["k"], "first"))) == {(1, "a"), (2, "b"), (3, "C"), (None, "n")}
    with pytest.raises(ValueError):
        upsert(old, new, ["k"], "any")


def test_rules_default():
    assert Rules().channel_start == datetime(2025, 7, 7)

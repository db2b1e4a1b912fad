"""Distinct users from bitmaps: against exact counts, over several loads, and edge rows."""

import random
from collections import defaultdict

from conftest import SMALL, rows
from pyspark.sql import functions as F

from ledgerlens.operators import bets, distinct
from ledgerlens.operators.classify import daily_rollup
from ledgerlens.plans import queries as Q

BET = "Jugada"


def some_bets(n, users, seed):
    """Bets of which one user makes a third."""
    rng = random.Random(seed)
    return [
        (
            seed * 10**6 + i, f"2025-0{rng.randint(3, 5)}-0{rng.randint(1, 9)} 10:00:00", BET,
            users[0] if rng.random() < 0.33 else rng.choice(users), f"Jugada - {rng.choice('ABC')}", 1,
        )
        for i in range(n)
    ]


def expected(bets_made):
    found = defaultdict(set)
    for _, ts, _, user, text, _ in bets_made:
        day, game = ts[:10], text[-1]
        month = day[:7]
        for key in (
            ("day_game", day, month, game), ("day", day, month, None), ("month_game", None, month, game),
            ("month", None, month, None), ("game", None, None, game), ("all", None, None, None),
        ):
            found[key].add(user)
    return {key: len(own) for key, own in found.items()}


def counts(cube):
    got = {(r.level, str(r.day) if r.day else None, r.month, r.game): r.users for r in cube.collect()}
    assert len(got) == cube.count()
    return got


def test_cube_of_two_loads_equals_that_of_one(spark, facts):
    # Sparse ids far apart; some users in both loads.
    ids = random.Random(1).sample(range(10**9), 90)
    one, two = some_bets(300, ids[:60], 1), some_bets(300, ids[30:], 2)
    first = distinct.user_numbers(facts(*one))
    both = distinct.user_numbers(facts(*two), first)
    numbers = [r.number for r in both.collect()]
    assert sorted(numbers) == list(range(1, len({b[3] for b in one + two}) + 1))
    kept = {r.doc_id: r.number for r in first.collect()}
    assert kept.items() <= {r.doc_id: r.number for r in both.collect()}.items()
    days = distinct.merged_days(distinct.user_days(facts(*one), first), distinct.user_days(facts(*two), both))
    assert counts(distinct.distinct_users_cube(days)) == expected(one + two)


def test_users_of_several_buckets(spark):
    # 70,000 users need three buckets of numbers.
    made = spark.range(70_000).select(
        (F.col("id") * 97 + 5).alias("doc_id"), F.lit(True).alias("is_bet"), F.lit("A").alias("game"),
        F.expr("date'2025-03-01' + cast(id % 2 as int)").alias("day"), F.lit("2025-03").alias("month"),
    )
    numbers = distinct.user_numbers(made.repartition(5))
    assert rows(numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number"))) == [(1, 70_000, 70_000)]
    days = distinct.user_days(made, numbers)
    assert days.count() == 6
    got = counts(distinct.distinct_users_cube(days))
    assert got["all", None, None, None] == got["month", None, "2025-03", None] == 70_000
    assert got["day", "2025-03-01", "2025-03", None] == 35_000


def test_edge_rows(facts):
    odd = [
        (1, "2025-03-01 10:00:00", BET, None, "Jugada - A", 1),
        (2, None, BET, 7, "Jugada - A", 1),
        (3, "2025-03-01 10:00:00", "Retiro", 7, "x", 1),
    ]
    assert counts(distinct.users_of_ledger(facts(*odd))) == {("all", None, None, None): 0}
    assert counts(distinct.users_of_ledger(facts().limit(0))) == {("all", None, None, None): 0}


def test_cube_agrees_with_the_reports_and_the_rollup(spark):
    ledger = Q.events(spark, SMALL)
    cube = distinct.users_of_ledger(ledger)
    assert rows(cube.where("level = 'month'").select("month", "users").orderBy("month")) == rows(bets.monthly_active(ledger))
    days = bets.game_day_detail(ledger).select("Fecha_Dia", "Juego", "Usuarios_Unicos_Dia")
    assert rows(cube.where("level = 'day_game'").select("day", "game", "users").orderBy("day", "game")) == rows(days)
    assert counts(distinct.users_of_ledger(daily_rollup(ledger))) == counts(cube)

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows

from ledgerlens.operators import bonus
from ledgerlens.operators.classify import classify
from ledgerlens.schema import LEDGER

MODO = "Carga saldo desde MODO"


def brute(data):
    out = {}
    for tx, ts, kind, doc, _, amount in data:
        if "Bonific" not in kind or doc is None or ts is None or amount is None:
            continue
        goal = amount
        later = sorted(
            (r[1], r[0], max(r[5] or Decimal(0), Decimal(0)))
            for r in data
            if "jugada" in r[2].lower() and r[3] == doc and r[1] is not None and r[1] > ts
        )
        spent, total = None, Decimal(0)
        for when, _, stake in later:
            total += stake
            if total >= goal:
                spent = when
                break
        loaded = any(
            r[2] == MODO and r[3] == doc and r[1] is not None and spent is not None and r[1] > spent for r in data
        )
        out[tx] = (later[0][0] if later else None, spent, loaded)
    return out


def random_ledger(seed, size, users, hours):
    rng, start = random.Random(seed), datetime(2025, 1, 1)
    kinds = ["Jugada", "Jugada", "Bonificación", MODO, "Retiro", "Bonificación con jugada"]
    amounts = [None, Decimal("0.00"), Decimal("-3.00")] + [Decimal(n) for n in (1, 2, 5, 10, 40)]
    return [
        (
            i,
            None if rng.random() < 0.02 else start + timedelta(minutes=20 * rng.randrange(hours * 3)),
            rng.choice(kinds),
            None if rng.random() < 0.02 else rng.choice(users),
            rng.choice(["registro", "x", None]),
            rng.choice(amounts),
        )
        for i in range(size)
    ]


@pytest.mark.parametrize("seed, users, per_task", [(1, [1, 2, 3], 1_000_000), (2, [1, 1, 1, 2], 3), (3, list(range(40)), 1)])
def test_detail_against_brute_force(spark, seed, users, per_task):
    data = random_ledger(seed, 400, users, 100)
    facts = classify(spark.createDataFrame(data, LEDGER))
    got = {
        r["Nro_Transaccion"]: (r["Fecha_Primera_Jugada"], r["Fecha_Agote_Bono"], r["Recargo_despues_Agote"])
        for r in bonus.bonus_detail(facts, bonuses_per_task=per_task).collect()
    }
    assert got == brute(data)
    receivers = facts.where("is_bonus").select("doc_id").distinct()
    narrowed = bonus.bonus_detail(facts, receivers=receivers, bucket_hours=1)
    assert {r[0]: (r[7], r[8], r[9]) for r in narrowed.collect()} == got


def test_types_rates_and_long_form(facts):
    f = facts(
        (1, "2025-03-01 10:00:00", "Bonificación", 1, "Alta de usuario", 10),
        (2, "2025-03-01 11:00:00", "Bonificación", 2, "por depósito", 20),
        (3, "2025-03-01 12:00:00", "Jugada", 1, "A", 10), (4, "2025-03-01 13:00:00", MODO, 1, "x", 1),
        (5, "2025-03-02 10:00:00", "Bonificación", 1, None, None),
    )
    kpis = bonus.bonus_kpis(bonus.bonus_daily(f), bonus.bonus_detail(f))
    start, end = datetime(2025, 3, 1, 15), datetime(2025, 3, 1)
    rates = bonus.bonus_rates(kpis, start, end).first()
    assert rates["Bonos_Otorgados"] == 2 and rates["Monto_Bonos"] == 30.0
    assert (rates["Pct_Jugaron"], rates["Pct_Agotaron"], rates["Pct_Recargaron"]) == (50.0, 50.0, 50.0)
    empty = bonus.bonus_rates(kpis, datetime(2020, 1, 1), datetime(2020, 1, 2)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)
    daily = bonus.bonus_daily(f)
    assert [tuple(r[1:]) for r in rows(bonus.bonus_by_type(daily, start, end))] == [("Depósito", 1.0), ("Registro", 1.0)]
    lacking = bonus.bonus_by_type(daily.drop("Deposito_Cant"), start, end)
    assert [r[2] for r in rows(lacking)] == [0.0, 1.0]


def test_daily_and_kpis_count_the_same_bonuses(facts):
    f = facts(
        (1, "2025-03-01 10:00:00", "Bonificación", None, "Alta", 10),
        (2, "2025-03-01 11:00:00", "Bonificación", 2, "x", None),
        (3, "2025-03-01 11:00:00", "Bonificación", 2, "x", 5),
        (4, "2025-03-01 12:00:00", "Jugada", 2, "A", 10),
        (5, "2025-03-02 12:00:00", "Bonificación", None, "x", 7),
    )
    shared = ["Fecha_Dia", "Bonos_Otorgados", "Monto_Bonos", "Registro_Cant", "Deposito_Cant"]
    daily, kpis = bonus.bonus_daily(f), bonus.bonus_kpis(bonus.bonus_daily(f), bonus.bonus_detail(f))
    assert rows(daily.select(shared)) == rows(kpis.select(shared))
    assert [r[1:3] for r in rows(daily)] == [(2, 15.0), (1, 7.0)]
    assert [r["Jugaron_PostBono"] for r in kpis.collect()] == [1, 0]

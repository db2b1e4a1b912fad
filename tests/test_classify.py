from dataclasses import replace

from conftest import movement

from ledgerlens.functions.rules import Rules
from ledgerlens.operators.classify import classify, daily_rollup
from ledgerlens.schema import LEDGER

KINDS = ["is_bet", "is_load", "is_withdrawal", "is_prize", "is_bonus"]


def classified(spark, types, rules=Rules()):
    data = [movement(i, "2025-03-03 10:00:00", t, 1, d, 1) for i, (t, d) in enumerate(types)]
    return classify(spark.createDataFrame(data, LEDGER), rules).orderBy("tx_id").collect()


def test_kinds(spark):
    cases = [
        ("Jugada", "bet"), ("APUESTA doble", "bet"), ("Carga saldo desde MODO", "load"),
        ("carga saldo  desde tj", "load"), ("Carga saldo desdeMODO", "load"),
        ("Carga saldo desde MODOS", ""), ("Nueva carga saldo desde MODO", ""), ("Depósito", ""),
        ("Retiro", "withdrawal"), ("TRANSFERENCIA SALIDA", "withdrawal"), ("Premio", "prize"),
        ("Bonificación", "bonus"), ("BONIFICACIÓN jugada", "bet bonus"), (None, ""),
    ]
    got = classified(spark, [(t, "x") for t, _ in cases])
    assert [" ".join(k[3:] for k in KINDS if r[k]) for r in got] == [w for _, w in cases]


def test_broad_loads(spark):
    rules = replace(Rules(), strict_loads=False)
    types = ["CARGA", "DEPÓSITO", "Deposito", "Carga saldo desde MODO", "Retiro", None]
    assert [r["is_load"] for r in classified(spark, [(t, "x") for t in types], rules)] == [
        True, True, True, True, False, False
    ]


def test_extended_channel_priority(spark):
    rules = replace(Rules(), strict_loads=False)
    cases = [
        (("Carga", "via MODO en caja"), "MODO"), (("Carga MODO", "tarjeta"), "MODO"),
        (("Carga", "TARJETA"), "Retail"), (("Carga tj", None), "Retail"), (("Carga", "Agencia 12"), "Retail"),
        (("Carga", "deposito"), "Retail"), (("Carga caja", "x"), "Otro"), (("Carga", None), "Otro"),
    ]
    got = classified(spark, [c for c, _ in cases], rules)
    assert [r["channel"] for r in got] == [w for _, w in cases]
    assert [r["method"] for r in got] == ["MODO" if w == "MODO" else "Retail" for _, w in cases]
    assert rules.channels == ("MODO", "Retail", "Otro")


def test_binary_channel_reads_the_description_only(spark):
    rules = replace(Rules(), channel_rule="binary")
    got = classified(spark, [("Carga saldo desde MODO", "x"), ("Carga saldo desde TJ", "Módo")], rules)
    assert [r["channel"] for r in got] == ["Retail", "MODO"]


def test_games_and_dates(spark):
    texts = ["Jugada - Tómbola ", "JUGADA-  Quini 6", "Loto jugada - Plus", None]
    got = classified(spark, [("Jugada", t) for t in texts])
    assert [r["game"] for r in got] == ["Tómbola", "Quini 6", "Loto Plus", None]
    assert [r["game_norm"] for r in got] == ["tombola", "quini 6", "loto plus", ""]
    assert (got[0]["month"], str(got[0]["day"]), got[0]["hour"]) == ("2025-03", "2025-03-03", 10)


def test_rollup_merges_a_day(ledger):
    facts = classify(
        ledger(
            (1, "2025-03-03 10:00:00", "Jugada", 1, "Jugada - A", 2),
            (2, "2025-03-03 12:00:00", "Jugada", 1, "Jugada - A", None),
            (3, "2025-03-03 12:00:00", "Jugada", 2, "Jugada - A", 5),
        )
    )
    got = daily_rollup(facts).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n"], r["cents"], r["first_ts"].hour, r["last_ts"].hour) for r in got] == [
        (1, 1, 200, 10, 12), (2, 1, 500, 12, 12)
    ]

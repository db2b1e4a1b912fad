"""All report tables of a run under their output names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.rules import Rules
from ledgerlens.operators import bets, bonus, kpis, loads, users
from ledgerlens.operators.classify import classify, daily_rollup
from ledgerlens.operators.common import with_keys
from ledgerlens.sources.registry import Readings
from ledgerlens.sources.tables import write_table

TABLES_AT_ONCE = 8

#: User keys are broadcast up to this many (16 bytes each or so).
BROADCAST_USERS = 2_000_000

# Tables whose size the calendar, the channels or a label list bounds.
SMALL = {
    "kpis", "recargas_monto", "recargas_cant", "deposito_promedio", "modo_diario", "comparativa_modo",
    "apuestas_diario", "retencion_cohorts", "total_usuarios_nuevos_modo", "recargas_diario",
    "retiros_diario", "dia_totales", "usuarios_mes", "usuarios_hitos", "top10_contactos",
    "bonos_diario", "kpis_bonificaciones",
}


def build_reports(
    facts: DataFrame,
    rollup: DataFrame,
    people: DataFrame | Readings | None = None,
    rules: Rules = Rules(),
    bonuses: DataFrame | None = None,
    stored=lambda df, name: df,
) -> dict[str, DataFrame]:
    """Output name -> table. ``facts`` is the classified ledger, ``rollup`` its daily
    roll-up; reports that need no single movement read the smaller roll-up.
    ``bonuses`` is the bonus detail if it is already stored. ``people``: the readings of
    the registry, or one frame that serves as all of them. ``stored`` may write what
    several tables share."""
    if isinstance(people, DataFrame):
        people = Readings(people, people, people)
    start: datetime = rules.channel_start
    by_day = rollup if start.time() == time() else facts
    detail = bonus.bonus_detail(facts, people and people.last) if bonuses is None else bonuses
    summary = kpis.kpi_summary(rollup)
    tables = {
        "recargas_monto": loads.loads_daily_amount_pivot(rollup, rules),
        "recargas_cant": loads.loads_daily_count_pivot(rollup, rules),
        "deposito_promedio": loads.avg_deposit_daily(rollup, rules),
        "modo_diario": loads.channel_daily(rollup),
        "comparativa_modo": loads.before_after(by_day, rules),
        "jugadores_unicos_por_juego": bets.top_games_month(rollup),
        "total_juegos_mes": bets.bets_month_game(rollup),
        "apuestas_diario": bets.revenue_daily(rollup),
        "movimientos_modo": loads.modo_movements(facts),
        "cliente_mes": bets.client_month_game(rollup),
        "top_games_total": bets.top_games_total(rollup),
        "recargas_diario": loads.loads_daily_channel(rollup),
        "retiros_diario": loads.withdrawals_daily(rollup),
        "ganadores": loads.winners(rollup),
        "juego_dia_detalle": bets.game_day_detail(rollup),
        "uso_juego_dia": bets.game_calendar(rollup),
        "dia_totales": bets.weekday_totals(rollup),
        "primer_movimiento": users.first_movement(facts),
        "retencion_modo": users.channel_retention(rollup),
        "usuarios_mes": users.monthly_growth(rollup),
        "usuarios_hitos": users.milestone_counts(rollup, rules),
        "bonos_diario": bonus.bonus_daily(rollup),
        "kpis_bonificaciones": bonus.bonus_kpis(bonus.bonus_daily(rollup), detail),
        "bonos_resumen": detail.drop("Nro_Transaccion"),
        **detail_feeds(facts),
    }
    players = stored(bets.game_player_summary(rollup, rules), "players")
    for name, _ in rules.game_patterns:
        tables[name.lower()] = players.where(F.col("Juego") == name).drop("Juego")
    if people is not None:
        summary = summary.unionByName(kpis.activity_kpis(rollup, people.first))
        best = stored(users.game_top_users(rollup, people.first, rules), "top_players")
        for name, _ in rules.game_patterns:
            tables[f"top10_{name.lower()}"] = best.where(F.col("Juego") == name).drop("Juego")
        tables |= {
            "retencion_cohorts": users.cohort_retention(rollup, people.last),
            "reactivados_modo": users.reactivated_users(rollup, people.signups, rules),
            "nuevos_modo": users.new_users_since(people.signups, rules),
            "total_usuarios_nuevos_modo": users.new_users_total(people.signups, rules),
            "top10_contactos": users.contact_top(rollup, people.last),
            "apuestas_con_usuarios": bets.enriched_bets(facts, people.last),
            "usuarios_inactivos": users.inactive_users(rollup, people.last),
        }
    tables["kpis"] = summary
    return tables


def detail_feeds(facts: DataFrame) -> dict[str, DataFrame]:
    """Row-level feeds of the four movement kinds."""
    columns = {
        "Fecha": "ts", "Fecha_Dia": "day", "AñoMes": "month", "Hora": "hour", "Documento": "doc_id",
        "Juego": "game", "Metodo": "method", "Canal": "channel", "Importe": "amount",
    }

    def feed(kind: str, *names: str) -> DataFrame:
        return facts.where(kind).select(*[F.col(columns[n]).alias(n) for n in names])

    return {
        "datos_apuestas": feed("is_bet", "Fecha", "Fecha_Dia", "AñoMes", "Documento", "Juego", "Importe"),
        "datos_cargas": feed(
            "is_load", "Fecha", "Fecha_Dia", "Hora", "Documento", "Metodo", "Canal", "Importe"
        ),
        "datos_retiros": feed("is_withdrawal", "Fecha", "Fecha_Dia", "Documento", "Importe"),
        "datos_premios": feed("is_prize", "Fecha", "Documento", "Importe"),
    }


def write_reports(
    spark: SparkSession,
    ledger: DataFrame,
    target: str,
    people: DataFrame | Readings | None = None,
    rules: Rules = Rules(),
    fmt: str = "csv",
) -> list[str]:
    """Write every table under ``target`` and return their names.

    The ledger is read and classified once; the result, the daily roll-up over it, the
    bonus detail and the per-game tables are written first and feed all others.
    """
    facts = _stored(spark, classify(ledger, rules), target, "classified")
    rollup = _stored(spark, daily_rollup(facts), target, "daily_rollup")
    return write_tables(spark, facts, rollup, target, people, rules, fmt)


def _stored(spark: SparkSession, df: DataFrame, target: str, name: str) -> DataFrame:
    path = f"{target}/_work/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_tables(
    spark: SparkSession,
    facts: DataFrame,
    rollup: DataFrame,
    target: str,
    people: DataFrame | Readings | None = None,
    rules: Rules = Rules(),
    fmt: str = "csv",
) -> list[str]:
    """As :func:`write_reports`, from a stored classified ledger and its stored roll-up."""
    def stored(df: DataFrame, name: str) -> DataFrame:
        return _stored(spark, df, target, name)

    if isinstance(people, DataFrame):
        people = Readings(people, people, people)
    receivers = with_keys(rollup.where("is_bonus"), "doc_id").select("doc_id").distinct()
    few = receivers.limit(BROADCAST_USERS + 1).count() <= BROADCAST_USERS
    detail = bonus.bonus_detail(facts, people and people.last, F.broadcast(receivers) if few else None)
    bonuses = stored(detail, "bonus_detail")
    tables = build_reports(facts, rollup, people, rules, bonuses, stored)

    def write(item: tuple[str, DataFrame]) -> None:
        name, table = item
        write_table(table, f"{target}/{name}", fmt, single_file=name in SMALL)

    # Most tables are small; writing several at once keeps the executors busy.
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        list(pool.map(write, tables.items()))
    return sorted(tables)

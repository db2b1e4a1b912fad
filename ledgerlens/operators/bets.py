"""Reports on bets and games. Input: classified ledger or daily roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import movement as M
from ledgerlens.functions.rules import Rules
from ledgerlens.functions.text import money_text
from ledgerlens.operators.common import counted, day_range, distinct_users, money, month_range, with_keys


def client_month_game(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "doc_id", "month", "game")
        .groupBy(
            F.col("doc_id").alias("Documento"),
            F.col("month").alias("AñoMes"),
            F.col("game").alias("Juego"),
        )
        .agg(counted().alias("Bets"), money().alias("Gastado"))
        .orderBy("Documento", "AñoMes", "Juego")
    )


def _game_totals(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "game")
        .groupBy(F.col("game").alias("Juego"))
        .agg(
            counted().alias("Bets_Totales"),
            distinct_users().alias("Jugadores_Unicos"),
            money().alias("Gastado"),
        )
    )


def top_games_total(facts: DataFrame) -> DataFrame:
    return _game_totals(facts).orderBy(F.desc("Bets_Totales"), "Juego")


def top_games_month(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "month", "game")
        .groupBy(F.col("month").alias("AñoMes"), F.col("game").alias("Juego"))
        .agg(
            counted().alias("Bets_Mes"),
            distinct_users().alias("Jugadores_Mes"),
            money().alias("Gastado_Mes"),
        )
        .orderBy(F.desc("AñoMes"), F.desc("Bets_Mes"), "Juego")
    )


def bets_month_game(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "month", "game")
        .groupBy(F.col("month").alias("AñoMes"), F.col("game").alias("Juego"))
        .agg(counted().alias("Total_Bets"))
        .orderBy("AñoMes", "Juego")
    )


def game_evolution(facts: DataFrame, start, end) -> DataFrame:
    """Bets per month and game; a range inside a month takes in the whole month."""
    return month_range(bets_month_game(facts), "AñoMes", start, end)


def game_player_summary(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Bets and spend per player for each named game.

    A bet counts for every pattern its game meets. The names come from an array in
    the row itself, so no join is needed.
    """
    names = F.array(
        *[F.when(M.matches_game(F.col("game_norm"), p), name) for name, p in rules.game_patterns]
    )
    return (
        with_keys(facts.where("is_bet"), "doc_id")
        .withColumn("pattern", F.explode(F.array_compact(names)))
        .groupBy(F.col("pattern").alias("Juego"), F.col("doc_id").alias("Documento"))
        .agg(counted().alias("Bets"), money().alias("Gastado"))
        .orderBy("Juego", F.desc("Gastado"), "Documento")
    )


def game_day_detail(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "day", "game")
        .groupBy(F.col("day").alias("Fecha_Dia"), F.col("game").alias("Juego"))
        .agg(
            counted().alias("Bets"),
            distinct_users().alias("Usuarios_Unicos_Dia"),
            money().alias("Gastado_Dia"),
        )
        .orderBy("Fecha_Dia", "Juego")
    )


def weekday_totals(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "day")
        .groupBy(M.weekday_name(F.col("day")).alias("Dia_Sem"))
        .agg(counted().alias("Bets"), distinct_users().alias("Usuarios_Unicos"))
    )


def monthly_active(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "month")
        .groupBy(F.col("month").alias("AñoMes"))
        .agg(distinct_users().alias("Jugadores_Activos_Mes"))
        .orderBy("AñoMes")
    )


def revenue_daily(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"))
        .agg(money().alias("Recaudacion"))
        .orderBy("Fecha_Dia")
    )


def bets_per_user(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_bet"), "doc_id")
        .groupBy(F.col("doc_id").alias("Documento"))
        .agg(counted().alias("Bets_Total"), money().alias("Gastado_Total"))
    )


def game_list(facts: DataFrame) -> DataFrame:
    return with_keys(facts.where("is_bet"), "game").select(F.col("game").alias("Juego")).distinct()


def date_bounds(facts: DataFrame) -> DataFrame:
    """First and last day with a load."""
    return facts.where("is_load").agg(
        F.min("day").alias("Fecha_Min"), F.max("day").alias("Fecha_Max")
    )


def game_calendar(facts: DataFrame, top: int = 6, start=None, end=None) -> DataFrame:
    """Bets per calendar day for the most played games.

    Days without a bet show 0, days outside ``start``..``end`` show NULL. The spine
    is at most ``top`` games by the days between the first and the last bet.
    """
    played = with_keys(facts.where("is_bet"), "game")
    cells = played.groupBy("day", F.col("game").alias("Juego")).agg(counted().alias("bets"))
    # A game carries its own days, at most one entry per calendar day, so that the
    # chosen games need no second pass over the bets.
    cell = F.when(F.col("day").isNotNull(), F.struct("day", "bets"))
    games = (
        cells.groupBy("Juego")
        .agg(
            F.sum("bets").alias("total"),
            F.map_from_entries(F.collect_list(cell)).alias("by_day"),
        )
        .orderBy(F.desc("total"), "Juego")
        .limit(top)
    )
    bounds = played.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = F.sequence(bounds.select("lo").scalar(), bounds.select("hi").scalar())
    day = F.col("Fecha_Dia")
    shown = F.coalesce(F.try_element_at("by_day", day), F.lit(0))
    if start is not None:
        shown = F.when(day >= F.to_date(M.wall_time(start)), shown)
    if end is not None:
        shown = F.when(day <= F.to_date(M.wall_time(end)), shown)
    return (
        games.select("Juego", "by_day", F.explode(days).alias("Fecha_Dia"))
        .select("Fecha_Dia", "Juego", shown.cast("bigint").alias("Bets"))
        .orderBy("Fecha_Dia", "Juego")
    )


def enriched_bets(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Every bet of a registered user with the user's contact data.

    A large join on the user key; adaptive execution splits the partition of a user
    with very many bets. Needs the classified ledger.
    """
    bets = with_keys(facts.where("is_bet"), "doc_id").select(
        F.col("ts").alias("Fecha"),
        F.col("doc_id").alias("Documento"),
        F.col("game").alias("Juego"),
        F.col("amount").alias("Importe"),
    )
    people = users.select(
        F.col("user_id").alias("Documento"),
        F.col("username").alias("Usuario"),
        F.col("email").alias("Correo"),
    )
    return bets.join(people, "Documento").select(
        "Fecha", "Documento", "Usuario", "Correo", "Juego", "Importe"
    )


def dynamic_top(
    facts: DataFrame, users: DataFrame, game: str, start, end, top: int = 10, as_text: bool = False
) -> DataFrame:
    """Highest spenders on one game within a time range.

    Bets are summed per user before the users join, so the join meets one row per
    user. Needs the classified ledger.
    """
    spent = (
        with_keys(day_range(facts.where(F.col("is_bet") & (F.col("game") == game)), "ts", start, end), "doc_id")
        .groupBy(F.col("doc_id").alias("Documento"))
        .agg(money().alias("Total_Gastado"), counted().alias("Total_Apuestas"))
    )
    people = users.select(
        F.col("user_id").alias("Documento"),
        F.col("username").alias("Usuario"),
        F.col("email").alias("Correo"),
    ).dropna(subset=["Usuario", "Correo"])
    best = (
        spent.join(people, "Documento")
        .select("Documento", "Usuario", "Correo", "Total_Gastado", "Total_Apuestas")
        .orderBy(F.desc("Total_Gastado"), "Documento")
        .limit(top)
    )
    if as_text:
        best = best.withColumn("Total_Gastado", money_text(F.col("Total_Gastado")))
    return best

"""Per-user reports: first movements, retention, growth, milestones, contacts, inactivity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import movement as M
from ledgerlens.functions.rules import Rules
from ledgerlens.operators.bets import bets_per_user, game_player_summary
from ledgerlens.operators.buckets import time_bucket
from ledgerlens.operators.common import is_modo_load, labelled, with_keys
from ledgerlens.operators.dedup import keep_one

CONTACT = {"user_id": "DNI", "username": "Usuario", "email": "Correo"}


def _contacts(users: DataFrame) -> DataFrame:
    return users.select(*[F.col(c).alias(name) for c, name in CONTACT.items()])


def _first_values(facts: DataFrame, time_name: str) -> DataFrame:
    """Per user, the first non-null value of each column by time, which need not
    come from one row. A plain aggregation: partial results combine before the shuffle."""
    order = F.struct(F.col("ts").isNull(), F.col("ts"), F.col("tx_id"))
    columns = {
        "tx_id": "Nro_Transaccion",
        "movement_type": "Tipo_Mov",
        "description": "Movimiento",
        "amount": "Importe",
    }
    return (
        with_keys(facts, "doc_id")
        .groupBy(F.col("doc_id").alias("Documento"))
        .agg(
            F.min("ts").alias(time_name),
            *[
                F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(name)
                for c, name in columns.items()
            ],
        )
        .withColumn("Importe", F.col("Importe").cast("double"))
    )


def first_movement(facts: DataFrame) -> DataFrame:
    return _first_values(facts, "Fecha_PrimerMov")


def first_channel_load(facts: DataFrame) -> DataFrame:
    return _first_values(facts.where(is_modo_load()), "Fecha_Corte")


def channel_retention(facts: DataFrame) -> DataFrame:
    """What each user did after the first MODO load.

    Bets shrink to one row per user and day (first and last bet time) before they
    meet the cut time. That is exact: a bet in ``(cut, cut + d]`` with d of a day or
    more exists if and only if some day has a last bet after the cut and a first bet
    no later than ``cut + d``. The ledger is read once and no user's detail is
    gathered in one place.
    """
    modo = is_modo_load()
    days = (
        with_keys(facts, "doc_id")
        .groupBy("doc_id", "day")
        .agg(
            F.min("first_ts").alias("seen"),
            F.bool_or(modo).alias("loaded"),
            F.min(F.when(modo, F.col("first_ts"))).alias("load"),
            F.min(F.when(F.col("is_bet"), F.col("first_ts"))).alias("bet_lo"),
            F.max(F.when(F.col("is_bet"), F.col("last_ts"))).alias("bet_hi"),
        )
    )
    user = Window.partitionBy("doc_id")
    marked = days.withColumns(
        {
            "any_load": F.bool_or("loaded").over(user),
            "cut": F.min("load").over(user),
            "first": F.min("seen").over(user),
        }
    ).where("any_load")
    later = F.col("bet_hi") > F.col("cut")

    def within(interval: str):
        return later & (F.col("bet_lo") <= F.col("cut") + F.expr(interval))

    def any_of(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    return (
        marked.groupBy(
            F.col("doc_id").alias("Documento"),
            F.col("cut").alias("Fecha_Corte"),
            F.col("first").alias("Fecha_PrimerMov"),
        )
        .agg(
            any_of(later).alias("Jugo_Posterior"),
            any_of(within("INTERVAL 1 DAY")).alias("Jugo_Dia_Sig"),
            any_of(within("INTERVAL 30 DAYS")).alias("Jugo_Mes_Sig"),
        )
        .withColumn(
            "Es_Nuevo", F.coalesce(F.col("Fecha_PrimerMov") == F.col("Fecha_Corte"), F.lit(False))
        )
    )


def new_channel_users(facts: DataFrame) -> DataFrame:
    """Number of users whose first movement is their first MODO load."""
    per_user = (
        with_keys(facts, "doc_id")
        .groupBy("doc_id")
        .agg(
            F.min("first_ts").alias("first"),
            F.min(F.when(is_modo_load(), F.col("first_ts"))).alias("cut"),
        )
    )
    return per_user.agg(
        F.count_if(F.coalesce(F.col("first") == F.col("cut"), F.lit(False))).alias("Nuevos_MODO")
    )


def monthly_growth(facts: DataFrame) -> DataFrame:
    """New users, their running total and active players per month.

    A user-month roll-up answers all three from one read of the ledger. The running
    total runs over calendar months, a handful of rows.
    """
    user_months = (
        with_keys(facts, "doc_id", "month")
        .groupBy("doc_id", "month")
        .agg(F.bool_or("is_bet").alias("bet"))
    )
    first = F.min("month").over(Window.partitionBy("doc_id"))
    months = (
        user_months.withColumn("is_first", F.col("month") == first)
        .groupBy(F.col("month").alias("AñoMes"))
        .agg(
            F.count_if("is_first").alias("Nuevos"),
            F.nullif(F.count_if("bet"), F.lit(0)).alias("Jugadores_Activos_Mes"),
        )
        .where("Nuevos > 0")
    )
    running = Window.orderBy("AñoMes").rowsBetween(Window.unboundedPreceding, 0)
    return months.select(
        "AñoMes",
        "Nuevos",
        F.sum("Nuevos").over(running).alias("Acumulado"),
        "Jugadores_Activos_Mes",
    ).orderBy("AñoMes")


def milestone_counts(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Six user counts since the two milestones, from one row of flags per user."""
    launch, start = M.wall_time(rules.launch), M.wall_time(rules.channel_start)
    bet, last = F.col("is_bet"), F.col("last_ts")
    new_game = M.matches_game(F.col("game_norm"), rules.new_games_pattern)

    def any_of(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    per_user = (
        with_keys(facts, "doc_id")
        .groupBy("doc_id")
        .agg(
            F.min("first_ts").alias("first"),
            any_of(bet & (last >= launch)).alias("bet_launch"),
            any_of(bet & (last >= launch) & new_game).alias("new_game"),
            any_of(is_modo_load() & (last >= start)).alias("modo"),
            any_of(bet & (last >= start)).alias("bet_start"),
        )
    )
    counts = per_user.agg(
        F.count_if(F.col("first") >= launch).alias("c1"),
        F.count_if("bet_launch").alias("c2"),
        F.count_if("new_game").alias("c3"),
        F.count_if("modo").alias("c4"),
        F.count_if("bet_start").alias("c5"),
        F.count_if(F.col("modo") & F.col("bet_start")).alias("c6"),
    )
    a, b = f"{rules.launch:%Y-%m-%d}", f"{rules.channel_start:%Y-%m-%d}"
    # Row labels.
    labels = [
        f"Nuevos >= {a} (cualquier mov.)",
        f"Jugadores >= {a} (cualquier apuesta)",
        f"Apostaron Quini/Loto >= {a}",
        f"Recargaron MODO >= {b}",
        f"Jugadores >= {b} (cualquier apuesta)",
        f"Recargaron MODO y jugaron >= {b}",
    ]
    entries = [(text, [F.col(f"c{i}")]) for i, text in enumerate(labels, start=1)]
    return labelled(counts, "Concepto", entries, ["Valor"])


def contact_top(facts: DataFrame, users: DataFrame, top: int = 10) -> DataFrame:
    """Registered users with most bets."""
    joined = bets_per_user(facts).join(_contacts(users), F.col("Documento") == F.col("DNI"))
    return joined.orderBy(F.desc("Bets_Total"), "Documento").limit(top)


def game_top_users(facts: DataFrame, users: DataFrame, rules: Rules = Rules(), top: int = 10) -> DataFrame:
    """Registered users with the highest spend on each named game."""
    joined = game_player_summary(facts, rules).join(
        _contacts(users), F.col("Documento") == F.col("DNI")
    )
    return keep_top(joined, ["Juego"], [F.desc("Gastado"), F.asc("Documento")], top)


def keep_top(df: DataFrame, keys: list[str], ordering: list, top: int) -> DataFrame:
    """First ``top`` rows per key; Spark cuts every map task's groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= top).drop("_rank")


def new_users_since(users: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return users.where(F.col("signup_ts") >= M.wall_time(rules.channel_start)).select(
        F.col("user_id").alias("Documento"),
        F.col("signup_ts").alias("Fecha_Alta"),
        F.col("username").alias("Usuario"),
        F.col("email").alias("Correo"),
    )


def new_users_total(users: DataFrame, rules: Rules = Rules()) -> DataFrame:
    label = f"Total Nuevos Usuarios desde {rules.channel_start:%d/%m/%Y}"
    return new_users_since(users, rules).agg(F.count("*").alias("Valor")).select(
        F.lit(label).alias("KPI"), "Valor"
    )


def reactivated_users(facts: DataFrame, users: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Users who signed up in the old years and whose first MODO load came after its start."""
    first_load = (
        with_keys(facts.where(is_modo_load()), "doc_id", "first_ts")
        .groupBy(F.col("doc_id").alias("Documento"))
        .agg(F.min("first_ts").alias("Fecha"))
        .where(F.col("Fecha") >= M.wall_time(rules.channel_start))
    )
    lo, hi = rules.old_signup_years
    old = users.where(F.year("signup_ts").between(lo, hi)).select(
        F.col("user_id").alias("Documento"),
        F.col("signup_ts").alias("Fecha_Alta"),
        F.col("username").alias("Usuario"),
        F.col("email").alias("Correo"),
        *[c for c in users.columns if c not in ("user_id", "signup_ts", "username", "email")],
    )
    return old.join(first_load, "Documento")


def first_event(facts: DataFrame, bucket_hours: int = 6) -> DataFrame:
    """Per bettor: first bet, first load after it and next bet after it.

    "After the first bet" is solved inside one time bucket and then across the
    user's buckets. A user's detail rows are thus spread over the buckets, and only
    one row per user and bucket meets in one place. Needs the classified ledger.
    """
    rows = with_keys(facts.where("is_bet or is_load"), "doc_id", "ts").select(
        "doc_id",
        time_bucket(F.col("ts"), bucket_hours).alias("bucket"),
        F.when(F.col("is_bet"), F.col("ts")).alias("bet"),
        F.when(F.col("is_load"), F.col("ts")).alias("load"),
    )
    cell = Window.partitionBy("doc_id", "bucket")
    buckets = (
        rows.withColumn("bet_lo", F.min("bet").over(cell))
        .groupBy("doc_id", "bucket")
        .agg(
            F.min("bet_lo").alias("bet"),
            F.min("load").alias("load"),
            F.min(F.when(F.col("bet") > F.col("bet_lo"), F.col("bet"))).alias("bet_next"),
            F.min(F.when(F.col("load") > F.col("bet_lo"), F.col("load"))).alias("load_next"),
        )
    )
    first = F.min("bet").over(Window.partitionBy("doc_id"))
    here, later = F.col("bet") == F.col("first"), F.col("bucket") > time_bucket(F.col("first"), bucket_hours)
    return (
        buckets.withColumn("first", first)
        .where("first is not null")
        .groupBy(F.col("doc_id").alias("Documento"), F.col("first").alias("Fecha_Primera_Apuesta"))
        .agg(
            F.min(F.when(here, F.col("load_next")).when(later, F.col("load"))).alias(
                "Fecha_Recarga_Posterior"
            ),
            F.min(F.when(here, F.col("bet_next")).when(later, F.col("bet"))).alias(
                "Fecha_Segunda_Apuesta"
            ),
        )
    )


def cohort_retention(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Bettors per sign-up month and how many loaded and bet again after the first bet.

    A later bet exists if the last bet is after the first, a later load if the last
    load is. One aggregation per user answers both; no detail is joined back. The
    name says 30 days but no such bound applies, and the 7-day rate has no values.
    """
    bet, load = F.col("is_bet"), F.col("is_load")
    per_user = (
        with_keys(facts.where("is_bet or is_load"), "doc_id")
        .groupBy(F.col("doc_id").alias("user_id"))
        .agg(
            F.min(F.when(bet, F.col("first_ts"))).alias("first_bet"),
            F.max(F.when(bet, F.col("last_ts"))).alias("last_bet"),
            F.max(F.when(load, F.col("last_ts"))).alias("last_load"),
        )
        .where("first_bet is not null")
        .select(
            "user_id",
            F.coalesce(
                (F.col("last_bet") > F.col("first_bet")) & (F.col("last_load") > F.col("first_bet")),
                F.lit(False),
            ).alias("kept"),
        )
    )
    cohorts = with_keys(
        users.select("user_id", M.month_text(F.col("signup_ts")).alias("Cohorte_Mes")), "Cohorte_Mes"
    )
    return (
        cohorts.join(per_user, "user_id")
        .groupBy("Cohorte_Mes")
        .agg(
            F.count_distinct("user_id").alias("Total_Nuevos_Usuarios"),
            F.count_if("kept").alias("Retenidos_30_Dias"),
        )
        .select(
            "Cohorte_Mes",
            "Total_Nuevos_Usuarios",
            "Retenidos_30_Dias",
            (
                F.try_divide(F.col("Retenidos_30_Dias"), F.col("Total_Nuevos_Usuarios")) * 100
            ).alias("Tasa_Retencion_30_Dias"),
            F.lit(None).cast("double").alias("Tasa_Retencion_7_Dias"),
        )
        .orderBy("Cohorte_Mes")
    )


def inactive_users(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Registered users without any movement."""
    active = with_keys(facts, "doc_id").select(F.col("doc_id").alias("user_id")).distinct()
    return users.where(F.col("user_id").isNotNull()).join(active, "user_id", "left_anti")

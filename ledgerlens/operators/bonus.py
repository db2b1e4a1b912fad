"""Bonuses and what their receivers did afterwards.

Definitions (no producer of these tables is known, so they are choices):

* a bonus is a movement whose type mentions a bonus; its label is ``Registro`` when
  type or description mention a sign-up, else ``Depósito``;
* the first bet after a bonus is the user's earliest strictly later bet;
* a bonus is exhausted at the earliest later bet with which the stakes placed since
  the bonus reach its amount; stakes are amounts, negative ones count as 0;
* the user loaded again if any load is later than that bet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.movement import wall_time
from ledgerlens.operators.buckets import time_bucket
from ledgerlens.operators.common import counted, money, to_money, with_keys

SIGNUP, DEPOSIT = "Registro", "Depósito"

# Role of a row, and its place within its bucket.
_BET, _BONUS = 0, 1
_OPENING, _DETAIL, _CLOSING = 0, 1, 2


def bonus_detail(
    facts: DataFrame,
    users: DataFrame | None = None,
    receivers: DataFrame | None = None,
    bonuses_per_task: int = 1_000_000,
    bucket_hours: int = 6,
) -> DataFrame:
    """One row per bonus with the times of its first bet and its exhaustion.

    Both are searches for the next bet of the same user, by time and by cumulative
    stake. A user's history is cut into time buckets. Per user only one row per bucket
    meets (prefix stake, next bet in a later bucket, last load); detail rows meet only
    those of their own bucket. The search by stake first finds the bucket from the
    bucket totals, with a user's bonuses dealt over several groups when there are
    many, then the bet inside it. All windows run forward once, so the work is linear
    and no pair of rows is ever built; the detail moves through three windows.

    ``receivers`` (``doc_id``, every user with a bonus) keeps the movements of all
    other users out of the shuffles; worth giving when it is small enough to
    broadcast. Needs the classified ledger.
    """
    # A bonus is a movement with an amount, here as in bonus_daily.
    rows = (
        with_keys(facts.withColumn("is_bonus", F.col("is_bonus") & (F.col("n") > 0)), "doc_id", "ts")
        .where("is_bet or is_bonus or is_load")
        .withColumn("bucket", time_bucket(F.col("ts"), bucket_hours))
        .withColumn("stake", F.coalesce(F.greatest("cents", F.lit(0)), F.lit(0)))
    )
    if receivers is not None:
        rows = rows.join(receivers.select("doc_id"), "doc_id", "left_semi")
    timed = _with_next_bet(rows, _buckets(rows, bonuses_per_task))
    detail = _with_spent_time(_with_goal_bucket(timed))
    if users is not None:
        people = users.select(F.col("user_id").alias("doc_id"), F.col("email").alias("Email"))
        detail = detail.join(people, "doc_id", "left")
    else:
        detail = detail.withColumn("Email", F.lit(None).cast("string"))
    return detail.select(
        F.col("tx_id").alias("Nro_Transaccion"),
        F.col("doc_id").alias("DNI_NORM"),
        "Email",
        F.col("ts").alias("Fecha_Bono"),
        to_money(F.col("bonus_cents")).alias("Monto_Bono"),
        F.col("bonus_type").alias("Tipo_Bono"),
        F.col("first_bet").isNotNull().alias("Hizo_Jugada_PostBono"),
        F.col("first_bet").alias("Fecha_Primera_Jugada"),
        F.col("spent_ts").alias("Fecha_Agote_Bono"),
        F.coalesce(F.col("last_load") > F.col("spent_ts"), F.lit(False)).alias("Recargo_despues_Agote"),
    )


def _buckets(rows: DataFrame, bonuses_per_task: int) -> DataFrame:
    """One row per user and bucket: stake before it, next bet after it, the user's last
    load and the number of groups for the search by stake."""
    per_bucket = rows.groupBy("doc_id", "bucket").agg(
        F.coalesce(F.sum(F.when(F.col("is_bet"), F.col("stake"))), F.lit(0)).alias("staked"),
        F.min(F.when(F.col("is_bet"), F.col("ts"))).alias("bucket_bet"),
        F.max(F.when(F.col("is_load"), F.col("ts"))).alias("bucket_load"),
        F.count_if("is_bonus").alias("bucket_bonuses"),
    )
    user = Window.partitionBy("doc_id")
    earlier = user.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    later = user.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        "doc_id",
        "bucket",
        F.coalesce(F.sum("staked").over(earlier), F.lit(0)).alias("staked_before"),
        F.min("bucket_bet").over(later).alias("next_bet"),
        F.max("bucket_load").over(user).alias("last_load"),
        F.ceil(F.sum("bucket_bonuses").over(user) / F.lit(bonuses_per_task)).alias("groups"),
    )


def _with_next_bet(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Bets and bonuses of users with a bonus, with the user's cumulative stake and
    the next later bet, and one closing row per bucket with the stake up to its end.

    Inside a bucket, rows run in time order with bets before bonuses of the same
    time. Two rows framing the bucket carry what lies outside: ahead of it the stake
    so far, behind it the next bet.
    """
    none = F.lit(None)
    roles = F.array_compact(
        F.array(F.when(F.col("is_bet"), F.lit(_BET)), F.when(F.col("is_bonus"), F.lit(_BONUS)))
    )
    detail = rows.where("is_bet or is_bonus").withColumn("role", F.explode(roles)).select(
        "doc_id",
        "bucket",
        F.lit(_DETAIL).alias("place"),
        "ts",
        "role",
        "tx_id",
        F.when(F.col("role") == _BET, F.col("stake")).otherwise(0).cast("bigint").alias("stake"),
        F.when(F.col("role") == _BET, F.col("ts")).alias("bet_ts"),
        F.when(F.col("role") == _BONUS, F.coalesce("cents", F.lit(0))).alias("bonus_cents"),
        F.when(
            F.col("role") == _BONUS, F.when(F.col("is_signup_bonus"), SIGNUP).otherwise(DEPOSIT)
        ).alias("bonus_type"),
        none.cast("timestamp_ntz").alias("last_load"),
        none.cast("bigint").alias("groups"),
    )
    frame = buckets.select(
        "doc_id",
        "bucket",
        F.explode(F.array(F.lit(_OPENING), F.lit(_CLOSING))).alias("place"),
        none.cast("timestamp_ntz").alias("ts"),
        none.cast("int").alias("role"),
        none.cast("bigint").alias("tx_id"),
        F.when(F.col("place") == _OPENING, F.col("staked_before"))
        .otherwise(0)
        .cast("bigint")
        .alias("stake"),
        F.when(F.col("place") == _CLOSING, F.col("next_bet")).alias("bet_ts"),
        none.cast("bigint").alias("bonus_cents"),
        none.cast("string").alias("bonus_type"),
        "last_load",
        "groups",
    )
    over = "OVER (PARTITION BY doc_id, bucket ORDER BY place, ts, role, tx_id"
    running = f"{over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        detail.unionByName(frame.where("groups > 0"))
        .withColumns(
            {
                "staked": F.expr(f"sum(stake) {running}"),
                "first_bet": F.expr(f"lead(bet_ts) IGNORE NULLS {over})"),
                "last_load": F.expr(f"first(last_load) {running}"),
                "groups": F.expr(f"first(groups) {running}"),
            }
        )
        .where(F.col("groups").isNotNull() & (F.col("place") != _OPENING))
        .drop("stake", "bet_ts")
    )


def _with_goal_bucket(timed: DataFrame) -> DataFrame:
    """Bets, and bonuses with the bucket in which the user's stakes reach their goal.

    The goal is the stake at the bonus plus its amount. The first closing row at or
    above it names the bucket; each of a user's groups has its own copy of them. Bets
    stay in groups of their own, one per bucket.
    """
    is_bonus, is_closing = F.col("role") == _BONUS, F.col("place") == _CLOSING
    own = -1 - F.col("bucket")
    groups = (
        F.when(is_closing, F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1))
        .when(is_bonus, F.array(F.pmod(F.xxhash64("tx_id"), "groups")))
        .otherwise(F.array(own))
    )
    goal = F.when(is_bonus, F.col("staked") + F.col("bonus_cents")).otherwise(F.col("staked"))
    reach = F.expr(
        "lead(mark) IGNORE NULLS OVER (PARTITION BY doc_id, grp ORDER BY goal, mark NULLS FIRST)"
    )
    return (
        timed.withColumns(
            {
                "grp": F.explode(groups),
                "goal": goal,
                "mark": F.when(is_closing, F.col("bucket")),
            }
        )
        .withColumn("reach", reach)
        .where(F.col("place") == _DETAIL)
        .withColumn(
            "cell",
            # Bonuses without a goal bucket get a cell without bets.
            F.when(is_bonus, F.when(F.col("bonus_cents") > 0, F.col("reach")))
            .when(F.col("role") == _BET, F.col("bucket")),
        )
        .withColumn("cell", F.coalesce("cell", -1 - F.col("grp")))
    )


def _with_spent_time(marked: DataFrame) -> DataFrame:
    """Bonuses with the bet that reaches their goal, searched among the bets of its bucket.

    A bonus of nothing is spent with the next bet.
    """
    spent = F.expr(
        "lead(bet_ts) IGNORE NULLS OVER"
        " (PARTITION BY doc_id, cell ORDER BY goal, role DESC, ts, tx_id)"
    )
    return (
        marked.withColumn("bet_ts", F.when(F.col("role") == _BET, F.col("ts")))
        .withColumn("spent_ts", spent)
        .where(F.col("role") == _BONUS)
        .withColumn(
            "spent_ts", F.when(F.col("bonus_cents") > 0, F.col("spent_ts")).otherwise(F.col("first_bet"))
        )
    )


def bonus_daily(facts: DataFrame) -> DataFrame:
    """Bonuses granted per day, in total and by type."""
    return (
        with_keys(facts.where("is_bonus"), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"))
        .agg(
            counted().alias("Bonos_Otorgados"),
            money().alias("Monto_Bonos"),
            counted(F.col("is_signup_bonus")).alias("Registro_Cant"),
            counted(~F.col("is_signup_bonus")).alias("Deposito_Cant"),
        )
        .orderBy("Fecha_Dia")
    )


def bonus_kpis(daily: DataFrame, detail: DataFrame) -> DataFrame:
    """The bonuses of :func:`bonus_daily` with how many were played, exhausted and followed
    by a load. Bonuses without a user count as granted and reach no stage."""
    stages = detail.groupBy(F.to_date("Fecha_Bono").alias("Fecha_Dia")).agg(
        F.count_if("Hizo_Jugada_PostBono").alias("Jugaron_PostBono"),
        F.count_if(F.col("Fecha_Agote_Bono").isNotNull()).alias("Agotaron_Bono"),
        F.count_if("Recargo_despues_Agote").alias("Recargaron_Luego"),
    )
    reached = [F.coalesce(c, F.lit(0)).alias(c) for c in stages.columns[1:]]
    return (
        daily.join(stages, "Fecha_Dia", "left")
        .select("Fecha_Dia", "Bonos_Otorgados", "Monto_Bonos", *reached, "Registro_Cant", "Deposito_Cant")
        .orderBy("Fecha_Dia")
    )


def _percent(part: str):
    rate = F.try_divide(F.col(part), F.col("Bonos_Otorgados")) * 100
    return F.coalesce(rate, F.lit(0.0))


def bonus_rates(kpis: DataFrame, start, end) -> DataFrame:
    """Totals of a date range and the share of bonuses reaching each stage, one row."""
    counts = ["Bonos_Otorgados", "Jugaron_PostBono", "Agotaron_Bono", "Recargaron_Luego"]
    total = in_period(kpis, "Fecha_Dia", start, end).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.sum(F.col("Monto_Bonos").cast("decimal(38,2)")), F.lit(0)).cast("double").alias("Monto_Bonos"),
    )
    return total.select(
        *counts,
        "Monto_Bonos",
        _percent("Jugaron_PostBono").alias("Pct_Jugaron"),
        _percent("Agotaron_Bono").alias("Pct_Agotaron"),
        _percent("Recargaron_Luego").alias("Pct_Recargaron"),
    )


def bonus_funnel(rates: DataFrame) -> DataFrame:
    # Stage labels.
    stages = rates.select(
        F.col("Pct_Jugaron").alias("Jugaron tras bono"),
        F.col("Pct_Agotaron").alias("Agotaron el bono"),
        F.col("Pct_Recargaron").alias("Recargaron después"),
    )
    return stages.unpivot([], stages.columns, "Etapa", "Porcentaje")


def in_period(df: DataFrame, column: str, start, end) -> DataFrame:
    """Whole-day range on a date or time column."""
    return df.where(
        F.to_date(F.col(column)).between(F.to_date(wall_time(start)), F.to_date(wall_time(end)))
    )


def bonus_by_type(daily: DataFrame, start, end) -> DataFrame:
    """Daily bonus counts in long form; an absent type column counts as 0."""
    # Column and label of a type.
    types = {"Registro_Cant": SIGNUP, "Deposito_Cant": DEPOSIT}
    period = in_period(daily, "Fecha_Dia", start, end)
    return (
        period.select(
            "Fecha_Dia",
            *[
                (F.col(c) if c in daily.columns else F.lit(0)).cast("string").try_cast("double").alias(label)
                for c, label in types.items()
            ],
        )
        .unpivot(["Fecha_Dia"], list(types.values()), "Tipo", "Cantidad")
        .withColumn("Cantidad", F.coalesce("Cantidad", F.lit(0.0)))
        .orderBy("Fecha_Dia", "Tipo")
    )

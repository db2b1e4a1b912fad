"""Reports on wallet loads, withdrawals and prizes. Input: classified ledger or daily roll-up."""

from __future__ import annotations

from datetime import datetime, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.movement import wall_time
from ledgerlens.functions.rules import MODO, RETAIL, Rules
from ledgerlens.operators.common import (
    cents_sum,
    counted,
    distinct_users,
    exact,
    is_modo_load,
    labelled,
    money,
    to_money,
    with_keys,
)


def loads_daily_channel(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_load"), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"), F.col("channel").alias("Canal"))
        .agg(
            counted().alias("Recargas"),
            money().alias("Monto"),
            distinct_users().alias("Usuarios_Unicos"),
        )
        .orderBy("Fecha_Dia", "Canal")
    )


def _channel_pivot(facts: DataFrame, rules: Rules, cell) -> DataFrame:
    # The channels are known, so one conditional sum per channel does in a single
    # aggregation what pivot() does in two.
    cells = [cell(F.col("channel") == c).alias(c) for c in rules.channels]
    return (
        with_keys(facts.where("is_load"), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"))
        .agg(*cells)
        .orderBy("Fecha_Dia")
    )


def loads_daily_amount_pivot(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return _channel_pivot(facts, rules, money)


def loads_daily_count_pivot(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return _channel_pivot(facts, rules, counted)


def _average(condition: Column | None = None) -> Column:
    return F.try_divide(money(condition), counted(condition))


def avg_deposit_daily(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Daily amount over daily count per channel; NULL on a day without loads."""
    return _channel_pivot(facts, rules, _average)


def channel_daily(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where(is_modo_load()), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"))
        .agg(
            counted().alias("Recargas_MODO"),
            money().alias("Monto_MODO"),
            distinct_users().alias("Usuarios_Unicos"),
        )
        .orderBy(F.desc("Fecha_Dia"))
    )


def withdrawals_daily(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_withdrawal"), "day")
        .groupBy(F.col("day").alias("Fecha_Dia"))
        .agg(
            counted().alias("Retiros"),
            money().alias("Monto_Retirado"),
            distinct_users().alias("Clientes_Unicos"),
        )
        .orderBy(F.desc("Fecha_Dia"))
    )


def winners(facts: DataFrame) -> DataFrame:
    return (
        with_keys(facts.where("is_prize"), "doc_id")
        .groupBy(F.col("doc_id").alias("Documento"))
        .agg(counted().alias("Premios_Cobrados"), money().alias("Monto_Premios"))
        .orderBy(F.desc("Monto_Premios"), "Documento")
    )


def loads_by_channel(facts: DataFrame) -> DataFrame:
    return (
        facts.where("is_load")
        .groupBy(F.col("channel").alias("Canal"))
        .agg(
            counted().alias("Recargas"),
            distinct_users().alias("Usuarios_Unicos"),
            money().alias("Monto"),
        )
    )


def before_after(facts: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Load and bet sums on both sides of the channel start.

    On a daily roll-up the start must be a midnight, as a row covers a day.
    """
    cut = wall_time(rules.channel_start)
    before, after = F.col("last_ts") < cut, F.col("first_ts") >= cut
    sums = facts.where("is_load or is_bet").agg(
        *[
            money(F.col(kind) & side).alias(f"{kind}_{name}")
            for kind in ("is_load", "is_bet")
            for name, side in (("before", before), ("after", after))
        ]
    )
    day = f"{rules.channel_start:%d/%m/%Y}"
    return labelled(
        sums,
        "Periodo",
        [
            (f"Before {day}", [F.col("is_load_before"), F.col("is_bet_before")]),
            (f"After {day}", [F.col("is_load_after"), F.col("is_bet_after")]),
        ],
        ["Depositos_$", "Recaudacion_$"],
    )


def modo_movements(facts: DataFrame) -> DataFrame:
    """Ledger slice: every MODO load. Needs the classified ledger."""
    return facts.where(is_modo_load()).select(
        F.col("doc_id").alias("Documento"),
        F.col("ts").alias("Fecha"),
        F.col("amount").alias("Importe"),
    )


def period_kpis(
    facts: DataFrame, start, end, users: DataFrame | None = None, inclusive_end: bool = False
) -> DataFrame:
    """Dashboard figures of a date range, one row.

    Day series are cut by day. Bettors are cut by time, so a bare end date leaves
    out the bets later on that day unless ``inclusive_end`` is set. With ``users``
    only registered bettors count. Loads of both channels stand in for the number
    of users who loaded, as no finer source is kept. Bounds inside a day need the
    classified ledger: the roll-up does not hold single times.
    """
    inside = [b for b in (start, *(() if inclusive_end else (end,))) if isinstance(b, datetime) and b.time() != time()]
    if inside and "ts" not in facts.columns:
        raise ValueError(f"a roll-up by day cannot be cut at {inside[0]}")
    day, start_day, end_day = F.col("day"), F.to_date(wall_time(start)), F.to_date(wall_time(end))
    in_days = (day >= start_day) & (day <= end_day)
    until = F.to_date(F.col("first_ts")) <= end_day if inclusive_end else (
        F.col("first_ts") <= wall_time(end)
    )
    in_time = (F.col("last_ts") >= wall_time(start)) & until
    modo = F.col("is_load") & in_days & (F.col("channel") == MODO)
    retail = F.col("is_load") & in_days & (F.col("channel") == RETAIL)

    # Per user first: sums combine in the map tasks and the distinct count is a plain sum.
    # The bounds on the time column itself reach the Parquet scan.
    seen = facts.where("is_load or is_bet").where(
        (F.col("first_ts") >= start_day.cast("timestamp_ntz"))
        & (F.col("first_ts") < F.date_add(end_day, 1).cast("timestamp_ntz"))
    )
    per_user = seen.groupBy("doc_id").agg(
        counted(modo).alias("modo_n"),
        counted(retail).alias("retail_n"),
        cents_sum(modo).alias("modo_amount"),
        cents_sum(retail).alias("retail_amount"),
        cents_sum(F.col("is_bet") & in_days).alias("revenue"),
        F.coalesce(F.bool_or(F.col("is_bet") & in_time), F.lit(False)).alias("bet"),
    )
    if users is not None:
        known = users.select(F.col("user_id").alias("doc_id")).distinct().withColumn("known", F.lit(True))
        per_user = per_user.join(known, "doc_id", "left")
    else:
        per_user = per_user.withColumn("known", F.lit(True))
    total = per_user.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("modo_n", "retail_n")],
        *[
            to_money(F.coalesce(F.sum(exact(c)), F.lit(0))).alias(c)
            for c in ("modo_amount", "retail_amount", "revenue")
        ],
        F.count_if(F.col("bet") & F.col("known") & F.col("doc_id").isNotNull()).alias("bettors"),
    )
    loads = F.col("modo_n") + F.col("retail_n")
    average = F.try_divide(F.col("modo_amount") + F.col("retail_amount"), loads)
    return total.select(
        F.coalesce(average, F.lit(0.0)).alias("Promedio_Deposito"),
        F.col("bettors").alias("Usuarios_Apostadores"),
        loads.alias("Usuarios_Recargaron"),
        F.col("revenue").alias("Recaudacion_Periodo"),
        F.col("modo_n").alias("Recargas_MODO"),
        F.col("retail_n").alias("Recargas_Retail"),
        F.col("modo_amount").alias("Monto_MODO"),
        F.col("retail_amount").alias("Monto_Retail"),
    )


def mean_daily_deposit(facts: DataFrame, start, end, rules: Rules = Rules()) -> DataFrame:
    """Mean over the range of the daily average deposits; days without loads do not count."""
    day = F.col("Fecha_Dia")
    in_days = (day >= F.to_date(wall_time(start))) & (day <= F.to_date(wall_time(end)))
    return (
        avg_deposit_daily(facts, rules)
        .where(in_days)
        .agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"Promedio_Diario_{c}") for c in rules.channels])
    )


def binary_channel_summary(facts: DataFrame) -> DataFrame:
    """Loads by channel and method; shows the effect of a load or channel variant."""
    return (
        facts.where("is_load")
        .groupBy(F.col("channel").alias("Canal"), F.col("method").alias("Metodo"))
        .agg(counted().alias("Recargas"), money().alias("Monto"), distinct_users().alias("Usuarios_Unicos"))
    )

"""KPI tables in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import MODO, RETAIL
from ledgerlens.operators.common import cents_sum, counted, exact, labelled, to_money, with_keys


def kpi_summary(facts: DataFrame) -> DataFrame:
    """Eight ledger KPIs.

    Grouped by user first, so the three distinct counts need no row expansion; rows
    without a user still count in the sums.
    """
    load, channel = F.col("is_load"), F.col("channel")
    per_user = facts.groupBy("doc_id").agg(
        F.bool_or("is_bet").alias("bet"),
        F.bool_or("is_load").alias("load"),
        counted(load).alias("n"),
        cents_sum(load).alias("amount"),
        counted(load & (channel == MODO)).alias("modo_n"),
        counted(load & (channel == RETAIL)).alias("retail_n"),
        cents_sum(load & (channel == MODO)).alias("modo_amount"),
        cents_sum(load & (channel == RETAIL)).alias("retail_amount"),
    )
    known = F.col("doc_id").isNotNull()
    total = per_user.agg(
        F.coalesce(
            F.try_divide(to_money(F.sum(exact("amount"))), F.sum("n")), F.lit(0.0)
        ).alias("mean"),
        F.count_if(known).cast("double").alias("users"),
        F.count_if(known & F.col("bet")).cast("double").alias("bettors"),
        F.count_if(known & F.col("load")).cast("double").alias("loaders"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c)
            for c in ("modo_n", "retail_n")
        ],
        *[
            to_money(F.coalesce(F.sum(exact(c)), F.lit(0))).alias(c)
            for c in ("modo_amount", "retail_amount")
        ],
    )
    # KPI labels.
    names = {
        "Promedio depósito $": "mean",
        "Usuarios únicos (cualquier mov.)": "users",
        "Usuarios únicos apostadores": "bettors",
        "Usuarios únicos que recargaron": "loaders",
        "Recargas - MODO": "modo_n",
        "Recargas - Retail": "retail_n",
        "Monto MODO $": "modo_amount",
        "Monto Retail $": "retail_amount",
    }
    return labelled(total, "KPI", [(k, [F.col(c)]) for k, c in names.items()], ["Valor"])


def activity_kpis(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Registered and active users; "inactive" is the difference of the two counts."""
    active = with_keys(facts, "doc_id").agg(F.count_distinct("doc_id").alias("active"))
    row = with_keys(users, "user_id").agg(F.count("*").cast("double").alias("registered")).select(
        "registered", active.scalar().cast("double").alias("active")
    )
    registered, active = F.col("registered"), F.col("active")
    # KPI labels.
    entries = [
        ("Total Usuarios Registrados", [registered]),
        ("Usuarios Activos (con mov.)", [active]),
        ("Usuarios Inactivos (sin mov.)", [registered - active]),
        ("Tasa de Actividad (%)", [F.coalesce(F.try_divide(active, registered) * 100, F.lit(0.0))]),
    ]
    return labelled(row, "KPI", entries, ["Valor"])

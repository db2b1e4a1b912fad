"""Ledgers and users derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.rules import Rules
from ledgerlens.schema import MONEY

EVENT_RULES = Rules(launch=datetime(2024, 1, 10), channel_start=datetime(2024, 1, 15))
ORDER_RULES = Rules(
    launch=datetime(1997, 4, 14), channel_start=datetime(1998, 7, 7), old_signup_years=(1994, 1997)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday movements of all kinds from ``events``."""
    event = F.col("event_type")
    # props is {"k": <number>}; cut, not matched, as the value enters many expressions.
    k = F.substr("props", F.lit(7), F.length("props") - 7).cast("int")
    games = F.array(*map(F.lit, ("Tombo Express", "Tómbola", "Quini 6", "Loto Plus")))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tx_id"),
        "ts",
        F.when(event == "purchase", "Jugada")
        .when(event == "click", "Carga saldo desde MODO")
        .when(event == "view", "Carga saldo desde TJ")
        .when(event == "signup", "Bonificación")
        .when(k % 2 == 0, "Retiro")
        .otherwise("Premio")
        .alias("movement_type"),
        F.col("user_id").alias("doc_id"),
        F.when(event == "purchase", F.concat(F.lit("Jugada - "), F.element_at(games, k % 4 + 1)))
        .when(event == "signup", F.when(k % 2 == 0, "Bono registro").otherwise("Bono depósito"))
        .otherwise(event)
        .alias("description"),
        F.col("value").cast(MONEY).alias("amount"),
    )


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bets and loads over many months from ``orders``."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_orderdate").alias("ts"),
        F.when(status == "F", "Jugada")
        .when(status == "O", "Carga saldo desde MODO")
        .when(status == "P", "Carga saldo desde TJ")
        .alias("movement_type"),
        F.col("o_custkey").alias("doc_id"),
        F.when(status == "F", F.concat(F.lit("Jugada - "), F.col("o_orderpriority")))
        .otherwise(status)
        .alias("description"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
    )


def users(spark: SparkSession, sf_dir: str, start: str) -> DataFrame:
    """User registry from ``customer`` with sign-ups spread over 1400 days."""
    day = F.date_add(F.lit(start).cast("date"), (F.col("c_custkey") * 9 % 1400).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        day.cast("timestamp_ntz").alias("signup_ts"),
    )


def event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir, "2020-06-01")


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir, "1994-06-01")

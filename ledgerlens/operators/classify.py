"""Classification of the ledger and the per-user daily roll-up.

Both results share the columns the reports read: the keys ``doc_id, day, game,
channel``, the kind flags, and the measures ``n`` (movements with an amount),
``cents``, ``first_ts`` and ``last_ts``. A report gives the same answer on either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import movement as M
from ledgerlens.functions.rules import Rules
from ledgerlens.functions.text import fold_text
from ledgerlens.operators.common import exact

KINDS = ("is_bet", "is_load", "is_withdrawal", "is_prize", "is_bonus")


def classify(ledger: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One projection over the ledger; Catalyst drops what a report does not read."""
    kind, text, ts = F.col("movement_type"), F.col("description"), F.col("ts")
    kind_low, kind_norm, text_norm = F.col("kind_low"), F.col("kind_norm"), F.col("text_norm")
    return (
        ledger.withColumns({"kind_low": F.lower(kind), "kind_norm": fold_text(kind)})
        .withColumns(
            {
                "is_bet": M.is_bet(kind_low, rules),
                "is_load": M.is_load(kind_low, kind_norm, rules),
                "is_withdrawal": M.is_withdrawal(kind_low, rules),
                "is_prize": M.is_prize(kind_low, rules),
                "is_bonus": M.is_bonus(kind_norm, rules),
                "day": F.to_date(ts),
                "hour": F.hour(ts),
                "n": F.col("amount").isNotNull().cast("int"),
                "cents": (F.col("amount") * 100).cast("bigint"),
                "first_ts": ts,
                "last_ts": ts,
            }
        )
        # Bets, most of a ledger, never need their description folded.
        .withColumn("text_norm", F.when(F.col("is_load") | F.col("is_bonus"), fold_text(text)))
        .withColumns(
            {
                "game": F.when(F.col("is_bet"), M.game_name(text, rules)),
                "channel": F.when(F.col("is_load"), M.channel(text_norm, kind_norm, rules)),
                "is_signup_bonus": F.when(
                    F.col("is_bonus"), M.is_signup_bonus(kind_norm, text_norm, rules)
                ),
                "month": M.month_text(F.col("day")),
            }
        )
        .withColumns(
            {
                "game_norm": fold_text(F.col("game")),
                "method": F.when(F.col("is_load"), M.method(F.col("channel"))),
            }
        )
        .drop("kind_low", "kind_norm", "text_norm")
    )


def daily_rollup(facts: DataFrame) -> DataFrame:
    """One row per user, day, kind, game and channel: the input of a whole report run.

    Rows combine before the shuffle, so a user or a day with a large share of the
    ledger leaves each map task as a handful of rows. Distinct users stay countable
    and first and last times stay exact.
    """
    keys = ["doc_id", "day", *KINDS, "is_signup_bonus", "game", "channel"]
    return (
        facts.groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.sum(exact("cents")).alias("cents"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
        .withColumns(
            {
                "month": M.month_text(F.col("day")),
                "game_norm": fold_text(F.col("game")),
                "method": F.when(F.col("is_load"), M.method(F.col("channel"))),
            }
        )
    )

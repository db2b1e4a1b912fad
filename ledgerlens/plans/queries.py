"""Every named query over the test tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import text as X
from ledgerlens.operators import bets, bonus, distinct, kpis, loads, users
from ledgerlens.operators.classify import classify, daily_rollup
from ledgerlens.operators.common import to_money
from ledgerlens.operators.dedup import keep_one
from ledgerlens.plans import adapters as A
from ledgerlens.plans import bundle

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (datetime(2024, 1, 5), datetime(2024, 1, 20))
MONTHS = (datetime(1996, 2, 20), datetime(1998, 7, 7))
TOP_GAME = "Tómbola"
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
]


#: Syllables, ligatures, fractions and letters beyond the first plane.
SCRIPTS = " 한글 각 ﬁn ½ 𝐀𝔘 É"


def events(spark, sf):
    return classify(A.event_ledger(spark, sf), A.EVENT_RULES)


def orders(spark, sf):
    return classify(A.order_ledger(spark, sf), A.ORDER_RULES)


def _on_events(report) -> Query:
    return lambda spark, sf: report(events(spark, sf))


def _on_orders(report) -> Query:
    return lambda spark, sf: report(orders(spark, sf))


def _lines(keep: str) -> Query:
    def query(spark, sf):
        line = keep_one(
            A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER, keep
        )
        return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")

    return query


def _texts(column: str, build, parse) -> Query:
    """A text column generated from the events and the parsed form of it."""

    def query(spark, sf):
        source = A.event_ledger(spark, sf).withColumn("text", build())
        return source.select("tx_id", "text", parse(F.col("text")).alias(column))

    return query


def _es_text():
    scaled = (F.col("amount") * 37).cast("decimal(18,2)")
    return F.translate(F.format_number(scaled, 2), ",.", ".,")


def _day_text():
    good = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return F.when(F.col("movement_type") == "Premio", "31/02/2024 10:00:00").otherwise(good)


def _broad(spark, sf):
    rules = replace(A.EVENT_RULES, strict_loads=False, channel_rule="binary")
    return loads.binary_channel_summary(classify(A.event_ledger(spark, sf), rules))


def _bonus_detail(spark, sf):
    return bonus.bonus_detail(events(spark, sf), A.event_users(spark, sf))


def _bonus_kpis(spark, sf):
    facts = events(spark, sf)
    return bonus.bonus_kpis(bonus.bonus_daily(facts), bonus.bonus_detail(facts))


def _activity(spark, sf):
    return kpis.activity_kpis(events(spark, sf), A.event_users(spark, sf))


def _enriched(spark, sf):
    rows = bets.enriched_bets(events(spark, sf), A.event_users(spark, sf))
    return rows.withColumn("Importe", F.col("Importe").cast("double"))


def _mean_daily_deposit(spark, sf):
    # Rounded, as the last bits of a mean of doubles depend on the order of the days.
    means = loads.mean_daily_deposit(events(spark, sf), *PERIOD)
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


def _modo_movements(spark, sf):
    rows = loads.modo_movements(events(spark, sf))
    return rows.withColumn("Importe", F.col("Importe").cast("double"))


def _load_feed(spark, sf):
    rows = bundle.detail_feeds(events(spark, sf))["datos_cargas"]
    return rows.withColumn("Importe", F.col("Importe").cast("double"))


def _rollup(spark, sf):
    rows = daily_rollup(events(spark, sf))
    return rows.select(
        "doc_id", "day", "game", "channel", "is_bet", "is_load",
        "n", to_money(F.col("cents")).alias("amount"), "first_ts", "last_ts",
    )


def catalogue() -> dict[str, Query]:
    from ledgerlens.plans import files, streams

    return {
        "client_month_game": _on_orders(bets.client_month_game),
        "top_games_total": _on_orders(bets.top_games_total),
        "top_games_month": _on_orders(bets.top_games_month),
        "game_player_summary": _on_events(lambda f: bets.game_player_summary(f, A.EVENT_RULES)),
        "loads_daily_channel": _on_events(loads.loads_daily_channel),
        "loads_daily_amount_pivot": _on_events(loads.loads_daily_amount_pivot),
        "loads_daily_count_pivot": _on_events(loads.loads_daily_count_pivot),
        "channel_daily": _on_events(loads.channel_daily),
        "withdrawals_daily": _on_events(loads.withdrawals_daily),
        "winners": _on_events(loads.winners),
        "game_day_detail": _on_events(bets.game_day_detail),
        "weekday_totals": _on_events(bets.weekday_totals),
        "first_movement": _on_events(users.first_movement),
        "first_channel_load": _on_events(users.first_channel_load),
        "channel_retention": _on_events(users.channel_retention),
        "channel_retention_orders": _on_orders(users.channel_retention),
        "new_channel_users": _on_events(users.new_channel_users),
        "monthly_growth": _on_orders(users.monthly_growth),
        "monthly_active": _on_orders(bets.monthly_active),
        "milestone_counts": _on_events(lambda f: users.milestone_counts(f, A.EVENT_RULES)),
        "before_after": _on_events(lambda f: loads.before_after(f, A.EVENT_RULES)),
        "kpi_summary": _on_events(kpis.kpi_summary),
        "loads_by_channel": _on_events(loads.loads_by_channel),
        "activity_kpis": _activity,
        "bets_per_user": _on_events(bets.bets_per_user),
        "contact_top10": lambda s, d: users.contact_top(events(s, d), A.event_users(s, d)),
        "game_top10_users": lambda s, d: users.game_top_users(
            events(s, d), A.event_users(s, d), A.EVENT_RULES
        ),
        "new_users_since": lambda s, d: users.new_users_since(A.event_users(s, d), A.EVENT_RULES),
        "new_users_total": lambda s, d: users.new_users_total(A.event_users(s, d), A.EVENT_RULES),
        "reactivated_users": lambda s, d: users.reactivated_users(
            orders(s, d), A.order_users(s, d), A.ORDER_RULES
        ),
        "cohort_retention": lambda s, d: users.cohort_retention(orders(s, d), A.order_users(s, d)),
        "first_event": _on_orders(users.first_event),
        "first_event_intraday": _on_events(users.first_event),
        "revenue_daily": _on_orders(bets.revenue_daily),
        "bets_month_game": _on_orders(bets.bets_month_game),
        "game_evolution": _on_orders(lambda f: bets.game_evolution(f, *MONTHS)),
        "avg_deposit_daily": _on_events(loads.avg_deposit_daily),
        "inactive_users": lambda s, d: users.inactive_users(events(s, d), A.event_users(s, d)),
        "period_kpis": lambda s, d: loads.period_kpis(events(s, d), *PERIOD, A.event_users(s, d)),
        "mean_daily_deposit": _mean_daily_deposit,
        "dynamic_top10": lambda s, d: bets.dynamic_top(
            events(s, d), A.event_users(s, d), TOP_GAME, *PERIOD
        ),
        "bonus_detail": _bonus_detail,
        "bonus_daily": _on_events(bonus.bonus_daily),
        "bonus_kpis": _bonus_kpis,
        "bonus_rates": lambda s, d: bonus.bonus_rates(_bonus_kpis(s, d), *PERIOD),
        "bonus_funnel": lambda s, d: bonus.bonus_funnel(
            bonus.bonus_rates(_bonus_kpis(s, d), *PERIOD)
        ),
        "bonus_by_type": _on_events(lambda f: bonus.bonus_by_type(bonus.bonus_daily(f), *PERIOD)),
        "date_bounds": _on_events(bets.date_bounds),
        "game_list": _on_events(bets.game_list),
        "game_calendar": _on_events(lambda f: bets.game_calendar(f, start=PERIOD[0], end=PERIOD[1])),
        "ledger_dedup_last": _lines("last"),
        "ledger_dedup_first": _lines("first"),
        "binary_channel": _broad,
        "broad_loads": lambda s, d: loads.loads_by_channel(
            classify(A.event_ledger(s, d), replace(A.EVENT_RULES, strict_loads=False))
        ),
        "doc_key_clean": _texts(
            "doc_key", lambda: F.concat(F.lit("DNI 00"), F.col("doc_id"), F.lit(".0")), X.doc_key
        ),
        "es_amount_parse": _texts("amount", _es_text, lambda c: X.es_amount(c).cast("double")),
        "dayfirst_parse": _texts("ts", _day_text, X.dayfirst_ts),
        "fold_text": _texts(
            "folded", lambda: F.concat(F.col("description"), F.lit(" ÁÉÍÓÚ Ñandú Über")), X.fold_text
        ),
        "fold_scripts": _texts("folded", lambda: F.concat(F.col("description"), F.lit(SCRIPTS)), X.fold_text),
        "enriched_bets": _enriched,
        "modo_movements": _modo_movements,
        "load_feed": _load_feed,
        "money_text": _texts(
            "money", lambda: (F.col("amount") * 1000).cast("decimal(18,2)").cast("string"),
            lambda c: X.money_text(c.cast("decimal(18,2)")),
        ),
        "daily_rollup": _rollup,
        "distinct_users_cube": _on_events(distinct.users_of_ledger),
        **files.QUERIES,
        **streams.QUERIES,
    }

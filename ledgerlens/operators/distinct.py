"""Distinct users that add up: bitmaps of users per day, from which all coarser counts come.

A user gets a dense number once. A day row holds, per game and per 32,768 user numbers, the
set of users who bet, as a bitmap of 4 KB. Sets of days are joined by OR, so months, games and
totals are counted from day rows, exactly, and days of a later load are merged into those kept
without reading the ledger again.

Defined cases: bets without user, day or game are left out, as in the tables of games; repeated
rows change nothing; without rows only the total remains, of 0 users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.common import with_keys
from ledgerlens.session import scratch_dir

#: Finest first; each is made from one above it.
LEVELS = [
    ("day_game", ["day", "month", "game"], None),
    ("day", ["day", "month"], "day_game"),
    ("month_game", ["month", "game"], "day_game"),
    ("month", ["month"], "month_game"),
    ("game", ["game"], "month_game"),
    ("all", [], "game"),
]


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def user_numbers(facts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id`` and its ``number``, from 1 on without gaps; users already ``known`` keep theirs.

    No sort of users and no single task: places within the partitions of one written table,
    and sums over its partitions, of which there are as many as tasks."""
    users = with_keys(facts, "doc_id").select("doc_id").distinct()
    first = 0
    if known is not None:
        users = users.join(known, "doc_id", "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    placed = _stored(users.withColumn("place", F.monotonically_increasing_id()), "user-places")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    numbered = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    within = F.col("place").bitwiseAND((1 << 33) - 1)
    numbered = numbered.select("doc_id", (F.col("start") + within + F.lit(first + 1)).alias("number"))
    return numbered if known is None else known.select("doc_id", "number").unionByName(numbered)


def user_days(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """``day``, ``month``, ``game``, ``bucket`` of user numbers and the bitmap ``users`` of bettors.

    ``facts`` may be the ledger or its daily roll-up. Users of a day meet once per game
    before their numbers are looked up, so a user with many bets is one row by then."""
    bets = with_keys(facts.where("is_bet"), "doc_id", "day", "game").select("doc_id", "day", "month", "game").distinct()
    rows = bets.join(numbers, "doc_id")
    keys = ["day", "month", "game", F.bitmap_bucket_number("number").alias("bucket")]
    return rows.groupBy(*keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def merged_days(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Day rows of two loads as one set of day rows."""
    return _joined(kept.unionByName(new), ["day", "month", "game"])


def _joined(days: DataFrame, keys: list[str]) -> DataFrame:
    return days.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users_cube(days: DataFrame) -> DataFrame:
    """Distinct users per day and game, day, month and game, month, game, and of all:
    ``level``, ``day``, ``month``, ``game`` (null where a level has none) and ``users``."""
    types = dict(days.select("day", "month", "game").dtypes)
    sets, tables = {}, []
    for level, keys, source in LEVELS:
        # The two that others are made from are written; the rest is read from them.
        own = days if source is None else _joined(sets[source], keys)
        sets[level] = _stored(own, f"users-{level}") if level in ("month_game", "game") else own
        count = F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias("users")
        counts = sets[level].groupBy(*keys).agg(count)
        names = [F.col(c) if c in keys else F.lit(None).cast(kind).alias(c) for c, kind in types.items()]
        tables.append(counts.select(F.lit(level).alias("level"), *names, "users"))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def users_of_ledger(facts: DataFrame) -> DataFrame:
    """The cube of a whole ledger: users numbered, day rows written, counts taken from them."""
    numbers = _stored(user_numbers(facts), "user-numbers")
    return distinct_users_cube(_stored(user_days(facts, numbers), "user-days"))

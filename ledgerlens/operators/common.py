"""Small pieces shared by the reports."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.movement import wall_time
from ledgerlens.functions.rules import MODO


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows lacking a grouping key."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def where_sum(value: str, condition: Column | None = None) -> Column:
    """Sum, 0 if there is nothing to sum."""
    total = F.sum(F.col(value) if condition is None else F.when(condition, F.col(value)))
    return F.coalesce(total, F.lit(0))


def counted(condition: Column | None = None) -> Column:
    """Number of movements with an amount."""
    return where_sum("n", condition).cast("bigint")


def to_money(cents: Column) -> Column:
    """Whole cents as a double, the form of amounts at the edge of a report."""
    return (cents.cast("decimal(38,0)") * F.lit(Decimal("0.01"))).cast("double")


def exact(cents: str) -> Column:
    """Cents as a decimal, for totals that a whole number of 64 bits may not hold."""
    return F.col(cents).cast("decimal(28,0)")


def cents_sum(condition: Column | None = None) -> Column:
    """Sum of cents as a decimal, 0 if there is nothing to sum."""
    cents = exact("cents")
    return F.coalesce(F.sum(cents if condition is None else F.when(condition, cents)), F.lit(0).cast("decimal(38,0)"))


def money(condition: Column | None = None) -> Column:
    """Sum of amounts, as a decimal of whole cents: it neither wraps nor overflows,
    whatever ANSI setting the session has."""
    return to_money(cents_sum(condition))


def distinct_users() -> Column:
    return F.count_distinct("doc_id")


def is_modo_load() -> Column:
    return F.col("is_load") & (F.col("channel") == MODO)


def labelled(row: DataFrame, label: str, entries: list[tuple[str, list[Column]]], names: list[str]) -> DataFrame:
    """Turn a one-row frame into one row per (label, values)."""
    structs = [
        F.struct(F.lit(text).alias(label), *[v.alias(n) for v, n in zip(values, names)])
        for text, values in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def day_range(df: DataFrame, column: str, start, end, inclusive_end: bool = False) -> DataFrame:
    """Closed range on a date or timestamp column.

    A bare end date means its midnight, so later movements of that day stay out;
    ``inclusive_end`` keeps the whole day.
    """
    c = F.col(column)
    if inclusive_end:
        return df.where((c >= wall_time(start)) & (F.to_date(c) <= F.to_date(wall_time(end))))
    return df.where((c >= wall_time(start)) & (c <= wall_time(end)))


def month_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Range on ``yyyy-MM`` text; both bounds count as whole months."""
    return df.where(F.col(column).between(f"{start:%Y-%m}", f"{end:%Y-%m}"))

"""Predicates and derived columns of one movement.

``kind`` and ``text`` are movement type and description. A suffix ``_low`` marks the
lower-case form and ``_norm`` the folded form; the caller builds each once. Plain
words are looked up by substring, which costs a fraction of a regular expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.rules import MODO, OTHER, RETAIL, WEEKDAYS, Rules
from ledgerlens.functions.text import strip_text

def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))


def _mentions(text: Column, words) -> Column:
    found = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
    return F.coalesce(found, F.lit(False))


def is_bet(kind_low: Column, rules: Rules) -> Column:
    return _mentions(kind_low, rules.bet_words)


def is_load(kind_low: Column, kind_norm: Column, rules: Rules) -> Column:
    if rules.strict_loads:
        return _found(kind_norm, "(?U)" + rules.strict_load_pattern)
    return _mentions(kind_low, rules.broad_load_words)


def is_withdrawal(kind_low: Column, rules: Rules) -> Column:
    return _mentions(kind_low, rules.withdrawal_words)


def is_prize(kind_low: Column, rules: Rules) -> Column:
    return _mentions(kind_low, rules.prize_words)


def is_bonus(kind_norm: Column, rules: Rules) -> Column:
    return _mentions(kind_norm, rules.bonus_words)


def is_signup_bonus(kind_norm: Column, text_norm: Column, rules: Rules) -> Column:
    return _mentions(kind_norm, rules.signup_bonus_words) | _mentions(
        text_norm, rules.signup_bonus_words
    )


def game_name(text: Column, rules: Rules) -> Column:
    return strip_text(F.regexp_replace(text, "(?iuU)" + rules.game_prefix_pattern, ""))


def matches_game(game_norm: Column, pattern: str) -> Column:
    return _found(game_norm, "(?U)" + pattern)


def channel(text_norm: Column, kind_norm: Column, rules: Rules) -> Column:
    text, kind = text_norm, kind_norm
    if rules.channel_rule == "binary":
        return F.when(_mentions(text, rules.modo_keywords), MODO).otherwise(RETAIL)
    return (
        F.when(_mentions(text, rules.modo_keywords) | _mentions(kind, rules.modo_keywords), MODO)
        .when(_mentions(text, rules.card_keywords) | _mentions(kind, rules.card_keywords), RETAIL)
        .when(_mentions(text, rules.counter_keywords), RETAIL)
        .otherwise(OTHER)
    )


def method(channel_name: Column) -> Column:
    return F.when(channel_name == MODO, MODO).otherwise(RETAIL)


def wall_time(value) -> Column:
    """A date, time or text as a timestamp without zone; a plain datetime literal
    would depend on the session's zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def month_text(when: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.date_format(F.to_date(when), "yyyy-MM")


def weekday_name(when: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(when) + 1)

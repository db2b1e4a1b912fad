"""Text folding and tolerant parsing, built from Spark's own functions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def fold_plain(text: str) -> str:
    """Compatibility decomposition without marks, on the driver."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")


# Precomposed Hangul: its letters follow from the code point, by the standard's arithmetic.
_HANGUL = range(0xAC00, 0xD7A4)
_LEADS, _VOWELS, _TAILS = range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)
#: Blocks with compatibility characters or marks; the last three lie beyond U+FFFF.
_FOLDED = (
    range(0x80, 0xD800), range(0xF900, 0x10000), range(0x10000, 0x20000), range(0x2F800, 0x2FA20), range(0xE0100, 0xE01F0)
)


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Arguments of ``translate`` for characters that fold to one or none, and a table of
    those that fold to several, ligatures and fractions for example."""
    single, several, marks = [], {}, []
    for code in chain(*_FOLDED):
        char = chr(code)
        plain = fold_plain(char)
        if code in _HANGUL or plain == char:
            continue
        if not plain:
            marks.append(char)
        elif len(plain) == 1:
            single.append((char, plain))
        else:
            several[char] = plain
    # Characters without a counterpart are deleted: the combining marks themselves.
    return "".join(c for c, _ in single) + "".join(marks), "".join(p for _, p in single), several


_ACCENTED, _PLAIN, _SEVERAL = _fold_tables()


def _expanded(text: Column) -> Column:
    # One literal: a map of as many columns would make every plan long.
    table = F.from_json(F.lit(json.dumps(_SEVERAL)), "map<string,string>")

    def letters(block: range, place: Column) -> Column:
        return F.get(F.split(F.lit("".join(map(chr, block))), ""), place.cast("int"))

    def one(char: Column) -> Column:
        code = F.ascii(char)
        place = code - _HANGUL.start
        syllable = F.concat(
            letters(_LEADS, F.floor(place / (len(_VOWELS) * (len(_TAILS) + 1)))),
            letters(_VOWELS, F.floor(place / (len(_TAILS) + 1)) % len(_VOWELS)),
            F.coalesce(F.when(place % (len(_TAILS) + 1) > 0, letters(_TAILS, place % (len(_TAILS) + 1) - 1)), F.lit("")),
        )
        return (
            F.when(code < 0x80, char)
            .when(code.between(_HANGUL.start, _HANGUL.stop - 1), syllable)
            .otherwise(F.coalesce(F.try_element_at(table, char), char))
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def fold_text(text: Column) -> Column:
    """Lower case without accents; NULL becomes the empty text.

    Plain ASCII values, the usual case, skip the character table, and values that are plain
    once their accents are gone skip the table of characters that fold to several.
    """
    bare = F.translate(text, _ACCENTED, _PLAIN)
    folded = (
        F.when(_is_ascii(text), F.lower(text))
        .when(_is_ascii(bare), F.lower(bare))
        .otherwise(F.lower(_expanded(bare)))
    )
    return F.coalesce(folded, F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def strip_text(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def es_amount(text: Column) -> Column:
    """``1.234,56`` to a decimal; text that is no number becomes NULL."""
    plain = F.replace(strip_text(text), F.lit("."), F.lit(""))
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def dayfirst_ts(text: Column) -> Column:
    """``dd/MM/yyyy[ HH:mm:ss]``, also with two digits of the year or a 12-hour time, or
    an ISO time, to a timestamp without zone; else NULL.

    Years of two digits from 69 on are of the last century.
    """
    short = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d\d)(?!\d)"

    usual = r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d\z"

    def without_half(value: Column) -> Column:
        half = F.lower(F.regexp_extract(value, r"(?i)\d\s*([ap])\.?\s?m\.?$", 1))
        bare = F.when(half != "", F.regexp_replace(value, r"(?i)\s*[ap]\.?\s?m\.?$", "")).otherwise(value)
        return let(F.struct(half.alias("half"), bare.alias("text")), with_year)

    def with_year(p: Column) -> Column:
        value = p["text"]
        century = F.when(F.regexp_extract(value, short, 3) >= "69", F.lit("19")).otherwise(F.lit("20"))
        long = F.concat(
            F.regexp_extract(value, short, 1), F.lit("/"), F.regexp_extract(value, short, 2), F.lit("/"), century,
            F.regexp_extract(value, short, 3), F.regexp_replace(value, short, ""),
        )
        whole = F.when(value.rlike(short), long).otherwise(value)
        iso = F.regexp_replace(whole, r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", "$3-$2-$1")
        return let(iso, lambda iso: let(as_time(iso), lambda time: moved(time, p["half"])))

    def as_time(iso: Column) -> Column:
        return F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d|$)"), iso.try_cast("timestamp_ntz"))

    def moved(time: Column, half: Column) -> Column:
        hour = F.hour(time)
        shift = F.when((half == "p") & (hour < 12), 12).when((half == "a") & (hour == 12), -12).otherwise(0)
        later = F.when(hour.between(1, 12), time + F.make_dt_interval(F.lit(0), shift))
        return F.when(half == "", time).otherwise(later)

    part = lambda start, length: F.substring(text, start, length)
    plain = F.concat(part(7, 4), F.lit("-"), part(4, 2), F.lit("-"), part(1, 2), part(11, 9)).try_cast("timestamp_ntz")
    return F.when(text.rlike(usual), plain).otherwise(let(strip_text(text), without_half))


def doc_key(text: Column) -> Column:
    """First digit run without leading zeros as a number; nothing left becomes NULL."""
    digits = F.regexp_extract(text.cast("string"), r"(\d+)", 1)
    return F.ltrim(digits, F.lit("0")).try_cast("bigint")


def numeric_id(text: Column) -> Column:
    """Whole number in a text such as ``123``, ``123.0`` or ``12.345.678``; a number that
    is not whole is no id."""
    value = strip_text(text.cast("string"))
    value = F.when(value.rlike(r"^\d{1,3}(\.\d{3}){2,}$"), F.replace(value, F.lit("."), F.lit(""))).otherwise(value)
    number = value.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def text_id(text: Column) -> Column:
    """An id as text: whole numbers without zeros around them, all else as it stands;
    blank is NULL."""
    value = strip_text(text.cast("string"))
    other = F.when(F.length(value) > 0, F.coalesce(numeric_id(value).cast("string"), value))
    return F.when(text.cast("string").rlike(r"^[1-9]\d{0,17}\z"), text.cast("string")).otherwise(other)


def money_text(amount: Column) -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))

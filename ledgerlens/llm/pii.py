"""Format-preserving pseudonyms for personal values, in Spark's own functions.

Values are found by one pattern, validated, and replaced by a keyed permutation of the
values of their format: a card number becomes another number that passes its check, an
address another address, a date another date. The permutation is a Feistel network over two
parts, keyed by SHA-256, so equal values get equal pseudonyms in every document, whatever
separators they are written with, and the holder of the key can restore them.

| Kind | Valid if | Permuted |
| --- | --- | --- |
| email | name, ``@``, domain with a letter-only end | letters and digits of all but the last label, each within its class |
| phone | country code and ten digits, or ten grouped digits | the last ten digits |
| ip | four numbers up to 255 | all 32 bits |
| card | 13 to 19 digits that pass the Luhn check | all but the check digit, which follows |
| iban | passes the mod-97 check | letters and digits of the account, check digits follow |
| ssn | grouped 3-2-4 | all nine digits |
| date | a day of the calendar since about 1700, ``2024-05-31``, ``31/05/2024`` or ``31.05.2024`` | days of a span of 73,080 days |

Values that fail validation stay as they are, and other values are looked for inside them.
Restoring needs the same cut: of card numbers among further groups of digits that happen to
pass the check together with a part of the pseudonym, it may differ.

Defined cases: a null text stays null, an empty one empty; repeated rows get equal results;
a value never changes its length or its separators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import unused

#: For the registered query and the pipeline; whoever publishes data passes an own one.
PRODUCTION_KEY = "pseudonyms-1"
ROUNDS = 8

# A domain has 127 labels at most; a repeat without that bound makes the matcher recurse as
# deep as a text has labels.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.){1,127}[A-Za-z]{2,}(?![A-Za-z0-9-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
}
_OTHERS = "|".join(PATTERNS.values())
#: Characters of an IBAN after its check digits, by country.
_ACCOUNTS = {
    11: "NO", 12: "BE", 14: "DK FI FO GL NL FK SD", 15: "MK SI", 16: "AT BA EE KZ LT LU XK MN",
    17: "CH CR HR LI LV", 18: "BG BH DE GB GE IE ME RS VA", 19: "AE GI IL IQ TL OM SO",
    20: "AD CZ ES MD PK RO SA SE SK TN VG LY DJ BI", 21: "PT ST", 22: "IS TR",
    23: "FR GR IT MC MR SM", 24: "AL AZ CY DO GT HU LB PL BY SV NI", 25: "BR EG PS QA UA",
    26: "JO KW MU YE", 27: "MT SC", 29: "LC RU",
}
_IBANS = "|".join(
    rf"(?:{own.replace(' ', '|')})\d\d(?: ?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])" for n, own in _ACCOUNTS.items()
)
#: Runs of groups of digits, in which card numbers are looked for; no run enters another value.
PATTERNS["card"] = rf"(?<![\d+])(?=\d(?:[ -]?\d){{12}})\d++(?:[ -](?!{_OTHERS})\d++)*+"
PATTERNS["iban"] = (
    rf"(?<![A-Za-z0-9])(?:{_IBANS}|[A-Z]{{2}}\d\d(?: (?!{_IBANS})[A-Z0-9]|[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))"
)
INSIDE = "|".join(p for kind, p in PATTERNS.items() if kind != "iban")
ANY = "|".join(PATTERNS.values())
#: Groups of a run of digits that are put together at once.
RUN_BLOCK = 200
#: No value lacks both.
HINT = "[0-9@]"
#: Days of one span of dates: 261 times 280 of them from 1900 on make the years up to 2100.
SPAN_A, SPAN_B = 261, 280
FIRST_DAY = -25567  # 1900-01-01


def _prf(key: str, tweak: Column, turn: Column, half: Column) -> Column:
    """60 bits that depend on the key, the format, the round and the other part."""
    text = F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), half)
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _turns(inverse: bool) -> Column:
    order = range(ROUNDS)
    return F.array(*[F.lit(i) for i in (reversed(order) if inverse else order)])


def _feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column, inverse: bool) -> Column:
    """A keyed permutation of the pairs of numbers below the two sizes, as a struct."""
    sign = -1 if inverse else 1

    def turn(state: Column, i: Column) -> Column:
        left = F.pmod(state["a"] + sign * F.pmod(_prf(key, tweak, i, state["b"].cast("string")), size_a), size_a)
        right = F.pmod(state["b"] + sign * F.pmod(_prf(key, tweak, i, state["a"].cast("string")), size_b), size_b)
        even = i % 2 == 0
        return F.struct(F.when(even, left).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(right).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(_turns(inverse), start, turn)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("long")


def _permute_digits(digits: Column, key: str, kind: str, inverse: bool) -> Column:
    """Another string of as many digits, at most 18 of them."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    tweak = F.concat(F.lit(kind), n.cast("string"))
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, n - half)
    sizes = _power(half), _power(n - half)
    return _named(
        _feistel(left, right, *sizes, key, tweak, inverse),
        lambda p: F.concat(F.lpad(p["a"].cast("string"), half, "0"), F.lpad(p["b"].cast("string"), n - half, "0")),
    )


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _refill(shape: Column, symbols: Column, allowed: str) -> Column:
    """The characters of ``shape`` that match ``allowed`` replaced, in order, by symbols."""
    chars = F.split(shape, "")

    def at(c: Column, i: Column) -> Column:
        place = F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x.rlike(allowed)))
        return F.when(c.rlike(allowed), F.substr(symbols, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(chars, at), "")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Sum of the Luhn check; the last digit is doubled when a check digit is to follow."""
    from_right = F.reverse(F.split(digits, ""))
    parity = 0 if double_last else 1

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == parity, twice).otherwise(d)

    return F.aggregate(F.transform(from_right, value), F.lit(0), lambda x, y: x + y)


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (F.pmod(_luhn_sum(digits, False), F.lit(10)) == 0)


def _card_pieces(run: Column) -> Column:
    """A run of groups of digits cut into card numbers and what is between them. At each group
    the usual forms come first: 4-4-4-4, undivided, 4-6-5; then any other with 13 to 19 digits,
    the longest first, that holds no card number in a usual form from a later group on."""
    usual = ((4, r"^\d{4}( \d{4}){3}$|^\d{4}(-\d{4}){3}$"), (1, r"^\d+$"), (3, r"^\d{4}([ -])\d{6}\1\d{5}$"))

    def cut(tokens: Column) -> Column:
        n = (F.size(tokens) + 1) / 2
        places = F.sequence(F.lit(0), n.cast("int") - 1)

        def span(i: Column, k: Column) -> Column:
            return F.array_join(F.slice(tokens, 2 * i + 1, 2 * k - 1), "")

        def first_usual(i: Column) -> Column:
            out = F.lit(0)
            for k, form in reversed(usual):
                text = span(i, F.lit(k))
                out = F.when(text.rlike(form) & _is_card(_digits(text)), F.lit(k)).otherwise(out)
            return out

        def over(known: Column) -> Column:
            def size(i: Column) -> Column:
                sizes = F.sequence(F.least(n.cast("int") - i, F.lit(19)), F.lit(1))
                fits = F.filter(
                    sizes,
                    lambda k: _is_card(_digits(span(i, k)))
                    & ~F.exists(F.slice(known, i + 2, k - 1), lambda x: x > 0),
                )
                return F.when(known[i] > 0, known[i]).otherwise(F.coalesce(F.get(fits, F.lit(0)), F.lit(0)))

            def step(state: Column, i: Column) -> Column:
                def at(k: Column) -> Column:
                    width = F.greatest(k, F.lit(1))
                    own = F.array(span(i, width), F.coalesce(F.get(tokens, 2 * (i + width) - 1), F.lit("")))
                    return F.struct(F.concat(state["out"], own).alias("out"), (i + width).alias("next"))

                return F.when(i < state["next"], state).otherwise(_named(size(i), at))

            # Block by block: an array that grows by a piece at a time is copied each time.
            def block(state: Column, first: Column) -> Column:
                own = F.sequence(first, F.least(first + RUN_BLOCK, n.cast("int")) - 1)
                start = F.struct(F.array().cast("array<string>").alias("out"), state["next"].alias("next"))

                def joined(done: Column) -> Column:
                    return F.struct(F.concat(state["out"], F.array(done["out"])).alias("out"), done["next"].alias("next"))

                return _named(F.aggregate(own, start, step), joined)

            firsts = F.sequence(F.lit(0), n.cast("int") - 1, F.lit(RUN_BLOCK))
            start = F.struct(F.array().cast("array<array<string>>").alias("out"), F.lit(0).alias("next"))
            return F.flatten(F.aggregate(firsts, start, block)["out"])

        return _named(F.transform(places, first_usual), over)

    divided = run.rlike(rf"^(?:{PATTERNS['card']})$") & run.rlike("[ -]")
    return F.when(divided, _named(F.regexp_extract_all(run, F.lit(r"\d+|[ -]"), F.lit(0)), cut)).otherwise(F.array(run))


def _pieces(value: Column) -> Column:
    """A match cut into values and what is between them: an IBAN that fails its check may hold
    other values, a run of groups of digits card numbers."""

    def inside(text: Column) -> Column:
        between = F.split(text, INSIDE, -1)
        found = F.concat(F.regexp_extract_all(text, F.lit(INSIDE), F.lit(0)), F.array(F.lit("")))
        return F.flatten(F.zip_with(between, found, lambda b, v: F.array(b, v)))

    failed = value.rlike(rf"^(?:{PATTERNS['iban']})$") & ~_is_iban(F.regexp_replace(value, " ", ""))
    parts = F.when(failed, inside(value)).otherwise(F.array(value))
    return F.filter(F.flatten(F.transform(parts, _card_pieces)), lambda p: p != "")


def _card(text: Column, key: str, inverse: bool) -> Column:
    digits = _digits(text)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)

    def with_check(moved: Column) -> Column:
        check = F.pmod(-_luhn_sum(moved, True), F.lit(10)).cast("string")
        return _refill(text, F.concat(moved, check), "[0-9]")

    return F.when(_is_card(digits), _named(_permute_digits(body, key, "card", inverse), with_check)).otherwise(text)


def _phone(text: Column, key: str, inverse: bool) -> Column:
    digits = _digits(text)
    code = F.substr(digits, F.lit(1), F.length(digits) - 10)
    moved = _permute_digits(F.substr(digits, F.length(digits) - 9, F.lit(10)), key, "phone", inverse)
    return _refill(text, F.concat(code, moved), "[0-9]")


def _ssn(text: Column, key: str, inverse: bool) -> Column:
    return _refill(text, _permute_digits(_digits(text), key, "ssn", inverse), "[0-9]")


def _ip(text: Column, key: str, inverse: bool) -> Column:
    octets = F.transform(F.split(text, r"\."), lambda o: o.cast("long"))
    size = F.lit(65536).cast("long")
    moved = _feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], size, size, key, F.lit("ip"), inverse)

    def written(p: Column) -> Column:
        parts = [F.shiftright(p["a"], 8), p["a"] % 256, F.shiftright(p["b"], 8), p["b"] % 256]
        return F.concat_ws(".", *[part.cast("string") for part in parts])

    return _named(moved, written)


def _date(text: Column, key: str, inverse: bool) -> Column:
    form = F.when(text.contains("-"), F.lit("yyyy-MM-dd")).when(text.contains("/"), F.lit("dd/MM/yyyy")).otherwise(
        F.lit("dd.MM.yyyy")
    )
    iso = F.when(text.contains("-"), text).otherwise(
        F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    )
    span = SPAN_A * SPAN_B
    day = F.datediff(F.to_date(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))), F.lit("1970-01-01").cast("date"))

    def moved(day: Column) -> Column:
        at = F.pmod(day - FIRST_DAY, F.lit(span))
        tweak = F.concat(F.lit("date"), F.floor((day - FIRST_DAY) / span).cast("string"))
        a, b = F.floor(at / SPAN_B), at % SPAN_B
        new = _feistel(a, b, F.lit(SPAN_A).cast("long"), F.lit(SPAN_B).cast("long"), key, tweak, inverse)
        target = _named(new, lambda p: day - at + p["a"].cast("int") * SPAN_B + p["b"].cast("int"))
        return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), target.cast("int")), "yyyy-MM-dd")

    def written(new: Column) -> Column:
        parts = F.split(new, "-")
        return (
            F.when(form == "yyyy-MM-dd", new)
            .when(form == "dd/MM/yyyy", F.concat_ws("/", parts[2], parts[1], parts[0]))
            .otherwise(F.concat_ws(".", parts[2], parts[1], parts[0]))
        )

    # Whole spans from about 1700 on whose years have four digits.
    inside = day.between(FIRST_DAY - span, FIRST_DAY + 40 * span - 1)
    return F.when(inside, _named(day, lambda d: _named(moved(d), written))).otherwise(text)


_CLASSES = (("0-9", 48, 10), ("a-z", 97, 26), ("A-Z", 65, 26))


def _shift(chars: Column, hexed: Column, sign: int) -> Column:
    """Each letter or digit moved within its class by its place's bits of ``hexed``."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(hexed, F.pmod(i * 4, F.lit(64)) + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        for allowed, first, size in _CLASSES:
            moved = F.char(F.pmod(F.ascii(c) - first + sign * by, F.lit(size)) + first)
            out = F.when(c.rlike(f"[{allowed}]"), moved).otherwise(out)
        return out

    return F.transform(chars, move)


def _permute_text(text: Column, key: str, kind: str, inverse: bool) -> Column:
    """Letters and digits permuted within their classes: a Feistel network over the halves."""
    n = F.length(text)
    half = (n / 2).cast("int")
    sign = -1 if inverse else 1
    tweak = F.concat(F.lit(kind), n.cast("string"))

    def hexed(i: Column, other: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), F.array_join(other, "")), 256)

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        left, right = _shift(state["a"], hexed(i, state["b"]), sign), _shift(state["b"], hexed(i, state["a"]), sign)
        return F.struct(F.when(even, left).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(right).alias("b"))

    chars = F.split(text, "")
    start = F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, n - half).alias("b"))
    moved = F.aggregate(_turns(inverse), start, turn)
    return _named(moved, lambda p: F.array_join(F.concat(p["a"], p["b"]), ""))


def _email(text: Column, key: str, inverse: bool) -> Column:
    end = F.regexp_extract(text, r"\.[A-Za-z]+$", 0)
    body = F.substr(text, F.lit(1), F.length(text) - F.length(end))
    return F.concat(_permute_text(body, key, "email", inverse), end)


def _mod97(text: Column) -> Column:
    """Remainder of a string of digits and capital letters (A is 10) by 97."""

    def step(rest: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        return F.when(letter, (rest * 100 + F.ascii(c) - 55) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _is_iban(whole: Column) -> Column:
    return _mod97(F.concat(F.substr(whole, F.lit(5), F.length(whole) - 4), F.substring(whole, 1, 4))) == 1


def _iban(text: Column, key: str, inverse: bool) -> Column:
    whole = F.regexp_replace(text, " ", "")
    country, account = F.substring(whole, 1, 2), F.substr(whole, F.lit(5), F.length(whole) - 4)

    def with_check(moved: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
        return _refill(text, F.concat(country, check, moved), "[A-Z0-9]")

    return F.when(_is_iban(whole), _named(_permute_text(account, key, "iban", inverse), with_check)).otherwise(text)


CHANGES = {"email": _email, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card, "iban": _iban}


def pseudonym(value: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one found value, by the first pattern that it is a whole match of."""
    out = value
    for kind in reversed(PATTERNS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), CHANGES[kind](value, key, inverse)).otherwise(out)
    return out


def with_pseudonyms(docs: DataFrame, key: str, text: str, found: str, inverse: bool = False) -> DataFrame:
    """The text with pseudonyms, and the column ``found``: an array of (value, pseudonym), in
    which what is between the values of one match stands for itself."""
    body = F.col(text)
    values = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    cut = unused([*docs.columns, found], "matches")
    docs = docs.withColumn(cut, F.when(body.rlike(HINT), F.transform(values, _pieces)))
    pairs = F.transform(F.flatten(cut), lambda v: F.struct(v.alias("value"), pseudonym(v, key, inverse).alias("pseudonym")))
    none = F.slice(F.array(F.struct(F.lit("").alias("value"), F.lit("").alias("pseudonym"))), 1, 0)
    docs = docs.withColumn(found, F.when(body.rlike(HINT), pairs).otherwise(none))
    between = F.split(body, ANY, -1)
    # The text after a match follows its last piece.
    after = F.zip_with(
        cut, F.slice(between, F.lit(2), F.size(cut)), lambda m, s: F.concat(F.array_repeat(F.lit(""), F.size(m) - 1), F.array(s))
    )
    rest = F.zip_with(found, F.flatten(after), lambda p, s: F.concat(p["pseudonym"], s))
    whole = F.concat(between[0], F.array_join(rest, ""))
    return docs.withColumn(text, F.when(F.size(found) > 0, whole).otherwise(body)).drop(cut)


def pseudonymize(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """The documents, all their columns, with pseudonyms in the text; ``inverse`` restores."""
    name = unused(docs.columns, "personal_values")
    return with_pseudonyms(docs, key, "text", name, inverse).select(*docs.columns)

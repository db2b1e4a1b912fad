"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit
per failed rule; policies are versioned masks over these bits, so another policy, or the
effect of leaving one rule out, is answered from the ledger without reading text again.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows
get a ledger row each; a null ``doc_id`` is passed on.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import per_text, unused

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits")

#: Rule name and the condition under which a document fails it, over its measurements
#: and, for the shares, in whole numbers. The place in the list is the bit; only append.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("many_digits", "100 * n_digits > 50 * word_chars"),
)
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BITS[name] for name in names)


#: A policy rejects a document that failed any of its rules.
POLICIES = {
    "base": mask("few_words", "repeated_windows"),
    "v1": mask(*BITS),
}
PRODUCTION = "v1"


def _measure():
    find = WORD.findall

    def one(text: str | None) -> tuple:
        if not text:
            return (0,) * len(MEASURES)
        words = find(text)
        n = len(words)
        seen, dup, lines = set(), 0, 0
        for line in text.split("\n"):
            if WORD.search(line):
                lines += 1
                dup += line in seen
                seen.add(line)
        return (
            n,
            len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)),
            dup,
            _repeated(words),
            lines,
            sum(map(text.count, DIGITS)),
        )

    return one


def _repeated(words: list[str]) -> int:
    """Words in windows of five words that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    starts = (i for i, window in enumerate(windows) if counts[window] > 1)
    return len(set(chain.from_iterable(range(i, i + WINDOW) for i in starts)))


measures = per_text(_measure, ", ".join(f"{name} long" for name in MEASURES))


def failure_bits() -> Column:
    bits = [F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)) for name, condition in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total.cast("long")


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns of ``keep``, every measurement, ``failed`` bits."""
    measured = docs.select(*keep, measures(F.col(text)).alias("measured"))
    return measured.select(*keep, "measured.*").withColumn("failed", failure_bits())


def passes(failed: Column, policy: str = PRODUCTION) -> Column:
    return failed.bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """For each rule of a policy: documents failing it, failing it alone, and kept if it
    were left out. The ledger is first reduced to a row per set of failed bits, at most
    two to the number of rules, then every rule is counted from those rows."""
    sets = rows.groupBy("failed").agg(F.count("*").alias("n"))
    wanted = POLICIES[policy]
    out = []
    for name, bit in BITS.items():
        if bit & wanted:
            has = F.col("failed").bitwiseAND(F.lit(bit)) != 0
            others = F.col("failed").bitwiseAND(F.lit(wanted & ~bit)) == 0
            out += [
                F.struct(
                    F.lit(name).alias("rule"),
                    F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias("n_failed"),
                    F.coalesce(F.sum(F.when(has & others, F.col("n"))), F.lit(0)).alias("n_failed_alone"),
                    F.coalesce(F.sum(F.when(others, F.col("n"))), F.lit(0)).alias("n_kept_without"),
                )
            ]
    return sets.agg(F.array(*out).alias("rules")).select(F.inline("rules"))


def keep_good(docs: DataFrame, policy: str = PRODUCTION, text: str = "text") -> DataFrame:
    """The documents, all their columns, that pass a policy."""
    name = unused(docs.columns, "quality_ledger_row")
    measured = docs.withColumn(name, measures(F.col(text)))
    failed = F.lit(0).cast("long")
    for rule, condition in RULES:
        if BITS[rule] & POLICIES[policy]:
            # The rule texts name the measurements; here they are fields of one column.
            bound = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{name}.\1", condition)
            failed = failed.bitwiseOR(F.when(F.expr(bound), F.lit(BITS[rule]).cast("long")).otherwise(F.lit(0)))
    return measured.where(passes(failed, policy)).drop(name)

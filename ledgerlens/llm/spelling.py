"""Spelling variants: words one edit apart, each led to its most frequent near word.

The vocabulary holds the words of a corpus with their number of occurrences. Two words are
near if they differ by one inserted, deleted or replaced code point. A word's form is its near
word of largest count, if that count is at least ``ratio`` times its own; following forms leads
to its root.

Near words are found with a bit-sliced index: for each position and letter, a bitset of the
words that have this letter there. A query word walks over its letters and keeps three bitsets
at once: words without an error so far, with a letter replaced, and with a letter more (their
positions shifted by one). Each step is a handful of operations on whole bitsets, so all words
are compared at once, 64 to a machine word.

The index is built per bucket. A word is cut into three regions; whatever the one error of a
pair, all regions but one are equal, so the words that agree outside a region meet in its
bucket, and a pair counts in the first region it agrees for. Buckets of more than
``BUCKET_WORDS`` words are cut again at thirds of their region, down to single positions, where
the alphabet bounds them. No word is dropped from a bucket and no pair is listed: a bucket
answers with a row per word, its number of near words and the best of them.

Defined cases: a null or empty text has no words; a null id counts as an empty one; repeated
rows count as often as they stand; of near words with one count the first in code-point order
is the form; a vocabulary without near words gives null forms and the words as their own roots;
an empty table gives no rows; words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Words that a bucket indexes before it is cut again, and regions of a first cut.
BUCKET_WORDS = 4096
PARTS = 3
#: Counts that a task keeps before it hands them on, in words and in their characters.
KEPT_WORDS = 200_000
KEPT_CHARS = 4_000_000


@dataclass(frozen=True)
class Params:
    modulus: int = 97  # a run of a document loses a code point if this divides its hash
    least_length: int = 5
    least_count: int = 3
    ratio: int = 2


def words_of(doc_id: str, text: str | None, modulus: int) -> Iterator[tuple[str, int]]:
    """The runs of a text with their counts, one code point out of those the hash marks."""
    start = zlib.crc32(doc_id.encode() + b":")
    for run, n in Counter(RUN.findall(text) if text else ()).items():
        run = run.lower() if run.isascii() else run.translate(LOWER)
        h = zlib.crc32(run.encode(), start)
        if h % modulus == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``word`` and ``n``: the words of all texts that are long and frequent enough."""
    modulus, least = p.modulus, p.least_length

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        chars = 0

        def handed_on() -> pd.DataFrame:
            words = pd.Series(list(total), dtype=object)
            return pd.DataFrame({"word": words, "n": list(total.values())})

        for part in parts:
            for doc_id, text in zip(part["id"], part["text"], strict=True):
                for word, n in words_of(doc_id, text, modulus):
                    if len(word) >= least:
                        if word not in total:
                            chars += len(word)
                        total[word] += n
                if len(total) >= KEPT_WORDS or chars >= KEPT_CHARS:
                    yield handed_on()
                    total, chars = Counter(), 0
        yield handed_on()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").alias("text"))
    counted = rows.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least_count)


class PositionIndex:
    """Bitsets per position and letter over words that agree outside a region.

    ``first`` and ``past`` bound the region in the shorter words, those of ``length``; the
    others are one longer. Bit i stands for the i-th word."""

    def __init__(self, words: list[str], length: int, first: int, past: int):
        self.first, self.past = first, past
        self.all = (1 << len(words)) - 1
        places: dict[tuple[int, str], list[int]] = defaultdict(list)
        short = bytearray(len(words) // 8 + 1)
        for i, word in enumerate(words):
            if len(word) == length:
                short[i >> 3] |= 1 << (i & 7)
            for at, letter in enumerate(word[first : past + 1], first):
                places[at, letter].append(i)
        self.short = int.from_bytes(short, "little")
        self.slices = {key: _bitset(own, len(words)) for key, own in places.items()}

    def near(self, word: str) -> int:
        """The words one replaced or one inserted code point away from a shorter one."""
        slices = self.slices
        exact, replaced, inserted = self.all, 0, 0
        for at in range(self.first, self.past):
            letter = word[at]
            here = slices.get((at, letter), 0)
            inserted = (inserted | exact) & slices.get((at + 1, letter), 0)
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
        return (replaced & self.short) | ((inserted | exact) & ~self.short)


def _bitset(places: list[int], size: int) -> int:
    bits = bytearray(size // 8 + 1)
    for i in places:
        bits[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(bits, "little")


def _ones(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    low, high = 0, least
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def counted_here(a: str, b: str, first: int, past: int) -> bool:
    """Whether the near words a and b (b not shorter) are counted in this region, the first
    that they agree outside of; false also if they are not near at all."""
    before, after = _common(a, b), _common(a[::-1], b[::-1])
    if len(a) == len(b):
        return before + after == len(a) - 1 and first <= before < past
    if before + after < len(a):
        return False
    least = len(a) - after  # the first place where the code point can be inserted
    return least <= past and (first == 0 or least > first)


def _bucket_answers(words: list[str], counts: list[int], length: int, first: int, past: int, ratio: int):
    """Per word with near words here: (word, n, how many, best count, best word)."""
    index = PositionIndex(words, length, first, past)
    found: list[list[int]] = [[] for _ in words]
    for i, word in enumerate(words):
        if len(word) == length:
            for j in _ones(index.near(word)):
                other = words[j]
                # Both of two words of one length find each other.
                if counted_here(word, other, first, past):
                    found[i].append(j)
                    if len(other) > length:
                        found[j].append(i)
    for i, near in enumerate(found):
        if near:
            best = min(near, key=lambda j: (-counts[j], words[j]))
            enough = counts[best] >= ratio * counts[i]
            yield words[i], counts[i], len(near), counts[best] if enough else None, words[best] if enough else None


#: A bucket: length of its shorter words, its region, and a hash of what they have outside it.
_KEY = ("length", "first", "past", "outside")


def _cut(words: DataFrame, regions) -> DataFrame:
    """A row per word, length class and region of ``regions`` (first, past)."""
    rows = words.select("*", F.explode(regions).alias("region")).select(
        "word", "n", "length", F.col("region.first").alias("first"), F.col("region.past").alias("past")
    )
    left = F.col("word").substr(F.lit(1), F.col("first"))
    right = F.col("word").substr(
        F.length("word") - (F.col("length") - F.col("past")) + 1, F.col("length") - F.col("past")
    )
    return rows.withColumn("outside", F.xxhash64("length", "first", "past", left, right))


def _thirds(first, past):
    """The parts of a region, none of them empty."""
    size = past - first
    bounds = [first + F.floor(size * k / PARTS).cast("int") for k in range(PARTS + 1)]
    parts = F.array(
        *(F.struct(bounds[k].alias("first"), bounds[k + 1].alias("past")) for k in range(PARTS))
    )
    return F.filter(parts, lambda r: r["first"] < r["past"])


def _buckets(words: DataFrame, least_length: int) -> DataFrame:
    """Words by bucket; every bucket small enough, or of a single position."""
    # A word is among the shorter ones of its own length and the longer ones of the one below.
    lengths = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("length")
    rows = words.select("word", "n", lengths).where(F.col("length") >= least_length)
    rows = _cut(rows, _thirds(F.lit(0), F.col("length")))
    done = None
    while True:
        rows = saved(rows, "spelling-buckets")
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("size"))
        # Few: each stands for more than BUCKET_WORDS rows. Their number is checked below.
        crowded = saved(
            sizes.where((F.col("size") > BUCKET_WORDS) & (F.col("past") - F.col("first") > 1)).select(*_KEY),
            "spelling-crowded",
        )
        n = crowded.count()
        if n == 0:
            return rows if done is None else done.unionByName(rows)
        if n <= BUCKET_WORDS:
            crowded = F.broadcast(crowded)
        small = rows.join(crowded, list(_KEY), "left_anti")
        done = small if done is None else done.unionByName(small)
        again = rows.join(crowded, list(_KEY), "left_semi")
        rows = _cut(again.select("word", "n", "length", "first", "past"), _thirds(F.col("first"), F.col("past")))


def near_words(words: DataFrame, p: Params = Params()) -> DataFrame:
    """Per word and bucket with near words: ``n_near`` and the best form among them."""
    ratio = p.ratio

    def answer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by bucket; one that an Arrow batch cuts goes on in the next.
        out: list[tuple] = []
        key, own = None, []

        def close():
            if len(own) > 1:
                length, first, past, _ = key
                names, counts = [w for w, _ in own], [n for _, n in own]
                out.extend(_bucket_answers(names, counts, length, first, past, ratio))

        def frame():
            rows = pd.DataFrame(out, columns=["word", "n", "n_near", "form_n", "form"], dtype=object)
            return rows.astype({"n": "int64", "n_near": "int64", "form_n": "Int64"})

        for part in parts:
            columns = (part[c].to_numpy().tolist() for c in (*_KEY, "word", "n"))
            for length, first, past, outside, word, n in zip(*columns, strict=True):
                now = (length, first, past, outside)
                if now != key:
                    close()
                    key, own = now, []
                own.append((word, n))
            yield frame()
            out = []
        close()
        yield frame()

    # All rows of a bucket lie in one task: buckets are bounded, so none holds much.
    dealt = _buckets(words, p.least_length).repartition(*(F.col(c) for c in _KEY)).sortWithinPartitions(*_KEY)
    return dealt.mapInPandas(answer, "word string, n long, n_near long, form_n long, form string")


def forms(words: DataFrame, p: Params = Params()) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` and ``form_n`` of every word."""
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near")).unionByName(
        near_words(words, p), allowMissingColumns=True
    )
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    total = none.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return total.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word that has a form.

    Each turn doubles the way followed. Counts grow by the ratio with every step, so ways are as
    short as the logarithm of the largest count and turns as few as the logarithm of that."""
    now = saved(found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = saved(now.join(ahead, "root", "left"), "spelling-roots")
        if joined.where("next is not null").isEmpty():
            return now
        now = joined.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word."""
    words = saved(vocabulary(docs, p), "spelling-words")
    found = saved(forms(words, p), "spelling-forms")
    led = found.join(roots(found), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

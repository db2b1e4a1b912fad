"""Toxicity scores from a factorization machine over hashed terms.

A text becomes the set of its hashed terms: lower-cased words and their stems (first four
and five characters). The machine adds a weight per term and, through low-rank factors, a
weight per pair of terms, so an insult beside a group mention can count for more than both
alone. Pairs are never listed: the sum over all of them follows from per-factor sums.

Fitting reads a bounded, documented sample of labelled rows; scoring covers every text.

Defined cases: a null or empty text has no terms and gets the score of the bias alone;
rows without a label, with a null label or with a null id are scored but never learned
from; when nothing can be learned (no rows, or one class only) every score is the share of
toxic rows, or 0 without rows; several labels of one id count as toxic if one of them is.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import per_text, saved

WORD = re.compile(r"\w+")
STEMS = (4, 5)


@dataclass(frozen=True)
class Params:
    bits: int = 18  # buckets of hashed terms: bounds the model, whatever the corpus
    factors: int = 4
    sample_rows: int = 12_000  # most labelled rows that fitting reads
    min_rows: int = 8  # rows a bucket must occur in to get a weight
    deviations: float = 5.0  # least association of such a bucket with the labels
    pair_deviations: float = 7.0  # of a pair of buckets, beyond what both alone lead to
    pair_rows: int = 2_000  # rows of either class in which pairs are counted
    pair_terms: int = 6_144  # most buckets that pairs are made of, the most frequent ones
    pairs: int = 256  # most pairs whose buckets enter, the farthest off first
    epochs: int = 25
    batch: int = 64
    rate: float = 0.2
    l2: float = 0.0001
    toxic_weight: float = 3.0  # of a toxic row, against a clean one
    threshold: float = 0.7


def word_buckets(word: str, bits: int) -> tuple[int, ...]:
    """The buckets of a word and of its stems."""
    terms = [word, *("^" + word[:n] for n in STEMS if len(word) > n)]
    return tuple(zlib.crc32(term.encode()) & ((1 << bits) - 1) for term in terms)


def term_buckets(text: str | None, bits: int) -> np.ndarray:
    """The distinct buckets of a text's terms, ascending."""
    words = set(WORD.findall(text.lower())) if text else ()
    return np.array(sorted({b for word in words for b in word_buckets(word, bits)}), np.int32)


class Machine:
    """bias + sum of w over terms + sum over pairs of terms of <v_i, v_j>."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def known(self) -> np.ndarray:
        return np.flatnonzero((self.weights != 0) | (self.factors != 0).any(axis=1))

    def raw(self, buckets: np.ndarray) -> float:
        v = self.factors[buckets]
        total = v.sum(axis=0)
        return self.bias + self.weights[buckets].sum() + 0.5 * float((total * total).sum() - (v * v).sum())

    def score(self, buckets: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(buckets), -40, 40))))


def paired(rows: list[np.ndarray], toxic: np.ndarray, p: Params) -> np.ndarray:
    """Buckets of the pairs that the labels tell apart though the buckets alone do not.

    A pair without an effect of its own has the odds of both buckets multiplied. Pairs whose
    share of toxic rows is far off that enter; a bucket that hardly occurs without the other
    says nothing about the pair. Counts are products of incidence matrices, tile by tile, over
    at most ``pair_rows`` rows of either class."""
    order = np.random.default_rng(1).permutation(len(rows))
    own = np.concatenate([order[toxic[order] > 0][: p.pair_rows], order[toxic[order] <= 0][: p.pair_rows]])
    bad = toxic[own] > 0
    seen = np.bincount(np.concatenate([rows[i] for i in own]), minlength=1 << p.bits)
    terms = np.argsort(-seen, kind="stable")[: p.pair_terms]
    terms = np.sort(terms[seen[terms] >= p.min_rows])
    place = np.full(1 << p.bits, -1)
    place[terms] = np.arange(len(terms))
    grid = np.zeros((len(own), len(terms)), np.uint8)
    for i, k in enumerate(own):
        at = place[rows[k]]
        grid[i, at[at >= 0]] = 1
    count = seen[terms].astype(float)

    def log_odds(hits, all_rows):
        share = (hits + 0.5) / (all_rows + 1.0)
        return np.log(share / (1 - share))

    alone = log_odds(grid[bad].sum(axis=0, dtype=float), count) - log_odds(bad.sum(), len(own))
    off, first, second = [np.empty(0)], [np.empty(0, int)], [np.empty(0, int)]
    tile = 1024
    for a in range(0, len(terms), tile):
        left = grid[:, a : a + tile].astype(np.float32)
        for b in range(a, len(terms), tile):
            right = grid[:, b : b + tile].astype(np.float32)
            hits = left[bad].T @ right[bad]
            both = hits + left[~bad].T @ right[~bad]
            fewer = np.minimum(count[a : a + tile, None], count[None, b : b + tile])
            odds = log_odds(bad.sum(), len(own)) + alone[a : a + tile, None] + alone[None, b : b + tile]
            share = np.clip(1 / (1 + np.exp(-odds)), 0.02, 0.98)
            z = np.abs(hits - both * share) / np.sqrt(np.maximum(both, 1) * share * (1 - share))
            i, j = np.nonzero((both >= p.min_rows) & (both <= 0.8 * fewer) & (z >= p.pair_deviations))
            keep = i + a < j + b
            off.append(z[i[keep], j[keep]])
            first.append(i[keep] + a)
            second.append(j[keep] + b)
            # Only the farthest are held, however many a tile has.
            off, first, second = ([np.concatenate(x)] for x in (off, first, second))
            best = np.argsort(-off[0], kind="stable")[: p.pairs]
            off, first, second = ([x[0][best]] for x in (off, first, second))
    return terms[np.unique(np.concatenate([first[0], second[0]]))]


def fit(rows: list[np.ndarray], toxic: np.ndarray, p: Params) -> Machine:
    """Adaptive gradient steps on the logistic loss over small batches of rows.

    Only terms whose presence goes with the labels, alone or in a pair, get weights; without
    that choice thousands of chance weights add up in long texts. The order of rows is fixed
    by a seed.
    """
    size = 1 << p.bits
    seen = np.bincount(np.concatenate(rows), minlength=size) if rows else np.zeros(size, int)
    rng = np.random.default_rng(0)
    share = float(toxic.mean()) if len(toxic) else 0.0
    w, v = np.zeros(size), np.zeros((size, p.factors))
    if not 0.0 < share < 1.0:
        # Nothing to tell apart: the bias alone answers.
        return Machine(40.0 if share else -40.0, w, v)
    # Terms told apart by the labels: the share of toxic rows among those with the term is
    # this many standard deviations off the share among all rows.
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    hits = np.bincount(np.concatenate(rows), weights=toxic[row], minlength=size)
    spread = np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    useful = (seen >= p.min_rows) & (np.abs(hits - seen * share) >= p.deviations * spread)
    useful[paired(rows, toxic, p)] = True
    v[useful] = rng.normal(0, 0.01, (int(useful.sum()), p.factors))
    rows = [r[useful[r]] for r in rows]
    bias = float(np.log(share / (1 - share)))
    w_sq, v_sq, b_sq = np.full(size, 1e-6), np.full((size, p.factors), 1e-4), 1e-6
    for _ in range(p.epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), p.batch):
            own = order[start : start + p.batch]
            sizes = np.array([len(rows[i]) for i in own])
            flat = np.concatenate([rows[i] for i in own])
            row = np.repeat(np.arange(len(own)), sizes)
            vf = v[flat]
            total = np.zeros((len(own), p.factors))
            np.add.at(total, row, vf)
            pair = 0.5 * ((total * total).sum(axis=1) - np.bincount(row, (vf * vf).sum(axis=1), len(own)))
            raw = bias + np.bincount(row, w[flat], len(own)) + pair
            error = 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40))) - toxic[own]
            error = np.where(toxic[own] > 0, p.toxic_weight * error, error)
            b_sq += (step := error.mean()) ** 2
            bias -= p.rate * step / np.sqrt(b_sq)
            terms, at = np.unique(flat, return_inverse=True)
            e = error[row] / len(own)
            gw = np.bincount(at, e, len(terms))
            gv = np.zeros((len(terms), p.factors))
            np.add.at(gv, at, e[:, None] * (total[row] - vf))
            gv += p.l2 * v[terms]
            w_sq[terms] += gw * gw
            w[terms] -= p.rate * gw / np.sqrt(w_sq[terms])
            v_sq[terms] += gv * gv
            v[terms] -= p.rate * 0.1 * gv / np.sqrt(v_sq[terms])
    return Machine(bias, w, v)


MODEL = "bucket int, weight double, factors array<double>"
#: Words whose buckets a scoring task remembers before it starts anew.
REMEMBERED = 500_000


def sample(docs: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """At most ``sample_rows`` labelled texts as buckets, chosen by a hash of the id.

    The chosen ids are bounded by that parameter, so they are sent to the texts and no
    text is shuffled."""
    toxic = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = toxic.where("toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    bits = p.bits
    buckets = per_text(lambda: lambda text: (term_buckets(text, bits),), "buckets array<int>")
    rows = found.select("doc_id", F.col("toxic").cast("double").alias("toxic"), buckets(F.col("text")).alias("t"))
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("t.buckets").alias("buckets"))


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The fitted machine as a table: a row per bucket that has weights, the bias at -1."""

    def over(parts):
        parts = list(parts) or [pd.DataFrame(columns=["doc_id", "toxic", "buckets"])]
        rows = pd.concat(parts, ignore_index=True).sort_values("doc_id", kind="stable")
        machine = fit([np.asarray(b, np.int64) for b in rows["buckets"]], rows["toxic"].to_numpy(float), p)
        known = machine.known()
        yield pd.DataFrame(
            {
                "bucket": [-1, *known.tolist()],
                "weight": [machine.bias, *machine.weights[known].tolist()],
                "factors": [[0.0] * p.factors, *machine.factors[known].tolist()],
            }
        )

    # One task fits: the sample is bounded by sample_rows.
    return saved(sample(docs, labels, p).coalesce(1).mapInPandas(over, MODEL), "toxicity-model")


def load_machine(model: DataFrame, p: Params) -> Machine:
    """From at most two to the number of bits rows, a bound fixed by the parameters."""
    size = 1 << p.bits
    weights, factors, bias = np.zeros(size), np.zeros((size, p.factors)), -40.0
    for bucket, weight, row in model.collect():
        if bucket < 0:
            bias = weight
        else:
            weights[bucket], factors[bucket] = weight, row
    return Machine(bias, weights, factors)


def score_column(spark: SparkSession, model: DataFrame, text: Column, p: Params = Params()) -> Column:
    machine = load_machine(model, p)
    sent = spark.sparkContext.broadcast((machine.bias, machine.known(), machine.weights, machine.factors))
    bits = p.bits

    def build():
        bias, known, weights, factors = sent.value
        own, known = Machine(bias, weights, factors), set(known.tolist())
        memory: dict[str, tuple[int, ...]] = {}

        def one(text: str | None) -> tuple[float]:
            found: set[int] = set()
            for word in set(WORD.findall(text.lower())) if text else ():
                buckets = memory.get(word)
                if buckets is None:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    buckets = memory[word] = tuple(b for b in word_buckets(word, bits) if b in known)
                found.update(buckets)
            return (own.score(np.array(sorted(found), np.int64)),)

        return one

    return per_text(build, "score double")(text)["score"]


def score(docs: DataFrame, labels: DataFrame, p: Params = Params(), held_out: Column | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Labels of rows where ``held_out`` (a condition on the id) is true are never read."""
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    known = labels.select("doc_id", "toxic").where(~held)
    spark = docs.sparkSession
    scored = docs.select(
        "doc_id",
        held.alias("held_out"),
        score_column(spark, train(docs, known, p), F.col("text"), p).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= p.threshold).cast("int"))

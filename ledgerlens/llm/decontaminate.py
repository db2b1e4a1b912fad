"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed
through it once; at each word it gives the length of the longest run ending there that
some item contains. Where that length reaches the window, the last words are a window of an
item. Items shorter than the window count when the whole item occurs.

The automaton is built in the tasks from the item texts. Items are sent in shards of at
most ``SHARD_BYTES`` of text, so what a task holds is bounded whatever the number of items;
more shards mean more passes over the documents, each row carrying its hits along.

Defined cases: a null or empty text or item has no words; repeated items count once per
``item_id``; a null ``item_id`` is the empty string; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import per_text, saved, unused

#: ASCII letters and digits and everything outside ASCII; over lower-cased UTF-8 bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Most bytes of item text in one automaton: some 2 million words.
SHARD_BYTES = 16 << 20


@dataclass(frozen=True)
class Limits:
    min_words: int = 10  # shorter runs of hit words stay
    max_share: float = 0.5  # a document with a larger share of hit words goes as a whole


def words_of(text: str | None) -> list[bytes]:
    # Lower-casing bytes touches A to Z only.
    return WORD.findall(text.encode().lower()) if text else []


class Automaton:
    """Suffix automaton of several word sequences; states are list positions."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state for the runs of ``q`` no longer than ``p`` and the word."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, word: bytes) -> int:
        """Append a word to the sequence that ends in ``last``."""
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        current = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = current
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[current] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return current

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self.extend(last, word)

    def finish(self, items: list[tuple[str, list[bytes]]]) -> Automaton:
        """Note, per state, which items have the window that ends there, and which short
        items end there as a whole."""
        n = self.window
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for name, words in items:
            state = 0
            for at, word in enumerate(words, 1):
                state = self.next[state][word]
                if at >= n:
                    self.items.setdefault(self.holder(state, n), set()).add(name)
            if 0 < len(words) < n:
                size = len(words)
                own = self.short.setdefault(self.holder(state, size), {})
                own.setdefault(size, set()).add(name)
        self.has_short = bool(self.short)
        return self

    def holder(self, state: int, size: int) -> int:
        """The state whose runs include the last ``size`` words of a run in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit runs of words as (first, past the last), disjoint and ascending; items hit."""
        following, link, length, n = self.next, self.link, self.length, self.window
        runs: list[tuple[int, int]] = []
        names: set[str] = set()
        state = matched = 0
        root = following[0]
        for at, word in enumerate(words):
            if state == 0:
                state = root.get(word, 0)
                matched = 1 if state else 0
                if not state or (n > 1 and not self.has_short):
                    continue
            else:
                to = following[state].get(word)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = following[state].get(word)
                if to is None:
                    matched = 0
                    continue
                state = to
                matched += 1
            size = 0
            if matched >= n:
                size = n
                names |= self.items[self.holder(state, n)]
            if self.has_short:
                s = state
                while s > 0:
                    for own, held in self.short.get(s, {}).items():
                        if own <= matched:
                            names |= held
                            size = max(size, own)
                    s = link[s]
            if size:
                first = at + 1 - size
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, at + 1))
        return runs, names


def build(items: list[tuple[str, str | None]], window: int = WINDOW) -> Automaton:
    parsed = sorted((name, words_of(text)) for name, text in items)
    automaton = Automaton(window)
    for _, words in parsed:
        automaton.add(words)
    return automaton.finish(parsed)


HITS = "n_words long, runs array<struct<first:int,past:int>>, items array<string>"


def _scanner(sent, window: int, limits: Limits | None):
    def make():
        automaton = build(sent.value, window)

        def one(text: str | None) -> tuple:
            words = words_of(text)
            runs, names = automaton.scan(words)
            hits = len(words), runs, sorted(names)
            return hits if limits is None else (*hits, _cleaned(text, runs, limits, window))

        return one

    return make


def item_shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[DataFrame]:
    """The items as (name, text), dealt by a hash over as many shards as their text needs."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + 2 * int(total) // shard_bytes  # half full on average: a hash deals unevenly
    if n == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i) for i in range(n)]


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str, name: str, window: int = WINDOW, limits: Limits | None = None
) -> DataFrame:
    """Every row of the documents and a struct ``name``: words, hit runs, items hit. With
    limits and a single shard also ``clean``, see _cleaned(), from the same pass."""
    spark, shards = docs.sparkSession, item_shards(benchmark)
    limits = limits if len(shards) == 1 else None
    schema = HITS if limits is None else f"{HITS}, clean string"
    for i, shard in enumerate(shards):
        items = [tuple(row) for row in shard.collect()]  # at most SHARD_BYTES of text
        scan = per_text(_scanner(spark.sparkContext.broadcast(items), window, limits), schema, once=True)
        found: Column = scan(F.col(text))
        if i == 0:
            docs = docs.withColumn(name, found)
        else:
            now = unused(docs.columns, "hits_of_one_shard")
            docs = docs.withColumn(now, found).withColumn(
                name,
                F.struct(
                    F.col(f"{name}.n_words").alias("n_words"),
                    _merged(F.concat(f"{name}.runs", f"{now}.runs")).alias("runs"),
                    F.array_sort(F.array_union(f"{name}.items", f"{now}.items")).alias("items"),
                ),
            )
            docs = docs.drop(now)
        if len(shards) > 1:
            docs = saved(docs, "decontaminate-shard")
    return docs


def _merged(runs: Column) -> Column:
    """Overlapping runs of one document joined."""
    empty = F.slice(runs, 1, 0)

    def add(done, run):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["first"].alias("first"), F.greatest(last["past"], run["past"]).alias("past"))
        touches = F.coalesce(last["past"] >= run["first"], F.lit(False))
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(run))
        )

    return F.aggregate(F.array_sort(runs), empty, add)


def hit_words(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + (r["past"] - r["first"]).cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: its words, hit words, hit runs and the items hit."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, "text", "found", window)
    return found.select("doc_id", "found.*").withColumn("n_hit", hit_words(F.col("runs")))


def _cleaned(text: str | None, runs: list[tuple[int, int]], limits: Limits, window: int) -> str | None:
    """The text without the runs that are to go; None where none is."""
    gone = [(first, past) for first, past in runs if past - first >= limits.min_words or past - first < window]
    return _cut(text, gone) if gone else None


def _cut(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the given runs of words; a space stands where text was cut."""
    raw = text.encode()
    spans = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for first, past in runs:
        out.append(raw[at : spans[first][0]])
        at = spans[past - 1][1]
    out.append(raw[at:])
    return b" ".join(part.strip(b" ") for part in out).decode()


def remove(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits(), window: int = WINDOW) -> DataFrame:
    """The documents, all their columns: hit runs of at least ``min_words`` words cut out
    of the text, and runs shorter than the window, which are whole short items; documents
    above ``max_share`` gone. ``n_chars`` follows the text. Rows
    without a hit stay as they are."""
    name = unused(docs.columns, "benchmark_hits")
    found = with_hits(docs, benchmark, "text", name, window, limits)
    found = found.where(hit_words(F.col(f"{name}.runs")) <= limits.max_share * F.col(f"{name}.n_words"))
    if "clean" not in found.schema[name].dataType.names:
        # The runs of several shards have met, in written rows: cutting is a pass of its own.
        def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
            pairs = ([(r["first"], r["past"]) for r in own] for own in runs)
            return pd.Series([_cleaned(t, own, limits, window) for t, own in zip(texts, pairs, strict=True)], dtype=object)

        cutter = F.pandas_udf(cut, "string").asNondeterministic()
        found = found.withColumn(name, F.col(name).withField("clean", cutter(F.col("text"), F.col(f"{name}.runs"))))
    clean = F.col(f"{name}.clean")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        found = found.withColumn("n_chars", F.coalesce(F.length(clean).cast(kind), "n_chars"))
    return found.withColumn("text", F.coalesce(clean, "text")).select(*docs.columns)

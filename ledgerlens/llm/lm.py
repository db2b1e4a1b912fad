"""Stupid-backoff scores of every document under the n-grams of all other documents.

Documents are dealt into blocks of bounded size. A block explodes into its different n-grams
of each order, as hashes with the block's counts. The count tables of all blocks are
partitioned by hash and summed; each block's n-grams join the sums, and every document is
scored in its block. Rows that travel hold many n-grams each, sorted and packed, so the
shuffle carries a few bytes per n-gram and none of the text.

A document's own counts are subtracted, so what is scored is how well the rest of the corpus
expects it. A word is scored by the longest n-gram found there: with the count of the
n-gram over that of its context, times ``backoff`` for each order given up; a word not
found at all counts as one occurrence with one more step.

Defined cases: a null or empty text has no words, a sum of 0 and a null mean; repeated rows
are documents of their own, so copies expect each other; a corpus of one document finds
nothing. N-grams are named by hashes whose width follows the size of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Params:
    order: int = 3
    backoff: float = 0.4
    block_words: int = 2_000_000
    part_grams: int = 1_000_000  # most n-grams, on average, that one summing task holds


#: Bits of an n-gram's name beyond those that number all n-grams: the expected share of
#: n-grams that meet another one's name is two to the minus this.
SPARE_BITS = 24


def pack(numbers: np.ndarray, bits: int) -> bytes:
    """Different ascending numbers of ``bits`` bits, in two or three bits each beyond the
    logarithm of their mean distance: low bits side by side, high bits as steps between
    ones."""
    n = len(numbers)
    low = max(0, bits - n.bit_length())
    plain = np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, count=low, bitorder="little")
    steps = np.zeros((1 << (bits - low)) + n, np.uint8)
    steps[(numbers >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    head = n.to_bytes(4, "little") + bytes([bits])
    return head + np.packbits(plain, bitorder="little").tobytes() + np.packbits(steps, bitorder="little").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    n, bits = int.from_bytes(raw[:4], "little"), raw[4]
    low = max(0, bits - n.bit_length())
    cut = 5 + (n * low + 7) // 8
    plain = np.zeros((n, 64), np.uint8)
    plain[:, :low] = np.unpackbits(np.frombuffer(raw[5:cut], np.uint8), count=n * low, bitorder="little").reshape(n, low)
    numbers = np.packbits(plain, axis=1, bitorder="little").view("<u8").ravel()
    steps = np.unpackbits(np.frombuffer(raw[cut:], np.uint8), bitorder="little")
    high = np.flatnonzero(steps)[:n] - np.arange(n)
    return numbers | (high.astype(np.uint64) << np.uint64(low))


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count, coded by its frequency, as most counts are small; those of 255 and
    more follow in eight."""
    large = counts[counts >= 255].astype("<u8")
    plain = np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(plain)


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(raw)
    counts = np.frombuffer(plain, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(plain, "<u8", offset=n)
    return counts


BLOCKS = "block long, n_words long, ids array<{}>, sizes array<long>, words binary, vocabulary binary"


def pack_words(numbers: np.ndarray) -> bytes:
    """Numbers below 2**31, their low bytes first: most high bytes are 0."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())


def unpack_words(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<i4").ravel()


def pack_vocabulary(words: list[str]) -> bytes:
    """Words as compressed text, or their hashes where these are shorter."""
    text = zstandard.ZstdCompressor(level=9).compress("\n".join(words).encode())
    return b"t" + text if len(text) < 8 * len(words) else b"h" + _hashes(words).tobytes()


def unpack_vocabulary(raw: bytes) -> np.ndarray:
    """The hashes of the words."""
    if raw[:1] == b"h":
        return np.frombuffer(raw, "<u8", offset=1)
    return _hashes(zstandard.ZstdDecompressor().decompress(raw[1:]).decode().split("\n"))


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), "<u8", len(words))


def blocks(docs: DataFrame, p: Params) -> DataFrame:
    """A row per block, written: its vocabulary, the words of its documents as numbers in that,
    and how many each document has."""
    schema = BLOCKS.format(dict(docs.dtypes)["doc_id"])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, owners = -1, []
        sizes: list[int] = []
        words: list[str] = []
        numbers: dict[str, int] = {}
        ids: list[np.ndarray] = []
        held = 0

        def block() -> pd.DataFrame:
            # By frequency, so that most numbers are small and the column compresses.
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words), dtype=np.int32)
            vocabulary = pack_vocabulary([words[i] for i in order])
            row = (first, held, owners, sizes, pack_words(rank[flat]), vocabulary)
            return pd.DataFrame([row], columns=[field.split()[0] for field in BLOCKS.split(", ")])

        for frame in frames:
            for key, doc, text in zip(frame["key"], frame["doc_id"].astype(object), frame["text"], strict=True):
                first = first if owners else key
                found = WORD.findall(text) if text else []
                for w in set(found):
                    if w not in numbers:
                        numbers[w] = len(words)
                        words.append(w)
                ids.append(np.fromiter((numbers[w] for w in found), np.int32, len(found)))
                owners.append(None if pd.isna(doc) else doc)
                sizes.append(len(found))
                held += len(found)
                if held >= p.block_words:
                    yield block()
                    owners, sizes, words, ids, held = [], [], [], [], 0
                    numbers = {}
        if owners:
            yield block()

    numbered = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return saved(numbered.mapInPandas(cut, schema), "lm-blocks")


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass(frozen=True)
class Split:
    """How n-grams are named and dealt: by so many bits, over partitions by the first ones."""

    name: int
    first: int

    @classmethod
    def of(cls, grams: int, p: Params) -> Split:
        first = (grams // p.part_grams).bit_length()
        return cls(min(64, grams.bit_length() + SPARE_BITS), first)

    def part(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(self.name - self.first)).astype(np.int64)

    def slice(self, part):
        """The slice of a block that a partition falls in."""
        return part >> max(0, self.first - SLICE_BITS)

    def rest(self, grams: np.ndarray) -> np.ndarray:
        """Names without the bits that tell the partition."""
        return grams & np.uint64((1 << (self.name - self.first)) - 1)


#: A block's n-grams are sorted in so many slices, two to the power of this, and scored in
#: runs of so many words: what a task holds beyond the block itself is a part of its size.
SLICE_BITS = 3
RUN_WORDS = 1 << 18


class Block:
    """The words of a block's documents and their n-grams."""

    def __init__(self, sizes: np.ndarray, words: bytes, vocabulary: bytes, split: Split):
        self.split = split
        self.sizes = np.asarray(sizes, np.int64)
        self.hashes = unpack_vocabulary(vocabulary)[unpack_words(words)]
        self.owner = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.place = np.arange(len(self.hashes), dtype=np.int32)
        self.place -= np.repeat((np.cumsum(self.sizes) - self.sizes).astype(np.int32), self.sizes)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The ends of all n-grams, as places of words, and their names."""
        h = _mix(self.hashes)
        for _ in range(order - 1):
            h = np.roll(h, 1)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += self.hashes
            h = _mix(h)
        h >>= np.uint64(64 - self.split.name)
        if order == 1:
            return np.arange(len(h), dtype=np.int32), h
        ends = np.flatnonzero(self.place >= order - 1).astype(np.int32)
        return ends, h[ends]

    def slices(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The same in slices of whole partitions, in the order of these, numbered by :meth:`Split.slice`."""
        ends, names = self.grams(order)
        number = self.split.slice(self.split.part(names)).astype(np.uint8)
        for i in range(1 << min(SLICE_BITS, self.split.first)):
            at = np.flatnonzero(number == i)
            yield i, ends[at], names[at]


COUNTED = "part long, block long, n int, grams binary, counts binary"


def counted(cut: DataFrame, p: Params, split: Split) -> DataFrame:
    """Each block's different n-grams and counts, split by the first bits of the hash."""
    columns = [field.split()[0] for field in COUNTED.split(", ")]

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = Block(row.sizes, row.words, row.vocabulary, split)
                for n in range(1, p.order + 1):
                    for _, _, names in block.slices(n):
                        grams, counts = np.unique(names, return_counts=True)
                        part, rest = split.part(grams), split.rest(grams)
                        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
                        rows = [
                            (int(part[a]), row.block, n, pack(rest[a:b], split.name - split.first), pack_counts(counts[a:b]))
                            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                            if b > a
                        ]
                        yield pd.DataFrame(rows, columns=columns)

    return cut.select("block", "sizes", "words", "vocabulary").mapInPandas(over, COUNTED)


SUMMED = "block long, n int, part long, counts binary"


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    """The counts of one partition summed over blocks; per block, the sums of its n-grams."""
    rows = []
    for n, own in frame.groupby("n"):
        grams = [unpack(raw) for raw in own["grams"]]
        sizes = [len(g) for g in grams]
        counts = [unpack_counts(raw, size) for raw, size in zip(own["counts"], sizes, strict=True)]
        place = np.unique(np.concatenate(grams), return_inverse=True)[1]
        sums = np.bincount(place, np.concatenate(counts)).astype(np.int64)[place]
        ends = np.cumsum(sizes)
        for block, part, a, b in zip(own["block"], own["part"], ends - sizes, ends, strict=True):
            rows.append((block, n, part, pack_counts(sums[a:b])))
    return pd.DataFrame(rows, columns=[field.split()[0] for field in SUMMED.split(", ")])


SCORES = "doc_id {}, n_words long, log_score double, n_found array<long>"


def _scored(p: Params, total: int, split: Split):
    columns = [field.split()[0] for field in SCORES.split(", ")]

    def elsewhere(block: Block, replies: dict[tuple[int, int], list], order: int) -> np.ndarray:
        """Occurrences elsewhere of the n-gram ending at each word."""
        if order == 0:
            return total - np.repeat(block.sizes, block.sizes)
        others = np.zeros(len(block.hashes), np.int64)
        for i, ends, names in block.slices(order):
            grams, place = np.unique(names, return_inverse=True)
            sums = np.zeros(len(grams), np.int64)
            part = split.part(grams)
            for of, raw in replies.get((order, i), []):
                a, b = np.searchsorted(part, [of, of + 1])
                sums[a:b] = unpack_counts(raw, b - a)
            own = block.owner[ends].astype(np.int64) * len(grams) + place
            times = np.unique(own, return_inverse=True, return_counts=True)
            others[ends] = sums[place] - times[2][times[1]]
        return others

    def over(frame: pd.DataFrame) -> pd.DataFrame:
        state = frame[frame["n"] == 0].iloc[0]
        replies: dict[tuple[int, int], list] = {}
        for reply in frame[frame["n"] > 0].itertuples(index=False):
            replies.setdefault((reply.n, split.slice(reply.part)), []).append((reply.part, reply.counts))
        block = Block(state["sizes"], state["words"], state["vocabulary"], split)
        n_docs, n = len(block.sizes), len(block.hashes)
        score, found = np.zeros(n), np.zeros(n, np.int8)
        open_ = np.ones(n, bool)
        others = elsewhere(block, replies, p.order)
        for order in range(p.order, 0, -1):
            shorter = elsewhere(block, replies, order - 1)
            hit = open_ & (others > 0)
            for start in range(0, n, RUN_WORDS):
                at = start + np.flatnonzero(hit[start : start + RUN_WORDS])
                # The context ends a word earlier; for single words it is the whole corpus.
                context = shorter[at - 1] if order > 1 else shorter[at]
                steps = np.minimum(p.order, block.place[at] + 1) - order
                score[at] = np.log(others[at] / context) + steps * np.log(p.backoff)
            found[hit], open_ = order, open_ & ~hit
            others = shorter
        for start in range(0, n, RUN_WORDS):
            at = start + np.flatnonzero(open_[start : start + RUN_WORDS])
            steps = np.minimum(p.order, block.place[at] + 1)
            score[at] = steps * np.log(p.backoff) - np.log(np.maximum(others[at], 1))
        sums = np.bincount(block.owner, score, n_docs)
        by_order = [np.bincount(block.owner[found == k], minlength=n_docs) for k in range(p.order + 1)]
        rows = zip(state["ids"], block.sizes, sums, np.stack(by_order, axis=1).tolist(), strict=True)
        return pd.DataFrame(list(rows), columns=columns)

    return over


def score(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``log_score`` (the sum of the words' logarithms),
    ``mean_log_score`` and ``n_found``, words by the order found, first those not found."""
    kind = dict(docs.dtypes)["doc_id"]
    cut = blocks(docs, p)
    total = cut.agg(F.sum("n_words")).first()[0] or 0
    split = Split.of(p.order * total, p)
    sums = counted(cut, p, split).groupBy("part").applyInPandas(_summed, SUMMED)
    # A block's own row beside the sums of its n-grams.
    state = ["ids", "sizes", "words", "vocabulary"]
    types = dict(cut.dtypes)
    own = cut.select(
        "block",
        F.lit(0).alias("n"),
        F.lit(0).cast("long").alias("part"),
        F.lit(None).cast("binary").alias("counts"),
        *state,
    )
    both = own.unionByName(sums.select("*", *(F.lit(None).cast(types[c]).alias(c) for c in state)))
    scores = both.groupBy("block").applyInPandas(_scored(p, total, split), SCORES.format(kind))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score")
    return scores.select("doc_id", "n_words", "log_score", mean, "n_found")

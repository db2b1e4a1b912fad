"""Similarity join of documents on the Jaccard coefficient of their word shingles.

A MinHash LSH forest finds candidates. Each of ``trees`` tries sorts the documents by the
values of ``depth`` hash functions; documents that share a prefix of a trie are candidates.
Matching begins at the longest prefix that gives a pair at the threshold the least chance;
prefixes are shortened, a value at a time, until the similarities met in this corpus are found
with the target recall. What longer prefixes found stays. In a node of a trie all documents are
compared, by their signatures, with its least one only; those that are not near it go on among
themselves in the nodes one value below, down to the leaves.

Candidates are verified exactly on whole shingle sets. Documents are grouped by connected
candidates; a group is cut into blocks, and each pair of blocks is one unit of work, so a
group of any size spreads over tasks. Verification returns counts and one edge per document,
never a row per pair.

Defined cases: a text of fewer than five words is one shingle; a null or blank text has none
and is linked to nothing, not even its copies; repeated rows are linked to each other; a
null ``doc_id`` is kept and never names a class unless all ids of the class are null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved, unused
from ledgerlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    trees: int = 32
    depth: int = 10
    shortest: int = 6
    recall: float = 0.9999  # over the similarities of the matches found
    least: float = 0.999  # for a pair exactly at the threshold
    unlikely: float = 0.55  # matches whose signatures agree less are not verified
    settled: float = 0.8  # documents less like the least one of their node go on below it
    block: int = 512  # documents of a block
    batch: int = 1024  # documents of small groups that one unit of work verifies

    def chance(self, similarity, depth: int):
        """That two documents share a prefix of this length in some tree."""
        return 1 - (1 - similarity**depth) ** self.trees


#: Hashes of words that a task remembers; longer words are hashed anew each time.
REMEMBERED_WORDS, LONG_WORD = 100_000, 64


class Shingler:
    """Distinct shingles of a text as ascending 64-bit hashes; words are remembered."""

    def __init__(self, words: int):
        self.words, self.memory = words, {}
        self.powers = np.array([0x9E3779B97F4A7C15**i % 2**64 for i in range(1, words + 1)], np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        found = WORD.findall(text) if text else ()
        if not found:
            return np.empty(0, np.uint64)
        memory, long = self.memory, {}
        if len(memory) > REMEMBERED_WORDS:
            memory.clear()
        for word in set(found):
            if word not in memory:
                (memory if len(word) <= LONG_WORD else long)[word] = xxhash.xxh64_intdigest(word.encode())
        known = memory | long if long else memory
        hashes = np.array([known[w] for w in found], np.uint64)
        n, k = len(hashes), min(self.words, len(hashes))
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            out += hashes[i : n - k + 1 + i] * self.powers[i]
        return np.unique(_mix(out))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signer:
    """``trees`` times ``depth`` MinHash values of a shingle set."""

    def __init__(self, p: Params):
        rng = np.random.default_rng(20)
        n = p.trees * p.depth
        self.p = p
        self.factors = rng.integers(0, 2**32, (n, 1), np.uint32) | np.uint32(1)
        self.masks = rng.integers(0, 2**32, (n, 1), np.uint32)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """All functions at once over slices of the shingles that fit the cache."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.factors), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 1024):
            room = low[None, at : at + 1024] ^ self.masks
            room *= self.factors
            np.minimum(out, room.min(axis=1), out=out)
        return out

    def prefixes(self, signature: np.ndarray) -> np.ndarray:
        """A hash of the shortest prefix in each tree, the tree's number included."""
        p = self.p
        rows = signature.reshape(p.trees, p.depth)[:, : p.shortest].astype(np.uint64)
        out = np.arange(1, p.trees + 1, dtype=np.uint64)
        for i in range(p.shortest):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i] + np.uint64(1))
        return out.astype(np.int64)


def _key():
    """Two hashes of a text: 128 bits name it."""
    return F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2")


SIGNED = "k1 long, k2 long, n_shingles int, prefixes array<long>, signature binary"


def signed(docs: DataFrame, p: Params) -> DataFrame:
    """Every different text that has words, once: ``node``, its keys, the prefix hash of
    each tree and the signature, a byte per value."""
    names = [field.split()[0] for field in SIGNED.split(", ")]

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, signer = Shingler(p.words), Signer(p)
        for frame in frames:
            rows = []
            for k1, k2, text in zip(frame["k1"], frame["k2"], frame["text"], strict=True):
                shingles = shingler(text)
                if len(shingles):
                    signature = signer(shingles)
                    low = (signature & np.uint32(255)).astype(np.uint8).tobytes()
                    rows.append((k1, k2, len(shingles), signer.prefixes(signature), low))
            yield pd.DataFrame(rows, columns=names)

    rows = docs.where("text is not null").select(*_key(), "text").mapInPandas(sign, SIGNED)
    texts = rows.groupBy("k1", "k2").agg(
        *(F.any_value(c).alias(c) for c in ("n_shingles", "prefixes", "signature"))
    )
    # The numbers are fixed by writing them.
    return saved(texts.withColumn("node", F.monotonically_increasing_id()), "jaccard-signed")


def _estimate():
    """Estimated similarity of two signatures."""

    def over(one: pd.Series, two: pd.Series) -> pd.Series:
        same = [np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) for a, b in zip(one, two, strict=True)]
        # Different values share their byte once in 256 times.
        return pd.Series((np.array(same, float) - 1 / 256) / (1 - 1 / 256)).clip(lower=0.0)

    return F.pandas_udf(over, "double")


def _node_of_trie(p: Params, depth: int):
    """The node of ``tree`` at this depth: the shortest prefix and the values below it."""
    prefix = F.element_at("prefixes", F.col("tree") + 1)
    below = F.substring("signature", F.col("tree") * p.depth + p.shortest + 1, F.lit(depth - p.shortest))
    return F.xxhash64(prefix, below) if depth > p.shortest else prefix


def matches(texts: DataFrame, p: Params, depth: int) -> DataFrame:
    """Pairs (a, b) that share a prefix of at least this length, b being the least document of
    their node: at most as many as documents in nodes, not as pairs."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(p.trees - 1))).alias("tree")
    rows = texts.select("node", "prefixes", "signature", trees)
    one = texts.select(F.col("node").alias("a"), F.col("signature").alias("of_a"))
    two = texts.select(F.col("node").alias("b"), F.col("signature").alias("of_b"))
    found = None
    for level in range(depth, p.depth + 1):
        rows = rows.select("node", "tree", _node_of_trie(p, level).alias("bucket"))
        hubs = rows.groupBy("bucket").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
        members = rows.join(hubs, "bucket").where("node > b").select(F.col("node").alias("a"), "b", "tree")
        members = saved(members, "jaccard-members")
        both = members.select("a", "b").distinct().join(one, "a").join(two, "b")
        edges = both.select("a", "b", _estimate()("of_a", "of_b").alias("estimate"))
        edges = saved(edges, "jaccard-matches")
        found = edges if found is None else found.unionByName(edges)
        apart = edges.where(F.col("estimate") < p.settled)
        if level == p.depth or apart.isEmpty():
            break
        below = members.join(apart, ["a", "b"]).select(F.col("a").alias("node"), "tree")
        rows = below.join(texts.select("node", "prefixes", "signature"), "node")
    return found


def first_depth(p: Params) -> int:
    """The longest prefix that gives a pair at the threshold the least chance."""
    for depth in range(p.depth, p.shortest, -1):
        if p.chance(p.threshold, depth) >= p.least:
            return depth
    return p.shortest


def recall(found: DataFrame, p: Params, depth: int) -> float:
    """Mean chance that likely matches, as similar as those found, share such a prefix."""
    similarity = F.least(F.col("estimate"), F.lit(1.0))
    chance = 1 - F.pow(1 - F.pow(similarity, F.lit(depth)), F.lit(p.trees))
    mean = found.where(F.col("estimate") >= p.threshold).agg(F.avg(chance)).first()[0]
    return 1.0 if mean is None else mean


def candidates(texts: DataFrame, p: Params) -> DataFrame:
    """Matches (a, b, estimate) of the forest at the prefix length that the corpus asks for,
    and all that longer prefixes gave."""
    depth = first_depth(p)
    found = matches(texts, p, depth)
    while depth > p.shortest and recall(found, p, depth) < p.recall:
        depth -= 1
        found = found.unionByName(matches(texts, p, depth))
    return found


def _similar(sets: list[np.ndarray], first: int, p: Params) -> np.ndarray:
    """Which of the first ``first`` sets are similar to which of all: exact, by products of
    incidence matrices over slices of the shingles."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1  # a shingle of one set alone meets no other
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((first, len(sets)), np.float32)
    width = 4096
    for at in range(0, int(column.max()) + 1 if len(column) else 0, width):
        own = (column >= at) & (column < at + width)
        grid = np.zeros((len(sets), width), np.float32)
        grid[owner[own], column[own] - at] = 1
        common += grid[:first] @ grid.T
    together = sizes[:first, None] + sizes[None, :] - common
    return common >= p.threshold * together - 1e-6 * together


VERIFIED = "node long, root long, n_docs long, n_texts long"


def _verify(p: Params):
    """One unit of work: links of the documents of a pair of blocks, or of small groups."""
    names = [field.split()[0] for field in VERIFIED.split(", ")]

    def unit(frame: pd.DataFrame) -> Iterator[tuple]:
        low, high = frame["one"].iloc[0], frame["two"].iloc[0]
        mine = (frame["block"] == low).to_numpy()
        frame = pd.concat([frame[mine], frame[~mine]])
        sets = [np.asarray(s, np.int64).view(np.uint64) for s in frame["shingles"]]
        nodes, copies = frame["node"].to_numpy(), frame["copies"].to_numpy()
        first = int(mine.sum())
        linked = _similar(sets, first, p)
        np.fill_diagonal(linked[:, :first], False)
        if low != high:  # pairs within a block are another unit's
            linked[:, :first] = False
        root = np.arange(len(nodes))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
        docs, texts = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        docs[:first] += linked @ copies
        texts[:first] += linked.sum(axis=1)
        if low != high:
            docs += linked.T @ copies[:first]
            texts += linked.sum(axis=0)
        for i, node in enumerate(nodes):
            if texts[i]:
                yield node, nodes[top(i)], docs[i], texts[i]

    def over(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [row for _, part in frame.groupby("comp", sort=False) for row in unit(part)]
        return pd.DataFrame(rows, columns=names)

    return over


def verified(docs: DataFrame, texts: DataFrame, groups: DataFrame, p: Params) -> DataFrame:
    """Exact links within the candidate groups: ``node``, ``root`` (a linked node or the
    node itself), linked documents and linked different texts, per unit of work."""
    shingles = "node long, comp long, copies long, size long, shingles array<long>"

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(p.words)
        for frame in frames:
            sets = [shingler(text).view(np.int64) for text in frame["text"]]
            yield frame.drop(columns="text").assign(shingles=sets)

    sizes = groups.groupBy("comp").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "comp").join(texts.select("node", "k1", "k2"), "node")
    rows = docs.where("text is not null").select(*_key(), "text")
    # One row per text: copies are told apart from their text by the count only.
    counts = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    members = members.join(counts, ["k1", "k2"])
    picked = rows.join(members, ["k1", "k2"]).select("node", "comp", "copies", "size", "text")
    sets = picked.mapInPandas(cut, shingles).groupBy("node", "comp", "copies", "size").agg(
        F.any_value("shingles").alias("shingles")
    )
    blocks = F.ceil(F.col("size") / p.block)
    sets = sets.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    # A block meets every block once; blocks of one group are as many as its size needs.
    paired = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    paired = paired.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    total = groups.count()
    unit = F.when(F.col("size") > p.block, F.xxhash64("comp", "one", "two")).otherwise(
        F.pmod(F.xxhash64("comp"), F.lit(1 + total // p.batch))
    )
    return paired.withColumn("unit", unit).groupBy("unit").applyInPandas(_over_units(p), VERIFIED)


def _over_units(p: Params):
    over = _verify(p)

    def units(frame: pd.DataFrame) -> pd.DataFrame:
        # Two pairs of blocks could meet under one hash; each is verified by itself.
        parts = [over(part) for _, part in frame.groupby(["one", "two"], sort=False)]
        return pd.concat(parts, ignore_index=True)

    return units


def join(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per different text that has links or copies or neither: its keys, ``n_docs`` and
    ``n_texts`` linked to it, and ``root``, equal for texts connected by links."""
    texts = signed(docs.select("doc_id", "text"), p)
    near = candidates(texts, p).where(F.col("estimate") >= p.unlikely)
    groups = components(near.select("a", "b").distinct()).select("node", F.col("root").alias("comp"))
    links = saved(verified(docs, texts, groups, p), "jaccard-links")
    sums = links.groupBy("node").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_texts").alias("n_texts"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    out = texts.select("node", "k1", "k2").join(sums, "node", "left").join(roots, "node", "left")
    return out.select(
        "k1",
        "k2",
        F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
        F.coalesce("root", "node").alias("root"),
    )


def classes(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the least id of the documents
    connected to it by links), ``copy_id`` (of its exact copies), ``n_links`` (documents
    similar to it, copies included) and ``n_texts`` (different texts similar to it)."""
    rows = docs.select("doc_id", *_key(), F.col("text").isNotNull().alias("has_text"))
    linked = join(docs, p)
    light = rows.join(linked, ["k1", "k2"], "left")
    known = light.where("has_text and root is not null")
    copies = known.groupBy("k1", "k2", "root").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("copy_id"))
    tops = copies.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    named = copies.join(tops, "root").join(linked.drop("root"), ["k1", "k2"])
    named = named.select("k1", "k2", "class_id", "copy_id", (F.col("n_docs") + F.col("n_copies") - 1).alias("n_links"), "n_texts")
    out = rows.join(named, ["k1", "k2"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_texts", zero).alias("n_texts"),
    )


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents, all their columns, one of each group connected by links: the one with
    the least id. Texts without words all stay."""
    k1, k2 = unused(docs.columns, "text_key_1"), unused(docs.columns, "text_key_2")
    a, b = _key()
    linked = join(docs, p)
    rows = docs.select("doc_id", *_key()).where("text is not null").join(linked, ["k1", "k2"])
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "k1", "k2")
    best = rows.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    best = best.select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2), F.col("best.doc_id").alias("kept_id"), "n")
    keyed = docs.withColumns({k1: F.xxhash64("text"), k2: F.xxhash64(F.lit(7), "text")})
    blank = docs.where(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    kept_id = unused(docs.columns, "kept_id")
    n = unused(docs.columns, "rows_of_group")
    best = best.withColumnsRenamed({"kept_id": kept_id, "n": n})
    chosen = keyed.where("text is not null").join(best, [k1, k2])
    chosen = chosen.where(F.col("doc_id").eqNullSafe(F.col(kept_id)))
    single = chosen.where(F.col(n) == 1)
    # Rows repeated with the same id and text: any one of them.
    several = chosen.where(F.col(n) > 1).dropDuplicates([k1, k2])
    return single.unionByName(several).select(*docs.columns).unionByName(blank)

"""Merkle manifest of a dataset: a hash tree per group, a root over the groups, and proofs.

A row's leaf hashes its fields. The leaves of a group ascend by id; every eight consecutive
nodes become one, until one is left, the group's subroot. The subroots, in order of the
groups, are the leaves of one more tree, whose top is the root of the dataset.

The trees are rolled up in blocks of 512 consecutive nodes. Within a block the digits of the
rank are grouped away one after the other, each time nesting the former structs as children,
so a block is one row that holds its subtree. The tops of the blocks are the nodes of the next
round. Proofs come back down the same way: a block's path from its top to the root arrives as
one more row of the block's group, and the nested structs are opened level by level, each
child taking the hashes of its run to the left and right of it. No join finds a sibling.

No task holds more than blocks: ranks come from range partitions and their counts, so a group
with most of all rows is spread like any other, and so are repeated rows.

Defined cases: a null field is hashed as ``-``; a null group is a group of its own and comes
first; a null id comes first within its group; rows with one id ascend by their leaf, and rows
alike in everything are each a leaf; a table without rows has no root and gives no rows; further
columns are neither hashed nor read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

FANOUT = 8
#: Levels that one row nests: blocks of 512 nodes, about 0.1 MB of a block's leaves.
BLOCK_LEVELS = 3
#: Offsets of ranks (a row per range partition and group) are broadcast up to this many rows.
BROADCAST_OFFSETS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BITS = 3  # of a digit of the rank
_BLOCK = FANOUT**BLOCK_LEVELS
_IN_PARTITION = (1 << 33) - 1  # part of a running id that counts within its partition


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon and its text, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["left"], node, run["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank``, their place within ``tree`` (from 0), and ``n``, its rows.

    ``order`` orders the rows of a tree. ``spread`` only parts rows that are alike."""
    by = ["tree", *order, "spread"]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    dealt = saved(sorted_rows.withColumn("part", F.spark_partition_id()).withColumn("at", at), "manifest-ranks")
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    # A tree has at most one row per partition here.
    own = Window.partitionBy("tree")
    before = F.sum("rows").over(own.orderBy("part")) - F.col("rows") - F.col("first")
    offsets = counts.select("tree", "part", before.alias("before"), F.sum("rows").over(own).alias("n"))
    offsets = saved(offsets, "manifest-offsets")
    if offsets.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    found = dealt.join(offsets, ["tree", "part"])
    return found.withColumn("rank", F.col("at") + F.col("before")).drop("part", "at", "before", "spread")


def _height(n: Column, levels: int = 20) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the least h with 8^h >= n."""
    return sum(((n > FANOUT**k).cast("int") for k in range(levels)), F.lit(0))


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block: ``tree``, ``block``, ``n``, ``height``, ``hash`` and nested ``kids``.

    ``nodes``: ``tree``, ``rank``, ``n``, ``hash`` and ``item``, what a node brings along."""
    digit = [F.shiftright("rank", _BITS * k).bitwiseAND(F.lit(FANOUT - 1)) for k in range(BLOCK_LEVELS)]
    names = [f"digit{k}" for k in range(BLOCK_LEVELS)]
    keys = ["tree", "block", "n", "height"]
    level = nodes.select(
        "tree",
        F.shiftright("rank", _BITS * BLOCK_LEVELS).alias("block"),
        "n",
        _height(F.col("n")).alias("height"),
        *(d.alias(name) for d, name in zip(digit[1:], names[1:], strict=True)),
        F.struct(digit[0].alias("at"), "hash", "item").alias("node"),
    ).repartition("tree", "block")
    for k in range(1, BLOCK_LEVELS + 1):
        # The digit below goes; as the rows lie by (tree, block), no level shuffles again.
        level = level.groupBy(*keys, *names[k:]).agg(F.array_sort(F.collect_list("node")).alias("kids"))
        own = F.when(F.col("height") >= k, F.sha2(F.array_join("kids.hash", ""), 256))
        own = F.coalesce(own, F.col("kids")[0]["hash"]).alias("hash")
        if k < BLOCK_LEVELS:
            node = F.struct(F.col(names[k]).alias("at"), "hash", F.col("kids").alias("item"))
            level = level.select(*keys, *names[k + 1 :], "kids", own, names[k])
            level = level.select(*keys, *names[k + 1 :], node.alias("node"))
        else:
            level = level.select(*keys, "kids", own)
    return level


def _rolled_up(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of blocks, from the leaves up to one block per tree."""
    rounds = [saved(_blocks(nodes), "manifest-blocks")]
    while (rounds[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = rounds[-1].select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("n") / _BLOCK).cast("long").alias("n"),
            "hash",
            F.struct("block").alias("item"),
        )
        rounds.append(saved(_blocks(above), "manifest-blocks"))
    return rounds


def _opened(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes of blocks: ``tree``, ``hash``, ``item`` and ``path``, the runs on the way up.

    ``blocks``: as of :func:`_blocks` with ``path``, the way up from the block, and ``carried``."""
    rows = blocks
    for k in range(BLOCK_LEVELS, 0, -1):
        rows = rows.select(
            "tree", "height", *carried, "path", F.col("kids.hash").alias("run"), F.posexplode("kids").alias("i", "kid")
        )
        left = F.array_join(F.slice("run", F.lit(1), F.col("i")), "")
        right = F.array_join(F.slice("run", F.col("i") + 2, F.lit(FANOUT)), "")
        run = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(F.col("height") >= k, F.concat(run, "path")).otherwise(F.col("path"))
        item = F.col("kid.item").alias("kids" if k > 1 else "item")
        rows = rows.select("tree", "height", *carried, path.alias("path"), F.col("kid.hash").alias("hash"), item)
    return rows.drop("height")


def _with_paths(blocks: DataFrame, paths: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Blocks with the path of their top: it comes as one more row of the block's group."""
    both = blocks.select("tree", "block", "height", "kids").unionByName(
        paths.select("tree", "block", "path", *carried), allowMissingColumns=True
    )
    last = [F.first(c, ignorenulls=True).alias(c) for c in ("height", "kids", "path", *carried)]
    return both.groupBy("tree", "block").agg(*last)


def _brought_down(rounds: list[DataFrame], paths: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Paths of all leaves, from those of the trees' only blocks of the last round."""
    for blocks in reversed(rounds[1:]):
        nodes = _opened(_with_paths(blocks, paths, carried), carried)
        paths = nodes.select("tree", F.col("item.block").alias("block"), "path", *carried)
    return _opened(_with_paths(rounds[0], paths, carried), carried)


def proofs(
    rows: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    id_: str = "doc_id",
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per row: the id, ``leaf``, ``subroot``, ``root``, ``path`` and the columns of ``also``.

    ``path`` has a struct per level up to the root: the hashes of the row's run ``left`` and
    ``right`` of it, joined. :func:`fold` leads from a leaf and a path to the root."""
    also = dict(also or {})
    # A group's name keeps the order of the groups, the null one first.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")
    leaves = rows.select(
        tree,
        F.col(id_).alias("id"),
        leaf_hash(*(F.col(c) for c in fields)).alias("hash"),
        F.struct(F.lit(0).alias("none"), *(value.alias(name) for name, value in also.items())).alias("also"),
        F.monotonically_increasing_id().alias("spread"),
    )
    ranked = _ranked(saved(leaves, "manifest-leaves"), ["id", "hash"])
    rounds = _rolled_up(ranked.select("tree", "rank", "n", "hash", F.struct("id", "also").alias("item")))

    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash", F.lit(0).alias("spread"))
    tops = _ranked(tops, ["name"]).select("tree", "rank", "n", "hash", F.struct("name").alias("item"))
    top_rounds = _rolled_up(tops)
    start = top_rounds[-1].select(
        "tree", "block", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("root")
    )
    trees = _brought_down(top_rounds, start, ["root"])
    start = trees.select(
        F.col("item.name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "root", F.col("hash").alias("subroot")
    )
    found = _brought_down(rounds, saved(start, "manifest-trees"), ["root", "subroot"])
    return found.select(
        F.col("item.id").alias(id_),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "path",
        *(F.col(f"item.also.{name}").alias(name) for name in also),
    )

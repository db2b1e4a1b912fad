"""Removal of long repeated passages with sharded suffix arrays.

A window is a string of ``window`` bytes of one text. Windows that occur twice anywhere are
found, and every byte that one covers is removed.

Equal windows must meet in one shard, whatever texts they are in. Each window is named by its
anchor: the string of ``gram`` bytes in it whose hash is least. Equal windows have equal
anchors, so shards are dealt by anchor. A stretch of windows with one anchor is a region:

1. anchors that occur once are done with, as no window with them can occur twice;
2. regions that occur twice as a whole, with the same anchor, are repeated throughout;
3. the other regions, those at the edges of passages and around edits, go to shards by
   anchor. A shard's suffix array is built by induced sorting; windows that share all their
   bytes with a neighbour in suffix order, by the permuted common prefixes, are repeated.

An anchor with very many different regions, as at the ends of a common passage, is split
before that: halving the range of places that the anchor has in a window lengthens the part
that all windows of a half share, which names the half anew, until few regions are left
under a name.

Defined cases: a null text has no bytes; texts shorter than a window lose nothing; repeated
rows and equal texts of a window or more are removed as a whole; the text that is left may be
cut within a character, so it is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved
from ledgerlens.llm.suffixes import permuted_common_prefix, suffix_array


@dataclass(frozen=True)
class Params:
    window: int = 200
    gram: int = 32
    chunk: int = 8 << 20  # window starts handled at once in a long text
    regions: int = 4096  # most different regions of one anchor that go to one shard
    shard_bytes: int = 1 << 20  # aimed-at text of a shard
    step_bytes: int = 1 << 20  # text after which a suffix array is closed, between anchors


_BYTES = np.random.default_rng(4).integers(0, 2**64, 256, np.uint64)


def _grams(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every string of ``size`` bytes; ``size`` is a power of two."""
    h, width = _BYTES[raw], 1
    while width < size:
        h = h[:-width] * np.uint64((0x9E3779B97F4A7C15 + 2 * width) % 2**64) + h[width:]
        h = h ^ (h >> np.uint64(29))
        width *= 2
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x, done = np.minimum(x[:-done], x[done:]), 2 * done
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchored(raw: bytes, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The regions of a text: first and last window start, place and hash of the anchor."""
    first, last, place, name = [], [], [], []
    for at in range(0, len(raw) - p.window + 1, p.chunk):
        own = np.frombuffer(raw, np.uint8, min(p.chunk + p.window - 1, len(raw) - at), at)
        h = _grams(own, p.gram)
        # Hash above, place below: the leftmost of equal strings wins in every copy.
        places = np.arange(len(h), dtype=np.uint64)
        least = _least((h & ~np.uint64(0xFFFFFF)) | places, p.window - p.gram + 1)
        best = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        ends = np.concatenate([np.flatnonzero(best[1:] != best[:-1]), [len(best) - 1]])
        starts = np.concatenate([[0], ends[:-1] + 1])
        first.append(starts + at)
        last.append(ends + at)
        place.append(best[ends] + at)
        name.append(h[best[ends]].view(np.int64))
    if not first:
        none = np.empty(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in (first, last, place, name))


def _digest(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def _text_key():
    return F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2")


REGIONS = "k1 long, k2 long, first int, last int, place int, anchor long, region long"


def regions(docs: DataFrame, p: Params) -> DataFrame:
    """A row per region of every text, written: it is read more than once."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for k1, k2, text in zip(frame["k1"], frame["k2"], frame["text"], strict=True):
                raw = text.encode()
                first, last, place, name = anchored(raw, p)
                if len(first):
                    ends = (last + p.window).tolist()
                    digests = [_digest(raw[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
                    parts.append((np.full(len(first), k1), np.full(len(first), k2), first, last, place, name, digests))
            columns = [field.split()[0] for field in REGIONS.split(", ")]
            whole = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[]] * len(columns)
            yield pd.DataFrame(dict(zip(columns, whole, strict=True)))

    long = docs.where(F.octet_length("text") >= p.window).select(*_text_key(), "text")
    return saved(long.mapInPandas(cut, REGIONS), "repeats-regions")


PIECES = "k1 long, k2 long, first int, place int, anchor long, region long, n long, many long, copies long, raw binary"


def _with_bytes(docs: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """The bytes of each wanted region, once whatever the copies of its text, by one join
    with the texts."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [field.split()[0] for field in PIECES.split(", ")]
        done = set()  # copied texts that this task has cut
        for frame in frames:
            rows = []
            for k1, k2, text, own in zip(frame["k1"], frame["k2"], frame["text"], frame["own"], strict=True):
                if own[0]["copies"] > 1:
                    if (k1, k2) in done:
                        continue
                    done.add((k1, k2))
                raw = text.encode()
                for r in own:
                    a = r["first"]
                    old = [r[c] for c in ("place", "anchor", "region", "n", "many", "copies")]
                    rows.append((k1, k2, a, *old, raw[a : r["last"] + p.window]))
            yield pd.DataFrame(rows, columns=columns)

    # At most the regions of one text.
    own = F.collect_list(F.struct("first", "last", "place", "anchor", "region", "n", "many", "copies")).alias("own")
    per_text = wanted.groupBy("k1", "k2").agg(own)
    long = docs.where(F.octet_length("text") >= p.window).select(*_text_key(), "text")
    found = long.join(per_text, ["k1", "k2"]).select("k1", "k2", "text", "own")
    pieces = saved(found.mapInPandas(cut, PIECES), "repeats-pieces")
    # Tasks may each have cut a copy of one text.
    copied = pieces.where("copies > 1").dropDuplicates(["anchor", "region"])
    once = pieces.where("copies = 1").unionByName(saved(copied, "repeats-copied"))
    return once.drop("copies")


MARKS = "k1 long, k2 long, first int, last int"


def _repeated_starts(parts: list[bytes], p: Params) -> list[np.ndarray]:
    """Per part, the places where a window starts that occurs in these parts twice."""
    # Symbol 1 ends a part; its windows are told from strings that cross the end by length.
    joined = b"".join(parts)
    sizes = np.array([len(x) for x in parts])
    text = np.frombuffer(joined, np.uint8).astype(np.int64) + 2
    s = np.append(np.insert(text, np.cumsum(sizes), 1), 0)
    sa = suffix_array(s)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    part = np.repeat(np.arange(len(parts)), sizes + 1)
    left = np.append(starts[part + 1] - 1 - np.arange(len(part)), 0)  # bytes up to the end of the part
    whole = left >= p.window
    meets = np.flatnonzero(permuted_common_prefix(s, sa, p.window, whole) >= p.window)
    order = sa[whole[sa]]
    before = np.empty(len(s), np.int64)
    before[order[1:]] = order[:-1]
    hit = np.zeros(len(s), bool)
    hit[meets] = True
    hit[before[meets]] = True
    return [np.flatnonzero(hit[a : b - 1]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) > 1)
        yield from zip(
            starts[np.concatenate([[0], cuts + 1])].tolist(),
            starts[np.concatenate([cuts, [len(starts) - 1]])].tolist(),
            strict=True,
        )


def _shard(p: Params):
    """Repeated windows of the unresolved regions of a shard."""
    columns = [field.split()[0] for field in MARKS.split(", ")]

    def over(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("anchor", kind="stable")
        sizes = frame["raw"].map(len).to_numpy()
        groups = frame["anchor"].to_numpy()
        rows, begin, held = [], 0, 0
        for i in range(len(frame)):
            held += sizes[i]
            last = i + 1 == len(frame) or groups[i + 1] != groups[i]
            if last and (held >= p.step_bytes or i + 1 == len(frame)):
                part = frame.iloc[begin : i + 1]
                begin, held = i + 1, 0
                for (k1, k2, first, n), starts in zip(
                    part[["k1", "k2", "first", "n"]].itertuples(index=False),
                    _repeated_starts(part["raw"].tolist(), p),
                    strict=True,
                ):
                    if n == 1:
                        rows += [(k1, k2, first + a, first + b) for a, b in _runs(starts)]
        return pd.DataFrame(rows, columns=columns)

    return over


def _by_suffix_arrays(pieces: DataFrame, p: Params) -> DataFrame:
    total = pieces.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    shards = 1 + int(total) // p.shard_bytes
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_shard(p), MARKS)


def _counted(rows: DataFrame, what: list[str]) -> DataFrame:
    """A row per different region under each anchor that has more than one and one that is
    not resolved: number of rows ``n``, some row's ``what``, and how ``many`` regions."""
    each = rows.groupBy("anchor", "region").agg(
        F.sum("n").alias("n"), F.any_value(F.struct(*what)).alias("some")
    )
    anchors = each.groupBy("anchor").agg(F.count("*").alias("many"), F.min("n").alias("least"))
    anchors = anchors.where("many > 1 and least = 1").drop("least")
    return each.join(anchors, "anchor").select("anchor", "region", "n", "many", "some.*")


HALVES = "k1 long, k2 long, first int, last int, place int, anchor long, region long, n long, raw binary, low int, high int"


def _halved(rows: DataFrame, p: Params) -> DataFrame:
    """Regions split by where the anchor stands in a window, each half named by the bytes
    that all its windows share. ``low`` and ``high`` bound that place under the old name."""
    columns = [field.split()[0] for field in HALVES.split(", ")]

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                start, place = r.first, r.place
                end = start + len(r.raw) - p.window  # the last window start
                middle = (r.low + r.high) // 2
                for low, high in ((r.low, middle), (middle + 1, r.high)):
                    a, b = max(start, place - high), min(end, place - low)
                    if a <= b and low <= high:
                        shared = r.raw[place - low - start : place - high + p.window - start]
                        raw = r.raw[a - start : b + p.window - start]
                        name = _digest(shared + f"{r.anchor} {low} {high}".encode())
                        out.append((r.k1, r.k2, a, b, place, name, _digest(raw), r.n, raw, low, high))
            yield pd.DataFrame(out, columns=columns)

    return saved(rows.mapInPandas(over, HALVES), "repeats-halves")


def repeated(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Runs of window starts, per text, whose windows occur twice or more."""
    all_regions = regions(docs, p)
    live = all_regions.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1").select("anchor")
    # Equal texts have equal rows; one stays with their number.
    live = all_regions.join(live, "anchor").groupBy(all_regions.columns).agg(F.count("*").alias("n"))
    live = saved(live, "repeats-live")
    marks = [_whole(live)]
    some = ["k1", "k2", "first", "last", "place", "copies"]
    wanted = saved(_counted(live.withColumn("copies", F.col("n")), some), "repeats-wanted")
    pieces = _with_bytes(docs, wanted, p)
    marks.append(_by_suffix_arrays(pieces.where(F.col("many") <= p.regions), p))
    hot = pieces.where(F.col("many") > p.regions).withColumns({"low": F.lit(0), "high": F.lit(p.window - p.gram)})
    while not hot.isEmpty():
        rows = _halved(hot, p)
        # A region seen before more than once needs no mark; under its new name it still
        # repeats others.
        marks.append(_whole(rows).where("n = 1"))
        each = _counted(rows, ["k1", "k2", "first", "last", "place", "raw", "low", "high"])
        each = saved(each, "repeats-split")
        few = (F.col("many") <= p.regions) | (F.col("low") == F.col("high"))
        marks.append(_by_suffix_arrays(each.where(few), p))
        hot = each.where(~few)
    out = marks[0].drop("n")
    for more in marks[1:]:
        out = out.unionByName(more.drop("n"))
    return out


def _whole(rows: DataFrame) -> DataFrame:
    """Regions that occur more than once under their anchor."""
    often = rows.groupBy("anchor", "region").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return rows.join(often, ["anchor", "region"]).select("k1", "k2", "first", "last", "n")


REMOVED = "n_bytes long, n_removed long, spans array<struct<first:int,past:int>>, kept_sha256 string, kept binary"


def _remove(raw: bytes, marks, window: int) -> tuple[list[tuple[int, int]], bytes]:
    """Covered spans, joined where they touch, and the bytes outside."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((m["first"], m["last"]) for m in marks):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], last + window))
        else:
            spans.append((first, last + window))
    kept, at = [], 0
    for first, past in spans:
        kept.append(raw[at:first])
        at = past
    return spans, b"".join([*kept, raw[at:]])


def remove(docs: DataFrame, p: Params = Params(), with_text: bool = False) -> DataFrame:
    """Per document: its bytes, the removed spans and the checksum of what is left; with
    ``with_text`` also the bytes that are left."""
    # At most the regions of one text.
    marks = repeated(docs, p).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("marks"))
    rows = docs.select("doc_id", "text", *_text_key())
    names = [field.split()[0] for field in REMOVED.split(", ")]

    def over(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for series, found in texts:
            out = []
            for text, own in zip(series, found, strict=True):
                raw = text.encode() if text else b""
                spans, kept = _remove(raw, [] if own is None else own, p.window)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(raw), len(raw) - len(kept), spans, digest, kept if with_text else None))
            yield pd.DataFrame(out, columns=names)

    over.__annotations__ = {"texts": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    done = F.pandas_udf(over, REMOVED)("text", "marks").alias("done")
    return rows.join(marks, ["k1", "k2"], "left").select("doc_id", done).select("doc_id", "done.*")

"""Packing of tokenized documents into sequences, with certified bin counts.

Documents become token ids with an end id; longer ones are cut into pieces of one sequence.
Pieces are dealt over partitions of bounded size and packed there best fit, longest first.
Dual-feasible functions bound from below how many sequences any packing of the same lengths
needs. A packing that meets its bound is certified. A partition above its bound repairs its
emptiest sequences. While the whole is above its bound, partitions exchange the documents of
their emptiest sequences: these are dealt anew over fewer partitions and packed again, as
long as that saves sequences.

Defined cases: a null or empty text is one piece, the end id alone; repeated rows are
separate documents; a null ``doc_id`` is passed on; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

CAPACITY = 2048
#: Most pieces, on average, that one packing task holds: lengths and keys only.
GROUP_PIECES = 250_000
MAX_EXCHANGES = 8
#: Bytes that a task's memory of ids takes in each of two generations, an entry's own cost,
#: and the cost above which an entry is not worth remembering.
REMEMBERED_BYTES, ENTRY_BYTES, LARGE_BYTES = 24 << 20, 180, 1000

#: Characters that lower-casing and composing map one to one, and how the
#: tokenizer divides them: runs of letters, single digits, runs of marks. The apostrophe is
#: left out, as it takes letters along.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
SIMPLE = re.compile(f"[{LETTERS}0-9{MARKS}]+")
SIMPLE_TEXT = re.compile(f"[{LETTERS}0-9{MARKS} \\n\\t\\r]+")
PART = re.compile(f"[{LETTERS}]+|[0-9]|[{MARKS}]+")


class Memory(dict):
    """Values by key, computed when first asked for. It takes a bounded number of bytes and
    forgets what was not asked for while it filled up twice."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.size, self.old = most, 0, {}

    def of(self, compute: Callable[[str], bytes]) -> Callable[[str], bytes]:
        """Look up a key, or compute and remember its value."""
        self.compute = compute
        return self.__getitem__

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        cost = ENTRY_BYTES + len(key) + len(value)
        if cost <= LARGE_BYTES:
            if self.size + cost > self.most:
                self.old, self.size = dict(self), 0
                self.clear()
            self[key] = value
            self.size += cost
        return value


class Encoder:
    """Token ids of texts as little-endian 32-bit integers.

    The tokenizer drops white space and never joins across it, so a text's ids are those
    of its chunks between blanks. Texts and chunks of plain characters are divided here as the
    tokenizer does, and their parts, lower-cased, go to its merges; all other chunks go through
    the whole tokenizer. Ids of parts and chunks seen before are remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The merges work on a printable form of the bytes of a character.
        shown = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c) for c in map(chr, range(0xDF, 0x100)) if c != "÷"}
        self.printable = str.maketrans({c: parts[0][0] for c, parts in shown.items()})
        self.parts, self.chunks = Memory(REMEMBERED_BYTES), Memory(REMEMBERED_BYTES)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.translate(self.printable)
        ids = [token.id for token in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self.parts.of(self._part), PART.findall(text.lower())))

    def _chunk(self, chunk: str) -> bytes:
        if SIMPLE.fullmatch(chunk) and "<|" not in chunk:
            return self._simple(chunk)
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SIMPLE_TEXT.fullmatch(text) and "<|" not in text:
            return self._simple(text)
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.chunks.of(self._chunk), filter(None, chunks)))


PIECES = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place, length and checksum; its ids on request.

    ``key`` numbers the rows of the documents, so repeated ids stay apart; the pieces are
    written, so the numbers hold for all that follows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = PIECES.replace("doc_id long", f"doc_id {kind}") + (", ids array<int>" if with_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]
    tail = np.array([end_id], "<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Of this task alone: workers serve other tasks, which need their memory for themselves.
        encoder = Encoder(path)
        for frame in frames:
            rows = []
            for key, doc, text in zip(frame["key"], frame["doc_id"], frame["text"], strict=True):
                raw = encoder.ids(text) + tail
                for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at : at + 4 * capacity]
                    row = (key, doc, i, at // 4, len(own) // 4, zlib.crc32(own))
                    rows.append((*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return saved(numbered.mapInPandas(cut, schema), "packing-pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best fit decreasing: for each length its bin and its place there; bins used.

    Open bins are kept by free space; a bit per space that some bin has free finds the
    tightest fit in one step.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = by_space[space].pop()
            if not by_space[space]:
                free ^= 1 << space
        else:
            own, space = n, capacity
            n += 1
        bins[i], offsets[i] = own, capacity - space
        left = space - size
        if left:
            by_space[left].append(own)
            free |= 1 << left
    return bins, offsets, n


#: Tries to empty a sequence after a packing above its bound, and sequences in each.
REPAIRS, REPAIR_BINS = 400, (4, 24)


def _fill(sizes: list[int], room: int) -> list[int]:
    """Places of sizes that together fill a room as far as any of them can."""
    reach, steps = 1, [1]
    keep = (1 << (room + 1)) - 1
    for size in sizes:
        reach |= (reach << size) & keep
        steps.append(reach)
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, []
    for i in range(len(steps) - 1, 0, -1):
        if not steps[i - 1] >> at & 1:
            chosen.append(i - 1)
            at -= sizes[i - 1]
    return chosen


def repair(lengths: np.ndarray, bins: np.ndarray, n: int, bound: int, capacity: int) -> tuple[np.ndarray, int]:
    """Fewer bins where best fit missed the bound: the emptiest bin and a few others are
    packed anew, each time the longest item with whatever fills its bin best."""
    rng = np.random.default_rng(n)
    members: dict[int, list[int]] = {}
    for i, b in enumerate(bins.tolist()):
        members.setdefault(b, []).append(i)
    size = lengths.tolist()
    fill = {b: sum(size[i] for i in own) for b, own in members.items()}
    open_bins = [b for b in members if fill[b] < capacity or len(members[b]) > 1]
    for _ in range(REPAIRS):
        if len(members) <= bound or len(open_bins) < 2:
            break
        few = min(len(open_bins), int(rng.integers(REPAIR_BINS[0], REPAIR_BINS[1] + 1)))
        chosen = {min(members, key=fill.get), *(open_bins[i] for i in rng.choice(len(open_bins), few, replace=False))}
        chosen &= set(members)
        items = sorted((i for b in chosen for i in members[b]), key=lambda i: -size[i])
        packed = []
        while items and len(packed) < len(chosen):
            rest = items[1:]
            taken = set(_fill([size[i] for i in rest], capacity - size[items[0]]))
            packed.append([items[0], *(i for k, i in enumerate(rest) if k in taken)])
            items = [i for k, i in enumerate(rest) if k not in taken]
        if not items and len(packed) <= len(chosen):
            names = sorted(chosen)
            for b in names:
                del members[b], fill[b]
            for b, own in zip(names, packed, strict=False):
                members[b], fill[b] = own, sum(size[i] for i in own)
            open_bins = [b for b in open_bins if b in members]
    for number, own in enumerate(members.values()):
        bins[own] = number
    return bins, len(members)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Bins, offsets, number of bins and the bound, after best fit and repairs."""
    bins, offsets, n = best_fit(lengths, capacity)
    bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    if n > bound:
        bins, n = repair(lengths, bins, n, bound, capacity)
        order = np.argsort(bins, kind="stable")
        sums = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], np.diff(bins[order]) > 0])
        offsets[order] = sums - np.repeat(sums[first], np.bincount(bins))
    return bins, offsets, n, bound


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing of ``counts[x]`` items of length x uses fewer bins.

    The largest of the bounds from two families of dual-feasible functions: one drops items
    below a threshold and rounds up those above its complement, the other rounds lengths
    to multiples of a share of the capacity. All in whole numbers.
    """
    sizes = np.arange(len(counts), dtype=np.int64)
    counts = counts.astype(np.int64)
    best = -(-int((sizes * counts).sum()) // capacity)
    n_up, mass = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]]), np.cumsum(sizes * counts)
    for low in range(1, capacity // 2 + 1):
        over = int(n_up[capacity - low + 1]) if capacity - low + 1 < len(counts) else 0
        middle = int(mass[min(capacity - low, len(counts) - 1)] - mass[low - 1])
        best = max(best, over - (-middle // capacity))
    for k in range(1, 101):
        scaled = sizes * (k + 1)
        whole = scaled % capacity == 0
        # In units of 1 / (k * capacity): the length itself, or the rounded share.
        value = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


#: Of a partition's pieces, those in its emptiest sequences that it offers for exchange.
OFFERED = 1 / 8
PLACED = "part long, bin long, offset long, offered boolean"


def _pack(rows: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Deal the pieces over ``parts`` groups by a hash and pack each group by itself."""
    columns = [c for c in rows.columns if c not in ("part", "bin", "offset", "offered", "turn")]
    schema = ", ".join(f"{n} {t}" for n, t in rows.select(*columns).dtypes) + ", " + PLACED

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "piece"], kind="stable")
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, n, _ = place(lengths, capacity)
        emptiest = np.argsort(np.bincount(bins, lengths, n), kind="stable")
        held = np.cumsum(np.bincount(bins, minlength=n)[emptiest])
        offered = np.zeros(n, bool)
        offered[emptiest[: max(2, int(np.searchsorted(held, OFFERED * len(bins))))]] = True
        return frame.assign(bin=bins, offset=offsets, offered=offered[bins])

    dealt = rows.select(*columns, F.pmod(F.xxhash64("key", "piece", F.lit(turn)), F.lit(parts)).alias("part"))
    packed = dealt.groupBy("part").applyInPandas(one, schema)
    return saved(packed.withColumn("turn", F.lit(turn)), "packing-turn")


def _used(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def certificate(rows: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound of all lengths, from their histogram: a row per length at most."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():
        counts[length] = n
    return lower_bound(counts, capacity)


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``. ``cut``: the result of pieces()."""
    # A full piece is a sequence by itself and takes part in no exchange.
    full = cut.where(F.col("length") == capacity)
    loose = cut.where(F.col("length") < capacity)
    n = loose.count()
    parts, turn = max(1, -(-n // group_pieces)), 0
    done: list[DataFrame] = []
    packed = _pack(loose, parts, turn, capacity)
    bound = certificate(loose, capacity)
    used = _used(packed)
    while used > bound and parts > 1 and turn < MAX_EXCHANGES:
        turn += 1
        # Partitions that met their own bound could still share a part-filled sequence with
        # another one, so every partition offers its emptiest ones.
        offered, closed = packed.where("offered"), packed.where("not offered")
        parts = max(1, -(-offered.count() // group_pieces))
        again, kept = _pack(offered, parts, turn, capacity), _used(closed)
        now = _used(again)
        if kept + now >= used:
            break
        done.append(closed)
        packed, used, bound = again, now, bound - kept
    done.append(packed)
    out = None
    for rows in done:
        number = F.col("turn").cast("long") * (1 << 56) + F.col("part") * (1 << 32) + F.col("bin")
        rows = rows.withColumn("sequence_id", number)
        out = rows if out is None else out.unionByName(rows)
    placed = [c for c in cut.columns if c != "key"]
    whole = full.withColumn("offset", F.lit(0).cast("long")).withColumn(
        "sequence_id", -1 - F.monotonically_increasing_id()
    )
    return whole.select(*placed, "sequence_id", "offset").unionByName(out.select(*placed, "sequence_id", "offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces packed with their ids: a sequence holds
    at most its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def production_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path or production_path(), end_id, capacity), capacity)



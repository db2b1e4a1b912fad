"""Operators over the whole corpus: similarity join, repeats, archives, scores, packing."""

import gzip
import hashlib
import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from edges import LONG, TEXTS, WORD, edge_documents, groups, shingles
from pyspark.sql import functions as F

from ledgerlens.llm import jaccard, lm, packing, repeats, warc
from ledgerlens.llm.components import components
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.suffixes import permuted_common_prefix, suffix_array

SF001 = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


# Components


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(300 + i, 301 + i) for i in range(60)] + [(500, 400 + i) for i in range(50)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    expected = {i: top(i) for i in {i for e in edges for i in e if e[0] != e[1]}}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Similarity join


def check_classes(rows, texts, k=5):
    ids = [i for i, _ in texts]
    links, tops = groups([shingles(t, k) for _, t in texts])
    members = defaultdict(list)
    for i, top in zip(ids, tops, strict=True):
        members[top].append(i)
    least = {top: min((i for i in own if i is not None), default=None) for top, own in members.items()}
    expected = Counter((i, least[top] if n else i, n) for i, top, n in zip(ids, tops, links, strict=True))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in rows) == expected


def test_similarity_join_against_all_pairs(spark):
    texts = texts_of(spark, SMALL)
    check_classes(QUERIES["op3_jaccard"](spark, SMALL).collect(), list(texts.items()))


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(300)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(3000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [7, 512])
def test_large_groups_in_blocks(spark, block):
    texts = list(enumerate([*near_copies(40, 1), *near_copies(9, 2), *near_copies(1, 2) * 5, "few words", "few words"]))
    docs = edge_documents(spark, texts)
    check_classes(jaccard.classes(docs, jaccard.Params(block=block, batch=10)).collect(), texts)


def test_similarity_join_on_edges(spark):
    docs = edge_documents(spark)
    check_classes(jaccard.classes(docs).collect(), TEXTS)
    assert jaccard.classes(docs.limit(0)).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    links, tops = groups([shingles(t) for _, t in TEXTS])
    blank = [i for i, t in TEXTS if not shingles(t)]
    least = {}
    for (i, t), top in zip(TEXTS, tops, strict=True):
        if shingles(t):
            least[top] = min(least.get(top, (True, 0)), (i is None, i or 0))
    assert ids == Counter([*blank, *(None if unknown else i for unknown, i in least.values())])
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_recall_decides_the_prefix_length(spark):
    p = jaccard.Params()
    rows = lambda *s: spark.createDataFrame([(float(x),) for x in s], "estimate double")
    first = jaccard.first_depth(p)
    assert p.shortest < first and p.chance(p.threshold, first) >= p.least > p.chance(p.threshold, first + 1)
    assert jaccard.recall(rows(1.0, 0.99, 0.3), p, first) >= p.recall
    assert jaccard.recall(rows(*[0.81] * 9), p, first) < p.recall
    assert jaccard.recall(rows(0.3), p, first) == 1.0


def at_similarity(words, rng, fresh):
    """A copy of a text of different words with some replaced far apart: 0.80 to 0.85 alike."""
    out = list(words)
    n = len(words) - 4
    changes = int(n * rng.uniform(0.16, 0.19) / 2 / 5) if n > 100 else 1
    for at in rng.sample(range(5, len(words) - 5, 10), changes):
        out[at] = next(fresh)
    return out


def test_recall_of_the_forest_against_brute_force(spark):
    # Families of one template: half of the words are common to all, so that nodes of the tries
    # are shared by texts that are not similar, and each text has copies at 0.80 to 0.85.
    rng, fresh = random.Random(4), (f"n{i}" for i in itertools.count())
    template = [f"t{i}" for i in range(240)]
    texts = []
    for _ in range(60):
        own = template[:170] + [next(fresh) for _ in range(130)]
        texts.append(own)
        texts += [at_similarity(own, rng, fresh) for _ in range(2)]
    texts = list(enumerate(" ".join(t) for t in texts))
    docs = edge_documents(spark, texts)
    p = jaccard.Params()
    sets = [shingles(t) for _, t in texts]
    wanted = {
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if 0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    }
    assert len(wanted) >= 100
    nodes = jaccard.signed(docs.select("doc_id", "text"), p)
    rows = docs.select("doc_id", *jaccard._key()).join(nodes, ["k1", "k2"]).select("doc_id", "node").collect()
    node = {r.doc_id: r.node for r in rows}
    near = jaccard.candidates(nodes, p).where(F.col("estimate") >= p.unlikely)
    comp = {r.node: r.root for r in jaccard.components(near.select("a", "b").distinct()).collect()}
    caught = [comp.get(node[i], node[i]) == comp.get(node[j], node[j]) for i, j in wanted]
    assert sum(caught) >= 0.99 * len(caught)
    check_classes(jaccard.classes(docs).collect(), texts)


# Suffix arrays and repeats


def test_suffix_arrays_against_sorting(monkeypatch):
    rng = random.Random(1)
    for trial in range(300):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5, 20])
        s = np.array([*(rng.randint(1, k) for _ in range(n)), 0])
        plain = sorted(range(n + 1), key=lambda i: s[i:].tolist())
        monkeypatch.setattr("ledgerlens.llm.suffixes.INDUCED_SYMBOLS", 10**6 if trial % 2 else 4)
        assert suffix_array(s).tolist() == plain
        shared = permuted_common_prefix(s, np.array(plain), 13)
        for a, b in itertools.pairwise(plain):
            same = next((i for i, (x, y) in enumerate(zip(s[a:], s[b:], strict=False)) if x != y), 0)
            assert shared[b] == min(same, 13)
        among = np.array([rng.random() < 0.5 for _ in range(n + 1)])
        some = permuted_common_prefix(s, np.array(plain), 13, among)
        chosen = [i for i in plain if among[i]]
        for a, b in itertools.pairwise(chosen):
            same = next((i for i, (x, y) in enumerate(zip(s[a:], s[b:], strict=False)) if x != y), 0)
            assert some[b] == min(same, 13)
        assert not some[~among].any()


def plain_repeats(texts, window):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        covered = bytearray(len(r))
        for i in range(len(r) - window + 1):
            if counts[r[i : i + window]] > 1:
                covered[i : i + window] = b"\1" * window
        kept = bytes(x for x, c in zip(r, covered, strict=True) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out.append((len(r), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found_repeats(docs, p):
    rows = repeats.remove(docs, p).select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), "kept_sha256")
    return Counter(tuple(r) for r in rows.collect())


def test_repeats_query(spark):
    texts = texts_of(spark, SMALL)
    rows = Counter(tuple(r) for r in QUERIES["op4_repeats"](spark, SMALL).collect())
    plain = plain_repeats(texts.values(), 200)
    assert rows == Counter((i, *p) for i, p in zip(texts, plain, strict=True))
    assert sum(p[1] for p in plain) > 0


@pytest.mark.parametrize("p", [
    repeats.Params(window=40, gram=8, regions=2, shard_bytes=500, step_bytes=200, chunk=100),
    repeats.Params(window=40, gram=8),
])
def test_common_passages_with_different_ends(spark, p):
    rng = random.Random(7)
    draw = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passage, other = draw(70), draw(45)
    texts = [(i, draw(rng.randrange(60)) + passage[rng.randrange(3) :] + draw(rng.randrange(60))) for i in range(30)]
    texts += [(100, other + draw(10) + other), (101, "z" * 300), (102, "ab" * 100), (103, draw(400)), (104, None)]
    texts += [(105, passage), (105, passage), (106, ""), (None, other), (107, passage[:39])]
    docs = edge_documents(spark, texts)
    plain = plain_repeats([t for _, t in texts], 40)
    assert found_repeats(docs, p) == Counter((i, *x) for (i, _), x in zip(texts, plain, strict=True))


def test_copies_of_one_text_are_cut_once(spark, monkeypatch):
    rng = random.Random(12)
    text = "".join(rng.choice("abcdefghij") for _ in range(150))
    texts = [text] * 3000 + [text[:70] + "X" + text[75:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    pieces, plain = [], repeats._by_suffix_arrays

    def counted(rows, p):
        pieces.append(rows.count())
        return plain(rows, p)

    monkeypatch.setattr(repeats, "_by_suffix_arrays", counted)
    found = found_repeats(docs, repeats.Params(window=40, gram=8))
    assert found == Counter((i, *x) for i, x in enumerate(plain_repeats(texts, 40)))
    assert 0 < sum(pieces) < 100


def test_repeats_on_edges(spark):
    docs = edge_documents(spark)
    short = [(i, t) for i, t in TEXTS if t != LONG]
    plain = plain_repeats([t for _, t in short], 200)
    found = found_repeats(edge_documents(spark, short), repeats.Params())
    assert found == Counter((i, *x) for (i, _), x in zip(short, plain, strict=True))
    long = repeats.remove(docs, with_text=True).where("doc_id = 9").first()
    assert long.n_bytes == len(LONG.encode()) and long.n_removed > 0.9 * long.n_bytes
    assert len(long.kept) == long.n_bytes - long.n_removed
    assert repeats.remove(docs.limit(0)).count() == 0


# Archives


def edge_pages(spark):
    big = "<p>é\r\n\r\n</p>" * 200
    rows = [(1, "http://a", big), (2, "http://b", big), (2, "http://b", big), (None, "http://c", big), (3, None, None)]
    rows += [(4, "http://d\r\nX: y", ""), (5, "http://e", "small"), (6, "http://f", "small"), (7, "u", "WARC/1.1\r\n\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))


def test_archives_on_edges(spark):
    rows = warc.round_trip(edge_pages(spark)).collect()
    assert len(rows) == 9
    stored = {r.page_id: r for r in rows if r.record_type == "response"}
    revisits = [r for r in rows if r.record_type == "revisit"]
    assert sorted((str(r.page_id), r.refers_to) for r in revisits) == [("1", 2), ("None", 2)]
    assert stored.keys() == {2, 3, 4, 5, 6, 7} and all(r.refers_to is None for r in stored.values())
    big = edge_pages(spark).where("page_id = 1").first().html.encode()
    for r in [*revisits, stored[2]]:
        assert (r.payload_bytes, r.payload_digest) == (len(big), hashlib.sha1(big).hexdigest())
    assert stored[3].payload_bytes == 0 and stored[3].payload_digest == hashlib.sha1(b"").hexdigest()
    assert warc.round_trip(edge_pages(spark).limit(0)).count() == 0


def test_selected_records_in_few_ranges(spark, tmp_path, monkeypatch):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    path = str(tmp_path / "archive")
    warc.write(pages, path, archive_bytes=10_000)
    index = warc.read_index(spark, path)
    assert index.select("shard").distinct().count() > 1
    chosen = index.where("page_id % 3 = 0")
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for gap, most in ((64 << 10, 4 << 20), (0, 4 << 20), (64 << 10, 2000)):
        monkeypatch.setattr(warc, "GAP_BYTES", gap)
        monkeypatch.setattr(warc, "RANGE_BYTES", most)
        rows = warc.read(spark, path, chosen, with_payload=True).collect()
        assert len(rows) == chosen.count()
        assert all(bytes(r.payload) == html[int(r.page_id)] for r in rows if r.record_type == "response")
    monkeypatch.undo()
    assert warc.byte_ranges(chosen).count() == chosen.select("shard").distinct().count() < chosen.count()
    files = sorted((tmp_path / "archive/archives").iterdir())
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert all(f.name.endswith(".warc.gz") for f in files) and raw.count(b"WARC/1.1\r\n") == pages.count()
    assert sum(f.stat().st_size for f in files) == index.agg(F.sum("length")).first()[0]


# Scores


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for bits, n in ((1, 1), (1, 2), (20, 1), (20, 1000), (44, 5000), (64, 300), (9, 512), (33, 0)):
        numbers = np.unique(rng.integers(0, 2**bits - 1, n, np.uint64, endpoint=True))
        assert (lm.unpack(lm.pack(numbers, bits)) == numbers).all()
        if n >= 300 and bits > 20:
            assert len(lm.pack(numbers, bits)) * 8 < n * (bits - math.log2(n) + 3.5) + 80
    assert (lm.unpack(lm.pack(np.arange(512, dtype=np.uint64), 9)) == np.arange(512)).all()
    counts = np.array([1, 254, 255, 256, 10**12])
    assert (lm.unpack_counts(lm.pack_counts(counts), 5) == counts).all()
    words = np.array([0, 5, 300, 2**31 - 1])
    assert (lm.unpack_words(lm.pack_words(words)) == words).all()


def test_packed_vocabulary():
    prose = [f"word{i}" for i in range(5000)] + ["é\u2028ß", "日本"]
    noise = [hashlib.sha512(str(i).encode()).hexdigest() for i in range(50)]
    for words in ([], ["a"], prose, noise):
        raw = lm.pack_vocabulary(words)
        assert (lm.unpack_vocabulary(raw) == lm._hashes(words)).all()
        assert len(raw) <= 8 * len(words) + 1
    assert len(lm.pack_vocabulary(prose)) < 4 * len(prose)


def test_scoring_a_block_is_bounded_in_memory():
    n = 1 << 19
    vocabulary = [f"word{i}" for i in range(1000)]
    words = np.random.default_rng(2).integers(0, len(vocabulary), n).astype(np.int32)
    state = ["ids", "sizes", "words", "vocabulary"]
    row = (0, 0, 0, None, list(range(n >> 9)), [512] * (n >> 9), lm.pack_words(words), lm.pack_vocabulary(vocabulary))
    frame = pd.DataFrame([row], columns=["block", "n", "part", "counts", *state])
    over = lm._scored(lm.Params(), n, lm.Split(45, 5))
    tracemalloc.start()
    try:
        assert len(over(frame)) == n >> 9
        assert tracemalloc.get_traced_memory()[1] < 110 * n
    finally:
        tracemalloc.stop()


def plain_scores(texts, order, backoff=0.4):
    docs = [WORD.findall(t or "") for t in texts]
    grams = lambda w, n: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    tables = [Counter(g for w in docs for g in grams(w, n)) for n in range(order + 1)]
    total = sum(map(len, docs))
    out = []
    for w in docs:
        own = [Counter(grams(w, n)) for n in range(order + 1)]
        rest = lambda g: tables[len(g)][g] - own[len(g)][g]
        score = 0.0
        for i in range(len(w)):
            most = min(order, i + 1)
            for n in range(most, 0, -1):
                g = tuple(w[i + 1 - n : i + 1])
                if rest(g):
                    below = rest(g[:-1]) if n > 1 else total - len(w)
                    score += math.log(rest(g) / below) + (most - n) * math.log(backoff)
                    break
            else:
                score += most * math.log(backoff) - math.log(max(1, total - len(w)))
        out.append(score)
    return out


@pytest.mark.parametrize("order, block, part", [(1, 50, 7), (2, 10**6, 10**6), (4, 100, 50)])
def test_scores_against_brute_force(spark, order, block, part):
    rng = random.Random(order)
    texts = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) for i in range(60)]
    texts += [(None, "a b c"), (70, None), (71, "new words here"), (71, "new words here")]
    p = lm.Params(order=order, block_words=block, part_grams=part)
    rows = lm.score(edge_documents(spark, texts), p).collect()
    plain = plain_scores([t for _, t in texts], order)
    found = sorted((repr(r.doc_id), round(r.log_score, 6) + 0.0) for r in rows)
    assert found == sorted((repr(i), round(s, 6) + 0.0) for (i, _), s in zip(texts, plain, strict=True))
    assert all(sum(r.n_found) == r.n_words for r in rows)


def test_scores_on_edges(spark):
    docs = edge_documents(spark)
    rows = lm.score(docs).collect()
    plain = {repr(i): s for (i, _), s in zip(TEXTS, plain_scores([t for _, t in TEXTS], 3), strict=True)}
    assert len(rows) == len(TEXTS)
    assert all(math.isclose(r.log_score, plain[repr(r.doc_id)], rel_tol=1e-9, abs_tol=1e-9) for r in rows)
    assert {r.doc_id for r in rows if r.mean_log_score is None} == {4, 5, 6}
    assert lm.score(docs.limit(0)).count() == 0


# Packing


def tokens_of(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.production_path())
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(rows, texts, capacity):
    import zlib

    expected = Counter()
    for (i, _), ids in zip(texts, tokens_of([t for _, t in texts]), strict=True):
        for k, a in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[a : a + capacity], "<u4")
            expected[i, k, a, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_query_is_certified(spark):
    rows = QUERIES["op8_packing"](spark, SMALL).collect()
    n = check_packing(rows, list(texts_of(spark, SMALL).items()), packing.CAPACITY)
    counts = np.bincount([r.length for r in rows], minlength=packing.CAPACITY + 1)
    assert n == packing.lower_bound(counts, packing.CAPACITY)


def test_exchange_saves_sequences(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cut = packing.pieces(docs, packing.production_path())
    bound = packing.certificate(cut)
    loose = cut.where(F.col("length") < packing.CAPACITY)
    alone = packing._used(packing._pack(loose, 20, 0, packing.CAPACITY))
    full = cut.count() - loose.count()
    packed = packing.pack(cut, group_pieces=60).select("sequence_id").distinct().count()
    assert bound <= packed < alone + full


def test_packing_on_edges(spark):
    docs = edge_documents(spark)
    check_packing(packing.pack_documents(docs, capacity=100).collect(), TEXTS, 100)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_sequences_hold_the_ids(spark):
    short = [(i, t) for i, t in TEXTS if t != LONG and i is not None][:8]
    cut = packing.pieces(edge_documents(spark, short), packing.production_path(), with_ids=True, capacity=64)
    rows = packing.sequences(packing.pack(cut, 64)).collect()
    ids = tokens_of([t for _, t in short])
    assert Counter(x for r in rows for x in r.ids) == Counter(x for own in ids for x in own)


def least_bins(lengths, capacity):
    """The true least number of bins, by trying all ways."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity:
                place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_least_number():
    rng = random.Random(2)
    tight = 0
    for _ in range(150):
        capacity = rng.choice([7, 10, 16])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 8))]
        counts = np.bincount(np.array(lengths, int), minlength=capacity + 1)
        bound, least = packing.lower_bound(counts, capacity), least_bins(sorted(lengths, reverse=True), capacity)
        bins, offsets, n = packing.best_fit(np.array(lengths, np.int64), capacity)
        assert bound <= least <= n
        tight += bound == least
        fill = Counter()
        for b, length in zip(bins.tolist(), lengths, strict=True):
            fill[b] += length
        assert all(v <= capacity for v in fill.values())
    assert tight > 120


def test_encoder_equals_the_tokenizer():
    rng = random.Random(2)
    pool = "aZéÀßÿ÷×µªº'\"<|>.,!0129²½ \t\n\r ́日本𝄞ŉǆİıſK’ő_-|"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|startoftext|>", "a<|endoftext|>b", "it's they'RE O'Neil 's", "ÀÉ ÿ ß Ÿ", None]
    encoder = packing.Encoder(packing.production_path())
    encoder.parts, encoder.chunks = packing.Memory(50), packing.Memory(20)
    for text, ids in zip(texts, tokens_of(texts), strict=True):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids[:-1]


@pytest.mark.parametrize("name", ["op1_quality", "op2_toxicity", "op5_secrets", "op10_decontaminate"])
def test_no_shuffle_of_texts(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Exchange hashpartitioning" not in text and "Cartesian" not in text

"""Hash trees, spelling variants, main text of pages; very long texts."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from edges import PROSE, SCHEMA, TEXTS, edge_documents
from pyspark.sql import functions as F

from ledgerlens.llm import boost, decontaminate, dom, extraction, manifest, pii, secrets, spelling
from ledgerlens.llm.queries import QUERIES

# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(top, siblings of every node) of a tree over the hashes."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            paths[i].append((run[: place % 8], run[place % 8 + 1 :]))
        nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        at = [place // 8 for place in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, plain_leaf(row)))
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    done, subroots = [], []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        subroot, paths = climb([leaf for _, leaf in own])
        subroots.append(subroot)
        done.append((own, subroot, paths))
    root, upper = climb(subroots)
    out = []
    for (own, subroot, paths), above in zip(done, upper, strict=True):
        for (row, leaf), path in zip(own, paths, strict=True):
            now = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                now = plain_leaf((*row[:4], lowered))
            steps = path + above
            proof = digest("".join("".join(left) + "".join(right) for left, right in steps))
            for left, right in steps:
                now = digest("".join(left) + now + "".join(right))
            out.append((row[0], leaf, subroot, root, proof, now, now == root))
    return out


def manifest_rows(spark, docs, tmp_path, name):
    docs.write.parquet(str(tmp_path / name / "documents.parquet"))
    return Counter(tuple(r) for r in QUERIES["op11_manifest"](spark, str(tmp_path / name)).collect())


def test_manifest_against_plain_trees(spark, tmp_path):
    rng = random.Random(3)
    langs = [None, "", "en", "en", "en", "en", "de", "ä", "z", *(f"l{i}" for i in range(70))]
    rows = []
    for i in range(1500):
        lang = rng.choice(langs[:8]) if i < 1400 else rng.choice(langs)
        text = rng.choice([None, "", "Abc Ä", f"Text {i}", "lower only"])
        rows.append((rng.choice([None, i, i, i, i // 2]), rng.choice([None, "s"]), lang, rng.choice([None, i]), text))
    rows += [(7, "s", "en", 1, "same")] * 20 + [(8, "s", "one", 1, "Alone")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.select("*", F.lit("x").alias("tree"), F.lit(1).alias("rank"), F.lit(2).alias("Hash"))
    expected = plain_manifest(rows)
    assert manifest_rows(spark, docs, tmp_path, "many") == Counter(expected)
    assert any(not r[-1] for r in expected) and all(r[-1] for r in expected if r[1] == plain_leaf((8, "s", "one", 1, "Alone")))


def test_manifest_on_edges(spark, tmp_path):
    rows = [(i, "s", None, None if t is None else len(t), t) for i, t in TEXTS]
    assert manifest_rows(spark, edge_documents(spark), tmp_path, "edges") == Counter(plain_manifest(rows))
    assert not manifest_rows(spark, spark.createDataFrame([], SCHEMA), tmp_path, "none")


def test_manifest_proofs_open_the_root(spark):
    rows = manifest.proofs(edge_documents(spark))
    folded = rows.select("root", manifest.fold(F.col("leaf"), F.col("path")).alias("folded"))
    assert all(r.root == r.folded for r in folded.collect())
    assert "Join" not in manifest._with_paths(*[spark.range(0).select(
        F.lit("").alias("tree"), F.col("id").alias("block"), F.lit(1).alias("height"), F.lit("k").alias("kids")),
        spark.range(0).select(F.lit("").alias("tree"), F.col("id").alias("block"), F.lit("p").alias("path"))], []
    )._jdf.queryExecution().executedPlan().toString()


# Spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs, p=spelling.Params()):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % p.modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= p.least_length and n >= p.least_count}
    form, many = {}, Counter()
    for a, n in counts.items():
        around = [b for b in counts if abs(len(a) - len(b)) < 2 and a != b and near(a, b)]
        many[a] = len(around)
        best = min(around, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best and counts[best] >= p.ratio * n else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return Counter((w, form[w], root(w), n, many[w], counts.get(form[w])) for w, n in counts.items())


def variants_of(docs):
    return Counter(tuple(r) for r in spelling.variants(docs).collect())


def test_variants_against_all_pairs(spark, monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(300)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "Aaaaa"]
    weights = [rng.choice([1, 3, 9, 27]) for _ in words]
    docs = [(rng.choice([None, i, i]), " ".join(rng.choices(words, weights, k=200)) + "-x1y") for i in range(40)]
    expected = plain_variants(docs)
    assert sum(r[1] is not None for r in expected) > 50
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    assert variants_of(frame) == expected
    # Buckets that hold too many words are cut down to single positions.
    monkeypatch.setattr(spelling, "BUCKET_WORDS", 3)
    assert variants_of(frame) == expected


def test_variants_on_edges(spark):
    texts = [*TEXTS, *((i, "q" * 300_000 + "b" * (i % 2)) for i in range(20, 26)), (30, "äöüäö " * 3 + "äöüäx " * 7)]
    assert variants_of(edge_documents(spark, texts)) == plain_variants(texts)
    assert not variants_of(spark.createDataFrame([], SCHEMA))


def test_positions_find_one_error_at_once():
    words = ["abcde", "abxde", "abcdef", "xabcde", "abccde", "abcd", "bacde", "abcde" * 2]
    own = [w for w in words if len(w) in (5, 6)]
    index = spelling.PositionIndex(own, 5, 0, 5)
    found = {own[i] for i in spelling._ones(index.near("abcde"))}
    assert found == {w for w in own if near("abcde", w)}


# Main text of pages


@pytest.fixture(scope="module")
def forest(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    return extraction.fit_forest([line[:400] for t in texts for line in t.split("\n")[:10]])


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    rows = np.column_stack([rng.integers(0, 2, 4000), rng.integers(0, 2, 4000), rng.normal(size=4000)]).astype(np.float32)
    labels = ((rows[:, 0] != rows[:, 1]) & (rows[:, 2] > 0.3)).astype(float)
    forest = boost.fit(rows, labels, boost.Boosting(trees=30, depth=3))
    assert ((forest.raw(rows) > 0) == (labels > 0)).mean() > 0.99
    assert boost.fit(np.zeros((0, 3), np.float32), np.zeros(0)).raw(rows).tolist() == [0.0] * 4000
    assert (boost.fit(rows, np.ones(4000)).raw(rows) > 10).all()


def test_held_out_layouts(forest):
    texts = [f"{PROSE}, {i}." for i in range(40)] + [w.capitalize() + "." for w in PROSE.split()]
    exact, wrong, blocks = 0, 0, 0
    pages = extraction.composed_pages(texts, 150, seed=77)
    for text, (_, expected) in zip(extraction.main_texts([h for h, _ in pages], forest), pages, strict=True):
        found, wanted = Counter(text.split("\n") if text else []), Counter(expected)
        exact += found == wanted
        wrong += sum(((found - wanted) + (wanted - found)).values())
        blocks += sum(wanted.values())
    assert exact >= 0.85 * len(pages) and wrong <= 0.08 * blocks


def test_a_page_with_all_its_parts(forest):
    html = f"""<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
    <header><div class=logo>Site</div></header><nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies.</p><button>Accept</button></div>
    <main><article class="post"><h1>A  title &amp; more</h1><p>{PROSE}.<p>Short&nbsp;one &lt;b&gt;.<br>And <b>bold
    <i>words</b></i>.<ul><li>first<li>second</ul><p>The end.</article>
    <section id="comments"><h2>Comments</h2><div class="comment"><p>{PROSE}!</p></div></section></main>
    <aside class="sidebar"><h3>Popular</h3><p>{PROSE}?</p></aside><div class=ad>Buy {PROSE}</div>
    <form><p>Search <input><button>Go</button></form><footer><p>&copy; 2024 Site</footer>"""
    assert extraction.main_texts([html], forest) == [
        f"A title & more\n{PROSE}.\nShort one <b>. And bold words.\nfirst\nsecond\nThe end."
    ]


def test_pages_on_edges(spark, forest):
    htmls = [None, "", " ", "<", "a < b", "<!-- x", "<p", "<script>x", "<nav><a href=x>menu</a></nav>", "</p></div>"]
    found = extraction.main_texts(htmls, forest)
    assert found[:3] == ["", "", ""] and found[5:9] == ["", "", "", ""]
    pages = spark.createDataFrame(
        [(1, "u", None, 3), (None, "v", f"<article><p>{PROSE}", 3), (2, None, "", 3), (2, None, "", 3)],
        "page_id long, url string, html string, text int",
    )
    rows = extraction.extract(pages).collect()
    assert Counter((r.page_id, r.url, r.text) for r in rows) == Counter(
        [(1, "u", ""), (None, "v", PROSE), (2, None, ""), (2, None, "")]
    )
    assert extraction.extract(pages.limit(0)).count() == 0


def test_kept_nodes_have_kept_parents(forest):
    rng = random.Random(0)
    for _ in range(30):
        page = dom.read_page("".join(rng.choice(["<div>", "</div>", "<p>", "x. ", "<li>", "<td>"]) for _ in range(80)))
        keep = extraction.kept_nodes(page, np.array([rng.uniform(-1, 1) for _ in page.parent]))
        assert all(keep[page.parent[i]] for i, k in enumerate(keep) if k)
        assert all(page.parent[i] < i < page.end[i] <= page.end[page.parent[i]] for i in range(1, len(keep)))


@pytest.mark.parametrize(
    "part", ['<a href="', "<!--", "<", "</", "<script>", "<select>", "<noscript>", "<div>", "<li>", "&amp", "<p a='"]
)
def test_broken_pages_take_time_in_proportion(part, forest):
    assert isinstance(extraction.main_texts([part * 20_000], forest)[0], str)


# Very long texts


def test_secrets_in_long_runs():
    run = base64.b64encode(random.Random(1).randbytes(200_000)).decode()
    assert secrets.find(run)[0] == [] or secrets.find(run)[1] >= 1
    members = b"".join(gzip.compress(b"password=%d-abcdefgh" % i) for i in range(2000))
    text = "x " + base64.b64encode(members).decode()
    spans, _ = secrets.find(text)
    assert {kind for _, _, kind, _ in spans} == {0}
    wrapped = base64.encodebytes(gzip.compress(b"token=abcdefghijk " * 9)).decode()
    assert {kind for _, _, kind, _ in secrets.find("cert\n" + wrapped)[0]} == {0}


def test_pseudonyms_in_long_texts(spark):
    card = "4111 1111 1111 1111"
    texts = ["a@" + "a." * 5000 + "com", *("1 " * n + card for n in (490, 498, 499, 500, 503, 1200)), "7" * 50_000, "x" * 500_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in pii.pseudonymize(rows, "k").collect()}
    assert found[0] == texts[0] and found[7] == texts[7] and found[8] == texts[8]
    for i in range(1, 7):
        assert found[i].startswith("1 " * 400) and card not in found[i] and not found[i].endswith("1111 1111 1111")


def test_short_benchmark_items_are_cut_from_longer_documents(spark):
    docs = spark.createDataFrame([(1, f"{PROSE} zebra quartz violin {PROSE}", 5)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([("a", "zebra quartz violin")], "item_id string, text string")
    (row,) = decontaminate.remove(docs, items).collect()
    assert "quartz" not in row.text and row.text.count("lighthouse") == 2 and row.n_chars == len(row.text)

"""Row-wise operators: quality rules, toxicity, secrets, pseudonyms, decontamination."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from collections import Counter
from urllib.parse import quote, quote_plus

import numpy as np
import pytest
import zstandard
from compare import differences
from conftest import SMALL
from edges import LONG, PROSE, TEXTS, WORD, edge_documents
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, pii, quality, secrets, toxicity
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.sql import ORACLES

SF01 = "/root/testdata/sf0.1"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, name):
    assert differences(spark, SMALL, name, QUERIES[name], ORACLES[name]) == []


# Quality


def plain_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_quality_on_edges(spark):
    rows = quality.ledger(edge_documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    found = Counter((r.doc_id, *r[1:6]) for r in rows)
    assert found == Counter((i, *plain_measures(t)) for i, t in TEXTS)


def test_quality_keeps_rows_and_columns(spark):
    docs = edge_documents(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(ids) == Counter([1, 2, 3, None])
    assert quality.keep_good(docs.limit(0)).count() == 0
    assert quality.ledger(docs.limit(0)).count() == 0


def test_quality_keeps_clean_documents_and_drops_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.ledger(docs).withColumn("kept", quality.passes(F.col("failed"))).join(labels, "doc_id")
    share = {r.quality: r.s for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("s")).collect()}
    assert share[0] < 0.05 and share[1] > 0.95


def test_ablation_matches_the_ledger(spark):
    rows = quality.ledger(spark.read.parquet(f"{SMALL}/documents.parquet"))
    masks = [r.failed for r in rows.collect()]
    wanted = quality.POLICIES["v1"]
    for r in quality.ablation(rows).collect():
        bit = quality.BITS[r.rule]
        assert r.n_failed == sum(bool(m & bit) for m in masks)
        assert r.n_failed_alone == sum(m & wanted == bit for m in masks)
        assert r.n_kept_without == sum(not m & wanted & ~bit for m in masks)
    assert all(r.n_failed == 0 for r in quality.ablation(rows.limit(0)).collect())


# Toxicity


def test_machine_learns_a_pair(spark):
    rng = random.Random(1)
    rows, toxic = [], []
    for _ in range(3000):
        terms, insult, group = {rng.randrange(10, 500) for _ in range(20)}, rng.random() < 0.3, rng.random() < 0.3
        terms |= ({1} if insult else set()) | ({2} if group else set())
        rows.append(np.array(sorted(terms)))
        toxic.append(float(insult and group))
    machine = toxicity.fit(rows, np.array(toxic), toxicity.Params(bits=9))
    both, one, two, none = (machine.raw(np.array(x, int)) for x in ([1, 2], [1], [2], []))
    assert machine.score(np.array([1, 2])) > 0.7 > 0.5 > max(machine.score(np.array([1])), machine.score(np.array([2])))
    assert both - one - two + none > 0.5  # what the pair adds to its terms


def pair_rows(label, n=3000, shares=(0.5, 0.5), seed=5):
    """Rows of chance words with two buckets of interest, 1 and 2."""
    rng = np.random.default_rng(seed)
    has = [(rng.random() < shares[0], rng.random() < shares[1]) for _ in range(n)]
    rows = [np.array(sorted({*rng.integers(10, 500, 40).tolist(), *([1] if a else []), *([2] if b else [])})) for a, b in has]
    return rows, np.array([float(label(a, b)) for a, b in has])


def test_toxicity_learns_pairs_of_neutral_terms():
    # Both or neither: either term alone says nothing.
    p = toxicity.Params(bits=9)
    rows, toxic = pair_rows(lambda x, y: x == y)
    assert toxicity.paired(rows, toxic, p).tolist() == [1, 2]
    machine = toxicity.fit(rows, toxic, p)
    new, toxic = pair_rows(lambda x, y: x == y, seed=6)
    right = np.mean([(machine.score(r) > 0.5) == (t > 0) for r, t in zip(new, toxic, strict=True)])
    assert right > 0.99
    assert machine.factors[1] @ machine.factors[2] > 1


def test_toxicity_gives_factors_to_a_neutral_partner():
    # The mention (2) is as frequent in clean rows: it counts beside the insult (1) only.
    # Half of the rows without the insult are toxic for no word's sake.
    p = toxicity.Params(bits=9)
    noise = np.random.default_rng(9)
    rows, toxic = pair_rows(lambda x, y: y if x else noise.random() < 0.5, shares=(0.3, 0.5))
    machine = toxicity.fit(rows, toxic, p)
    assert np.abs(machine.factors[2]).max() > 0.05
    both, alone = machine.raw(np.array([1, 2])), machine.raw(np.array([1]))
    assert both > 1 and alone < -1
    assert abs(machine.raw(np.array([2])) - machine.raw(np.array([], np.int64))) < both - alone


def test_toxicity_raw_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = toxicity.Machine(0.25, rng.normal(size=16), rng.normal(size=(16, 4)))
    for size in (0, 1, 2, 7):
        own = np.sort(rng.choice(16, size, replace=False))
        pairs = sum(machine.factors[i] @ machine.factors[j] for i in own for j in own if i < j)
        assert np.isclose(machine.raw(own), 0.25 + machine.weights[own].sum() + pairs)


def test_toxicity_finds_no_pairs_by_chance():
    rows, _ = pair_rows(lambda x, y: 0)
    toxic = (np.random.default_rng(8).random(len(rows)) < 0.2).astype(float)
    assert toxicity.paired(rows, toxic, toxicity.Params(bits=9)).size == 0


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    scored = QUERIES["op2_toxicity"](spark, SF01)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) > 0.75 * len(toxic) and sum(clean) < 0.01 * len(clean)
    held = {r.doc_id: r.held_out for r in scored.select("doc_id", "held_out").collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())
    assert docs.count() == len(held)


def test_toxicity_never_reads_held_out_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score(docs, x, held_out=held).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == two


def test_toxicity_on_edges(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (5, None), (2, 1), (99, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        rows = toxicity.score(docs, known).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), labels).count() == 0


# Secrets


def base64_of(text):
    return base64.b64encode(text.encode()).decode()


SECRET = "token = abcdef123456"


@pytest.mark.parametrize(
    "hidden",
    [
        SECRET.replace("=", "%3D"),
        "%74oken%20%3D%20abcdef123456",
        "%2574oken = abcdef123456",
        r"\u0074oken = abcdef123456",
        r"\x74oken \u{3d} abcdef123456",
        base64_of("my " + SECRET),
        base64_of(base64_of("my " + SECRET)),
        base64_of("%74oken = abcdef123456"),
        base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        base64.urlsafe_b64encode(zlib.compress((SECRET + "?>" * 9).encode())).decode(),
        base64.b64encode(zstandard.compress(gzip.compress(SECRET.encode()))).decode(),
    ],
)
def test_secrets_in_layers(hidden):
    before = "Some words. "
    spans, layers = secrets.find(before + hidden + " and more")
    assert layers > 1
    assert any(k == 0 and len(before) <= a < b <= len(before + hidden) for a, b, k, _ in spans)
    plain, _ = secrets.find(before + "nothing here, 100% sure of C:\\users and more words than that")
    assert plain == []


@pytest.mark.parametrize(
    "raw",
    [
        ("\ufeff" + SECRET).encode(),
        ("a\u00a0b\f\u200b\x00\x1b " + SECRET).encode(),
        b"\xff\xfe " + SECRET.encode(),
        gzip.compress(b"first of two members") + gzip.compress(SECRET.encode()),
        zstandard.compress(b"first of two frames") + zstandard.compress(SECRET.encode()),
    ],
)
def test_secrets_beside_other_bytes(raw):
    spans, _ = secrets.find("Some words. " + base64.b64encode(raw).decode())
    assert [s[2] for s in spans] == [0]


NOISE = random.Random(8).randbytes(200).hex()[:300].upper()
PACKED = [pack((NOISE + " " + SECRET).encode()) for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress)]


@pytest.mark.parametrize("raw", [*PACKED, ("x" * 40 + " " + SECRET).encode()])
def test_secrets_in_usual_forms_of_layers(raw):
    plain = base64.b64encode(raw).decode()
    pem = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
    forms = [base64.encodebytes(raw).decode(), pem, pem.replace("\n", "\r\n"), "/data/" + plain, "x-" + plain, "/" + plain]
    forms.append(plain.rstrip("=") + "A" * ((1 - len(plain.rstrip("="))) % 4))
    if raw in PACKED:
        forms += [quote(raw), quote_plus(raw)]
    for form in forms:
        spans, _ = secrets.find("Some words. " + form)
        assert 0 in [s[2] for s in spans], form


def test_escapes_map_to_places():
    text = "é %73ecret: \\u0061bcdefgh1"
    spans, _ = secrets.find(text)
    assert spans == [(2, len(text), 0, 1)]


def test_layers_that_yield_themselves_end():
    twice = base64_of("x" * 30)
    assert secrets.find(" ".join([twice] * 50) + "%25" * 500)[0] == []
    nested = SECRET
    for _ in range(12):
        nested = base64_of(nested)
    assert [s[2] for s in secrets.find(nested)[0]] == [0]


def plain_base(text):
    assign = re.compile(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_secrets_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = QUERIES["op5_secrets"](spark, SF01).collect()
    assert len(rows) == len(texts)
    n = 0
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, r.spans.split(",")))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in secrets.KINDS)
        n += len(base)
    assert n > 100


def test_secrets_on_edges(spark):
    docs = edge_documents(spark)
    rows = secrets.scan(docs).collect()
    assert len(rows) == len(TEXTS) and all(not r.spans for r in rows)
    assert secrets.scan(docs.limit(0)).count() == 0


# Pseudonyms

VALUES = [
    "call +1 (974) 555-3436 or 974-555-3436 now",
    "mail bosbt.42@mail8.example.com, Bosbt.42@mail8.example.com.",
    "ip 123.190.179.76. and 256.1.1.1 v",
    "card 2669109448945250 2669 1094 4894 5250 1234567890123456",
    "on 2024-05-31, 31/05/2024 and 31.05.2024. 2024-02-30 1850-01-01 0001-01-01 9999-12-31",
    "ssn 123-45-6789",
    "iban DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 DE88370400440532013000",
    "2024-05-31",
    "x 12 3.4.5 and 1.2.3",
]


def changed(spark, texts, key="k", inverse=False):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in pii.pseudonymize(rows, key, inverse).orderBy("doc_id").collect()]


def test_pseudonyms_keep_the_format_and_come_back(spark):
    out = changed(spark, VALUES)
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
    ip = 2
    assert [shape(t) for i, t in enumerate(out) if i != ip] == [shape(t) for i, t in enumerate(VALUES) if i != ip]
    assert all(0 <= int(o) < 256 for o in re.search(r"[\d.]+\d", out[ip])[0].split("."))
    assert changed(spark, out, inverse=True) == VALUES
    assert changed(spark, VALUES, key="other") != out


HELD = [
    ("4111 1111 1111 1111 05/27", "4111 1111 1111 1111"),
    ("4111111111111111 123", "4111111111111111"),
    ("qty 2 4111111111111111", "4111111111111111"),
    ("1234 4111 1111 1111 1111", "4111 1111 1111 1111"),
    ("room 204 555-123-4567", "555-123-4567"),
    ("zip 90210 123-45-6789", "123-45-6789"),
    ("order 12345 2024-05-31", "2024-05-31"),
    ("nr 1234567890123 10.20.30.40", "10.20.30.40"),
    ("DE89370400440532013000 EUR 100", "DE89370400440532013000"),
    ("NR12 DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"),
    ("AB12 4111 1111 1111 1111", "4111 1111 1111 1111"),
]


def test_values_next_to_numbers_and_words(spark):
    texts, values = zip(*HELD, strict=True)
    alone = dict(zip(values, changed(spark, list(values)), strict=True))
    assert changed(spark, list(texts)) == [t.replace(v, alone[v]) for t, v in HELD]
    assert all(v != alone[v] for v in values)
    odd = "4111-1111 11111111"
    assert changed(spark, [odd])[0].replace(" ", "").replace("-", "") == alone["4111111111111111"]


def test_equal_values_stay_linked(spark):
    out = changed(spark, VALUES)
    a, b = re.findall(r"\(?(\d{3})\)?[ -](\d{3}-\d{4})", out[0])
    assert a == b
    compact, spaced = re.match(r"card (\d+) ([\d ]{19}) (\d+)", out[3]).groups()[:2]
    assert compact == spaced.replace(" ", "") != "2669109448945250" and out[3].endswith("1234567890123456")
    iso, slashed, dotted = re.match(r"on (\S+), (\S+) and (\S+)\. 2024-02-30", out[4]).groups()
    assert iso == "-".join(reversed(slashed.split("/"))) == "-".join(reversed(dotted.split(".")))
    assert out[7] == iso


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_are_valid(spark):
    numbers = changed(spark, [str(4000000000000000 + 7919 * i) for i in range(200)])
    moved = [(i, n) for i, n in enumerate(numbers) if n != str(4000000000000000 + 7919 * i)]
    assert 10 <= len(moved) <= 30 and all(luhn(n) for _, n in moved)
    assert len(set(numbers)) == len(numbers)
    dates = changed(spark, [f"20{y:02}-{m:02}-15" for y in range(30) for m in range(1, 13)])
    assert len(set(dates)) == 360 and all(1 <= int(d[5:7]) <= 12 and 1 <= int(d[8:]) <= 31 for d in dates)


def test_pseudonyms_stay_in_spark(spark):
    text = plan(QUERIES["op9_pii"](spark, SMALL))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_pseudonyms_on_edges(spark):
    docs = edge_documents(spark)
    out = pii.pseudonymize(docs, "k")
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    assert pii.pseudonymize(docs.limit(0), "k").count() == 0


def test_no_private_value_survives(spark):
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (
        spark.read.parquet(f"{SF01}/documents.parquet"), QUERIES["op9_pii"](spark, SF01)
    ))
    assert before.keys() == after.keys()
    pattern = re.compile(r"[\w.]+@[\w.]+\w|\+\d+ \(\d+\) \d+-\d+|(?<!\w)\d{16}(?!\w)|\d+\.\d+\.\d+\.\d+")
    valid = kept = 0
    for i, text in before.items():
        for value in pattern.findall(text):
            if re.fullmatch(r"\d{16}", value) and not luhn(value):
                kept += value in after[i]  # no card number: left alone
            else:
                valid += 1
                assert value not in after[i]
    assert valid > 400 and kept > 50


# Decontamination


def plain_hits(words, items, window):
    """Hit words and items, by comparing every window at every place."""
    hit, names = set(), set()
    for name, own in items:
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                names.add(name)
    return hit, names


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        alphabet = [bytes([97 + i]) for i in range(rng.choice([1, 2, 3, 6]))]
        window = rng.choice([2, 3, 4])
        draw = lambda n: [rng.choice(alphabet) for _ in range(rng.randint(0, n))]
        items = [(str(i), draw(9)) for i in range(rng.randint(0, 4))]
        automaton = decontaminate.build([(n, b" ".join(w).decode()) for n, w in items], window)
        words = draw(40)
        runs, names = automaton.scan(words)
        hit, expected = plain_hits(words, items, window)
        assert {i for a, b in runs for i in range(a, b)} == hit and names == expected
        assert all(b < c for (_, b), (c, _) in zip(runs, runs[1:], strict=False))


def test_benchmark_in_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = decontaminate.report(docs, bench).orderBy("doc_id").collect()
    monkeypatch.setattr(decontaminate, "item_shards", lambda b: [
        b.select(F.col("item_id").cast("string").alias("name"), "text").where(F.col("item_id") % 3 == i) for i in range(3)
    ])
    parts = decontaminate.report(docs, bench).orderBy("doc_id").collect()
    for a, b in zip(whole, parts, strict=True):
        words = lambda runs: {i for r in runs for i in range(r["first"], r["past"])}
        assert (a.doc_id, a.n_words, a["items"], words(a.runs)) == (b.doc_id, b.n_words, b["items"], words(b.runs))
        assert b.n_hit == len(words(b.runs)) == a.n_hit
    assert sum(r.n_hit for r in whole) > 0


def test_documents_meet_one_python_worker_per_task(spark, monkeypatch):
    own, words = [f"own{i}" for i in range(60)], PROSE.split()
    docs = spark.createDataFrame(
        [
            (1, " ".join([*own, *words, *own]), 7),
            (2, " ".join([*own, *words[:12], "ñandú 𝄞", "zebra quartz", *own]), None),
            (3, " ".join(own), 7),
            (4, PROSE, 7),
            (5, None, 7),
        ],
        "doc_id long, text string, n_chars int",
    )
    items = [(1, " ".join(words[:15])), (2, " ".join(words[8:])), (3, "zebra quartz"), (4, "lone")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.remove(docs, bench)
    assert plan(whole).count("ArrowEvalPython") == 1
    monkeypatch.setattr(decontaminate, "item_shards", lambda b: [
        b.select(F.col("item_id").cast("string").alias("name"), "text").where(F.col("item_id") % 2 == i) for i in range(2)
    ])
    parts = decontaminate.remove(docs, bench)
    assert plan(parts).count("ArrowEvalPython") == 1
    expected = [
        (1, " ".join(own + own), len(" ".join(own + own))),
        (2, " ".join([*own, "ñandú 𝄞", *own]), len(" ".join([*own, "ñandú 𝄞", *own]))),
        (3, " ".join(own), 7),
        (5, None, 7),
    ]
    for left in (whole, parts):
        assert left.dtypes == docs.dtypes
        assert sorted(map(tuple, left.collect())) == expected


def test_decontaminate_on_edges(spark):
    docs = edge_documents(spark)
    items = [(1, PROSE), (1, PROSE), (None, "Two words"), (2, ""), (3, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.report(docs, bench).collect()
    parsed = [("" if i is None else str(i), decontaminate.words_of(t)) for i, t in items]
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for i, t in TEXTS:
        if t != LONG:
            hit, names = plain_hits(decontaminate.words_of(t), parsed, 10)
            assert (by_id[i].n_hit, by_id[i]["items"]) == (len(hit), sorted(names))
    left = decontaminate.remove(docs, bench)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert not {1, 2, 3, 7, 8, 9} & texts.keys() and texts[4] is None and texts[5] == ""
    assert decontaminate.remove(docs.limit(0), bench).count() == 0
    assert sorted(map(repr, decontaminate.remove(docs, bench.limit(0)).collect())) == sorted(map(repr, docs.collect()))


def test_passages_are_cut_out_of_documents(spark):
    words = PROSE.split()
    own = " ".join(f"own{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, f"{own}. {PROSE.upper()}! {own}", 0), (2, own, 7), (3, f"{own} {' '.join(words[:9])}", 7)],
        "doc_id int, text string, n_chars int",
    )
    bench = spark.createDataFrame([(1, PROSE)], "item_id int, text string")
    out = {r.doc_id: r for r in decontaminate.remove(docs, bench).collect()}
    assert out[1].text == f"{own}. ! {own}" and out[1].n_chars == len(out[1].text)
    assert out[2].text == own and out[2].n_chars == 7 and out[3].n_chars == 7

"""The pipeline against a plain version of every stage, and each stage on edge cases."""

import hashlib
import re
from collections import Counter

import pytest
from conftest import SMALL
from edges import PROSE, TEXTS, WORD, edge_documents, groups, shingles
from test_llm_corpus import check_packing

import corpus_pipeline
from ledgerlens.llm import packing, pii

# Plain stages over {doc_id: text}


def plain_quality(docs):
    out = {}
    for i, text in docs.items():
        words = WORD.findall(text or "")
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        counts = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        n, chars = len(words), sum(map(len, words))
        bad = (
            n < 10,
            100 * len(repeated) > 20 * n,
            10 * sum(c in "#*$%&|<>" for c in text or "") > n,
            100 * (len(lines) - len(set(lines))) > 50 * len(lines),
            chars < 2 * n,
            chars > 15 * n,
            100 * sum(c in "0123456789" for c in text or "") > 50 * chars,
        )
        if not any(bad):
            out[i] = text
    return out


def plain_near_duplicates(docs):
    ids = sorted(docs)
    _, tops = groups([shingles(docs[i]) for i in ids])
    return {i: docs[i] for k, i in enumerate(ids) if tops[k] == k}


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_decontamination(docs, items):
    fold = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    windows = set()
    for text in items:
        own = [fold(w) for w in TOKEN.findall(text or "")]
        size = min(10, len(own))
        windows |= {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs.items():
        places = [m.span() for m in TOKEN.finditer(text)]
        words = [fold(text[a:b]) for a, b in places]
        hit = set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
        if len(hit) > 0.5 * len(words):
            continue
        runs = [k for k in sorted(hit) if k - 1 not in hit]
        parts, at = [], 0
        for first in runs:
            last = first
            while last + 1 in hit:
                last += 1
            if last + 1 - first >= 10:
                parts.append(text[at : places[first][0]])
                at = places[last][1]
        parts.append(text[at:])
        out[i] = " ".join(p.strip(" ") for p in parts) if len(parts) > 1 else text
    return out


def number(*parts):
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def feistel(a, b, sizes, key, tweak):
    for turn in range(8):
        if turn % 2 == 0:
            a = (a + number(key, tweak, turn, b) % sizes[0]) % sizes[0]
        else:
            b = (b + number(key, tweak, turn, a) % sizes[1]) % sizes[1]
    return a, b


def moved_digits(digits, key, kind):
    n, half = len(digits), len(digits) // 2
    a, b = feistel(int(digits[:half]), int(digits[half:]), (10**half, 10 ** (n - half)), key, f"{kind}{n}")
    return f"{a:0{half}}{b:0{n - half}}"


def refill(shape, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def plain_pseudonym(match, key=pii.PRODUCTION_KEY):
    value = match[0]
    kind = next(k for k, p in pii.PATTERNS.items() if re.fullmatch(p, value))
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        if luhn(digits):
            return value
        body = moved_digits(digits[:-1], key, "card")
        return refill(value, body + str(next(c for c in range(10) if luhn(f"{body}{c}") == 0)))
    if kind == "phone":
        return refill(value, digits[:-10] + moved_digits(digits[-10:], key, "phone"))
    if kind == "ip":
        o = [int(x) for x in value.split(".")]
        a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), key, "ip")
        return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"
    assert kind == "email"
    body, end = re.fullmatch(r"(.*)(\.[A-Za-z]+)", value).groups()
    half = len(body) // 2

    def shifted(text, bits):
        out = ""
        for i, c in enumerate(text):
            by = int(bits[4 * i % 64 :][:4], 16)
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if ord(first) <= ord(c) < ord(first) + size:
                    c = chr((ord(c) - ord(first) + by) % size + ord(first))
                    break
            out += c
        return out

    a, b = body[:half], body[half:]
    for turn in range(8):
        other = b if turn % 2 == 0 else a
        bits = hashlib.sha256(f"{key}|email{len(body)}|{turn}|{other}".encode()).hexdigest()
        a, b = (shifted(a, bits), b) if turn % 2 == 0 else (a, shifted(b, bits))
    return a + b + end


def plain_pseudonyms(docs):
    return {i: re.sub(pii.ANY, plain_pseudonym, t) for i, t in docs.items()}


def test_run_against_plain_stages(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = plain_near_duplicates(plain_quality(docs))
    clean = plain_pseudonyms(plain_decontamination(left, items))
    assert 0 < len(clean) < len(docs) and sum(left[i] != t for i, t in clean.items()) > 3
    rows = corpus_pipeline.run(spark, SMALL).collect()
    check_packing(rows, list(clean.items()), packing.CAPACITY)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = stage(spark, docs, SMALL)
    assert out.dtypes == docs.dtypes and 0 < out.count() <= docs.count()


@pytest.mark.parametrize("k", range(5))
def test_stages_on_edges(spark, k):
    _, stage = corpus_pipeline.STAGES[k]
    docs = edge_documents(spark)
    found = stage(spark, docs, SMALL)
    assert found.count() > 0 and (k == 4 or found.columns == docs.columns)
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_clean_documents_pass_every_filter(spark):
    words = PROSE.split()
    texts = [(i, " ".join(f"{w}{i}" for w in words)) for i in range(30)] + TEXTS[:1]
    docs = edge_documents(spark, texts)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
    assert sorted(map(repr, docs.collect())) == sorted(map(repr, edge_documents(spark, texts).collect()))


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "benchmark_decontamination", "pseudonyms", "best_fit_packing"
    ]

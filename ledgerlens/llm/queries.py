"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    decontaminate,
    extraction,
    jaccard,
    lm,
    manifest,
    packing,
    pii,
    quality,
    repeats,
    secrets,
    spelling,
    toxicity,
    warc,
)
from ledgerlens.llm.common import load


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(load(spark, sf_dir, "documents"))
    failed = F.col("failed")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes(failed, "base")).alias("base_failed"),
        quality.passes(failed).alias("kept"),
        "n_lines",
        "n_digits",
        "failed",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return toxicity.score(docs, labels, held_out=held_out)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(load(spark, sf_dir, "documents"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(load(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["layer"] == 0)

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["past"]))
        return F.array_join(F.array_distinct(parts), ",")

    return found.select(
        "doc_id",
        *map(count, secrets.KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        "n_layers",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(load(spark, sf_dir, "documents"))
    names = ["n_unseen", "n_order1", "n_order2", "n_order3"]
    return scored.select(
        "doc_id",
        "n_words",
        F.round("log_score", 6).alias("log_score"),
        F.round("mean_log_score", 6).alias("mean_log_score"),
        *(F.col("n_found")[i].alias(name) for i, name in enumerate(names)),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    changed = pii.with_pseudonyms(docs, pii.PRODUCTION_KEY, "text", "found")
    replaced = F.filter("found", lambda p: p["value"] != p["pseudonym"])
    return changed.select("doc_id", "text", F.size(replaced).cast("long").alias("n_replaced"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fields = [F.col(c) for c in manifest.FIELDS[:-1]]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(chosen, manifest.leaf_hash(*fields, lowered))
    rows = manifest.proofs(docs, also={"tampered": tampered})
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extraction.extract(load(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_quality,
        op2_toxicity,
        op3_jaccard,
        op4_repeats,
        op5_secrets,
        op6_warc,
        op7_lm,
        op8_packing,
        op9_pii,
        op10_decontaminate,
        op11_manifest,
        op12_spelling,
        op13_extraction,
    )
}

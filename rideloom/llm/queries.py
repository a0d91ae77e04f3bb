"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.llm import (
    decontaminate, idfiles, katz, minhash, packing, pii, quality, runs, secrets, substrings, toxicity, variants, warc)
from rideloom.functions.once import computed_once
from rideloom.workspace import fresh_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@register
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_windows(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=1, length=2048).drop("ids", "padded_length")


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", *quality.BASE, "base_failed", "kept", "anomaly")


@register
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.counted(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))


@register
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out("doc_id", parts=10, part=0)
    model = katz.fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return katz.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


@register
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"), least_bytes=0)


@register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    idfiles.write(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=2)
    return idfiles.read(spark, folder).drop("ids")


@register
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, threshold=0.3)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` where every text whose crc32(doc_id) is a multiple of 10 repeats its own words from some place on.

    With h = crc32 of the decimal id, n words and g = h div 10, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) div (3 + g % 8). Such a text's words are joined by one space. Null ids stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.when(h % 10 == 0, words).otherwise(F.array().cast("array<string>"))
    named = computed_once(docs.select("doc_id", "text"), {"h": h, "words": F.coalesce(chosen, F.array().cast("array<string>"))})
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    placed = computed_once(named.withColumn("n", n), {"a": F.when(F.col("n") > 0, (g % F.col("n")).cast("int"))})
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)).cast("int")
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.withColumn("p", period).select(
        "doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@register
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")), least=12)
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    return computed_once(found.drop("text"), {"best": first}).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.l") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.counted(secrets.find(docs).drop("text"))


@register
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(table(spark, sf_dir, "documents"), least_chars=6, least_n=5, times=5, damage_every=199)

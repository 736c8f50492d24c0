"""The registered queries of this folder and their SQL for the same tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasediff.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    lm_score,
    mixing,
    ngram_join,
    periodic_runs,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_alignment,
)
from phasediff.llm.store import shipped

MIX = mixing.Mix(
    weights={
        "domain": {"web": 5, "books": 3, "code": 2},
        "lang": {"en": 6, "de": 2, "fr": 3, "es": 2},
        "source": {"src0": 2},
    },
    budget_percent=60,
)


#: Queries without SQL, and the tests that hold them against a plain version, a round trip or held-out labels.
CHECKED_BY_TESTS = {
    "op2_lm_scoring": "tests/llm/test_texts.py",
    "op5_quality_classifier": "tests/llm/test_texts.py",
    "op6_license_scan": "tests/llm/test_texts.py",
    "op7_ngram_join": "tests/llm/test_texts.py",
    "op8_suffix_dedup": "tests/llm/test_texts.py",
    "op9_byte_bpe": "tests/llm/test_texts.py",
    "op10_language_id": "tests/llm/test_texts.py",
    "op11_periodic_runs": "tests/llm/test_periodic_runs.py",
    "op12_cross_tokenizer_alignment": "tests/llm/test_token_alignment.py",
    "pipeline": "tests/llm/test_filters.py",
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(documents(spark, sf_dir).select("doc_id", "text"))
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*base, "n_stop_words", "n_lines")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(documents(spark, sf_dir))


def op3_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sources(documents(spark, sf_dir), MIX).drop("row")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("row")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.quality_scores(documents(spark, sf_dir), labels)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir)).drop("spans")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def bpe_digests(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Digests of the ids of every row and of their decoded text."""
    ranks = byte_bpe.read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language(documents(spark, sf_dir))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; the words of every tenth document (by the hash of its id) repeat from some place on."""
    words = F.array_remove(F.split("text", quality_rules.SPACE + "+"), "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(w):
        n, g = F.size(w).cast("long"), F.floor(hashed / 10)
        a = g % F.nullif(n, F.lit(0))
        period = F.floor((n - a) / (3 + g % 8)) + 1
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        own = F.transform(place, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int")))
        return F.when(n > 0, F.array_join(own, " "))

    changed = F.coalesce(quality_rules.bound(words, repeated), F.col("text"))
    return docs.select("doc_id", F.when(hashed % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_periods(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    with_best = found.withColumn("_best", best)
    return with_best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = token_alignment.aligned_documents(documents(spark, sf_dir), a, b)
    digest = F.when(F.col("n_groups") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.contamination(documents(spark, sf_dir), benchmark)
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def registered() -> dict:
    own = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(own.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracles() -> dict[str, str]:
    from phasediff.llm.oracle import ORACLES

    return dict(ORACLES)

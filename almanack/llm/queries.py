"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.llm import (
    exact_dedup,
    fill_in_middle,
    language_id,
    language_model,
    license_scan,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece,
    sharding,
    spelling,
    suffix_dedup,
)
from almanack.llm.tables import fold, read, with_column


def tokenizer_path(file: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"), strict=False)
    scored, name = with_column(docs, quality_classifier.score(F.col("text"), model))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 2).alias("held_out"),
        F.col(name).alias("score"),
        (F.col(name) >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.scored(read(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, v = exact_dedup.grouped(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.col(v)[c].alias(c) for c in ("keep_id", "group_size", "kept", "text_sha256")])


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_rules.fit(docs, read(spark, sf_dir, "labels"), strict=False)
    found, name, failed, kept = quality_rules.judged(docs, field)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(
        "doc_id",
        *[F.col(name)[c].alias(c) for c in counts],
        failed.alias("base_failed"),
        kept.alias("kept"),
        F.col(name)["content_share"].alias("content_share"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found, name = with_column(docs.select("doc_id", "text"), language_id.predict(F.col("text"), language_id.fit(docs)))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id")) == 2).alias("held_out"),
        F.col(name)["lang_pred"].alias("lang_pred"),
        F.col(name)["score"].alias("score"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, v = fill_in_middle.transformed(read(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col(v)["output"], F.col(v)["form"]
    return found.select(
        "doc_id",
        F.col(v)["n"].alias("n"),
        form.alias("form"),
        F.col(v)["prefix_units"].alias("prefix_chars"),
        F.col(v)["middle_units"].alias("middle_chars"),
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(output, form).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, v = suffix_dedup.cleaned(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col(v)["n_bytes"].alias("n_bytes"),
        F.col(v)["n_removed"].alias("n_removed"),
        F.size(F.col(v)["spans"]).cast("long").alias("n_spans"),
        F.sha2(F.col(v)["kept"], 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_license_scan": op3_license_scan,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_suffix_dedup": op13_suffix_dedup,
}

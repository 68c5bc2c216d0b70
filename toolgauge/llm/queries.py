"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from toolgauge.llm import (
    alignment, bpe, exact_dedup, files, lattice, minhash, packing, quality_model, rans, resampling, rows, site_text,
    toxicity, warc, weak_rules,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies; every executor has them installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(rows.texts(documents(spark, sf_dir))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_exact(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = rows.texts(documents(spark, sf_dir))
    return packing.pack_documents(texts, tokenizer_path("byte_bpe_50k.json"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.new_folder(spark, "tokens")
    rans.write_documents(rows.texts(documents(spark, sf_dir)), tokenizer_path("word_bpe_49k.json"), folder)
    return rans.read_files(spark, folder, with_ids=False).drop("ids")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(rows.texts(documents(spark, sf_dir)), tokenizer_path("byte_bpe_50k.json"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.score(documents(spark, sf_dir), labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(documents(spark, sf_dir), labels)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = files.new_folder(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.find_near(documents(spark, sf_dir))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(rows.texts(documents(spark, sf_dir)), tokenizer_path("piece_bpe_32k.model"))


def op11_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = rows.texts(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id")
    return resampling.draw(rows.texts(documents(spark, sf_dir)), target)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(tokenizer_path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(rows.texts(documents(spark, sf_dir)), *paths)


QUERIES = {
    query.__name__: query
    for query in (
        op1_exact_dedup, op2_bpe, op3_quality_model, op4_warc, op5_packing, op6_near_dedup, op7_lattice_lm,
        op8_token_files, op9_toxicity, op10_quality_rules, op11_site_text, op12_resampling, op13_alignment,
    )
}

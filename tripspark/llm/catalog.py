"""The registered queries of this subpackage: ``opN_<name>`` per operator and
``pipeline``, with DuckDB SQL where SQL can express the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripspark.llm import (
    decontaminate,
    license_scan,
    lm_score,
    near_dedup,
    packing,
    quality_rules,
    ranked_search,
    runtime,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    token_output,
    url_filter,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runtime.scratch(spark, "token-files")
    token_output.write(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"), end_id=1)
    return token_output.read(spark, path)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(_table(spark, sf_dir, "documents")).drop("text_key")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.section_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_key")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal(_table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))[0]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.components(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_token_output": op2_token_output,
    "op3_near_dedup": op3_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_lm_score": op8_lm_score,
    "op9_url_filter": op9_url_filter,
    "op10_quality_rules": op10_quality_rules,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}


def oracle_sql() -> dict[str, str]:
    return {"op10_quality_rules": quality_rules.oracle_sql(), "op12_ranked_search": ranked_search.oracle_sql()}

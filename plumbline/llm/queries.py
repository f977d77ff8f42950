"""The queries of this subpackage: name -> function (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, decontam, fim, mil, packing, passages, perplexity, resample, sharding, simhash, substrings, toxicity, urls


def tokenizer_path() -> str:
    """The public tokenizer that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op13(spark, sf_dir, tokenizer_path())


QUERIES = {
    "op1_toxicity": toxicity.op1,
    "op2_url_filter": urls.op2,
    "op3_decontamination": decontam.op3,
    "op4_sharding": sharding.op4,
    "op5_substrings": substrings.op5,
    "op6_quality": mil.op6,
    "op7_simhash": simhash.op7,
    "op8_perplexity": perplexity.op8,
    "op9_passages": passages.op9,
    "op10_bpe": op10_bpe,
    "op11_fim": fim.op11,
    "op12_resampling": resample.op12,
    "op13_packing": op13_packing,
}
SQL = {"op2_url_filter": urls.OP2_SQL, "op3_decontamination": decontam.OP3_SQL, "op4_sharding": sharding.OP4_SQL, "op11_fim": fim.OP11_SQL}

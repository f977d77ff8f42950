"""The corpus pipeline: toxicity, near-duplicates, repeated substrings, benchmark contamination, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that its predecessor kept; all but the last
return the columns of ``docs``. Defined cases are those of the operators: null and empty texts are clean, non-toxic
documents (all of them one near-duplicate group), repeated rows count once from the second stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, decontam, simhash, substrings, toxicity
from plumbline.llm.queries import tokenizer_path
from plumbline.sources.shared import stored


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likeliest severity grade is the lowest."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    # columns get private names on the way, so that none clashes with the scores and no text travels twice
    own = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    scored = toxicity.score(docs.select(*[F.col(c).alias(x) for c, x in own.items()]), model)
    return scored.where("grade = 0").select(*[F.col(x).alias(c) for c, x in own.items()])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of documents with a smaller doc_id."""
    return substrings.shortened(docs)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty stands in a benchmark window."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of each document."""
    return bpe.digest(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", not_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", not_contaminated),
    ("bpe", tokens),
]

#: A fitted model, fingerprints and a tokenizer can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

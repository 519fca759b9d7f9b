"""The corpus pipeline: reject bad documents, drop near-duplicates and benchmark leaks, redact
secrets, and encode what is left.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and
read again as the next one's documents. All but the last return the columns of documents. The last
returns doc_id, lang, source, n_tokens and the token ids as little-endian unsigned 32-bit integers;
encoding is checked by decoding: a document whose ids do not give its text back fails the job.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.llm import bpe, decontaminate, hamming, resample, secrets
from cabrank.llm.arrow import written

TOKENIZER = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the importance sample stay."""
    return resample.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; five words, similarity 0.8."""
    return hamming.deduplicated(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced."""
    return secrets.redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    path = public_tokenizers.path(TOKENIZER)
    both = bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), path)
    intact = F.col("decoded") == F.coalesce("text", F.lit(""))
    ids = F.when(intact, F.col("ids")).otherwise(
        F.raise_error(F.concat(F.lit("ids do not decode to the text of document "), F.col("doc_id")))
    )
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return both.select("doc_id", "lang", "source", n_tokens, ids.cast("binary").alias("ids"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_redaction),
    ("bpe encoding", bpe_encoding),
]

# Signatures, resampling and encoding have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

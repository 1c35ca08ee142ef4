"""A corpus pipeline: each stage works on all documents that the stage before kept.

A document is a row. Rows whose doc_id is null, or one that other rows have too, are
judged each by its own text like all others, and keep what they have as doc_id. Null
and empty texts go in the first stage, as they have no language. Columns besides
doc_id and text, whatever their names, are carried along. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import decontaminate, langid, minhash, secret_scan, sentencepiece_codec
from linkloom.llm.shared import Workspace


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: texts without letters, null ones among them, and texts like no learned language, go."""
    return langid.recognised(docs, langid.fit(docs.where(~langid.held_out()).select("lang", "text")))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least doc_id, or one without if none has any. Texts without a word are no copies."""
    return minhash.first_of_groups(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words, and no whole shorter item, with the benchmark. Null texts have no words and stay."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars, where there is one, counted anew. Null texts stay null."""
    out = secret_scan.redact(docs, secret_scan.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left, row by row. Null texts have no ids."""
    import public_tokenizers

    return sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secret_scan", secret_stage),
    ("sentencepiece", token_stage),
]

#: Language models, signatures and token pieces are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's result is written to the shared folder and read again."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

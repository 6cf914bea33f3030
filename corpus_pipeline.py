"""A corpus pipeline over the documents table, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from orderlens.session import scratch

# Per cent of common five-word shingles from which documents are near duplicates.
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    # Results of the rules must not replace columns of the documents.
    aside = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    judged = quality_rules.judge(docs.withColumnsRenamed(aside), text=aside["text"])
    return judged.filter("kept").select(*[F.col(name).alias(c) for c, name in aside.items()])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs."""
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        now = F.when(F.col("n_cut") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", now.cast(kind))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs, percent=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no notable part of a benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and a digest of what they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    schema = "n_tokens long, ids array<int>, decoded_sha256 string"
    return bpe.encode(docs.select("doc_id", "text"), path, bpe.ids_and_digest, schema).drop("text")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

# SQL has no byte-pair encoding; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages one after another, each to the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return out
        path = f"{folder}/{number}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

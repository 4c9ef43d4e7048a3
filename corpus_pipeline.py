"""A training corpus from raw documents, stage by stage; each stage works on what the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of ``documents``, and
whatever other columns ``docs`` has. ``run`` applies them to the whole table, each result written to the shared folder and read
again. Null texts are empty; rows that repeat a ``doc_id`` are handled by each stage as its operator says; empty tables
pass through as empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.llm import decontamination, language, minhash, packing, secret_scan
from cartloom.llm.shared import columns, documents, prepared, stored
from cartloom.llm.tokenizing import vocabulary

# Least similarity of near duplicates, in per cent of the five-word shingles; op1's contract has another.
NEAR_PERCENT = 80


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the labels of ``docs``: without the documents that it rejects."""
    prepared(spark)
    model = language.learn(columns(docs, ("doc_id", "text", "lang")), F.lit(True))
    # Other columns under names that can't clash with those added; each text is sent once.
    names = ["text" if c == "text" else f"column_{i}" for i, c in enumerate(docs.columns)]
    kept = language.identify(docs.toDF(*names), model).filter("NOT rejected")
    return kept.select(*names).toDF(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each component of similarity ``NEAR_PERCENT`` and more."""
    prepared(spark)
    return minhash.deduplicated(docs, NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: without the documents that hold a copy of a test item."""
    prepared(spark)
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every document, its secrets replaced by a mark and n_chars counted anew."""
    prepared(spark)
    found = secret_scan.scan(docs)
    text = secret_scan.redacted(F.col("text"), F.col("secret_spans"))
    clean = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[clean[c].alias(c) if c in clean else F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: every piece of every document with its place in a sequence."""
    prepared(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language ID", in_known_language),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# Language models, similarity and alignment are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; what each keeps is written and read again."""
    docs = documents(prepared(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

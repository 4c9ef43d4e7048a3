"""One query for each operator, with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartloom.llm import (
    decontamination, exact_dedup, extraction, language, minhash, packing, periodic_runs, secret_scan, sharding, token_files, topk,
    toxicity, whitening,
)
from cartloom.llm.shared import columns, documents, prepared, shared_path
from cartloom.llm.tokenizing import vocabulary

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepared(spark), sf_dir)

        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


def fold(parts: int) -> Column:
    """The crc32 of a document's number as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query(minhash.NEAR_DUPLICATE_SQL)
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    found = minhash.near_duplicates(documents(spark, sf_dir), 85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(topk.TOP_K_SQL)
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector with all others."""
    vectors = topk.whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from two thirds of the labels."""
    docs = columns(documents(spark, sf_dir), ("doc_id", "text"))
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    found = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query()
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secret_scan.scan(columns(documents(spark, sf_dir), ("doc_id", "text")))
    spans = F.col("secret_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


@query()
def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of test items in all documents."""
    return decontamination.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    path = shared_path(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"), False, 2)
    return token_files.checksums(spark, path)


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.select("page_id", "url", "text", "n_chars")


@query(sharding.shard_sql())
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    sized = documents(spark, sf_dir).select("doc_id", sharding.text_bytes("text").alias("n_bytes"))
    return sharding.assign_shards(sized, "doc_id")


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold(4) == 2, F.lit(False))
    model = language.learn(columns(docs, ("doc_id", "text", "lang")), ~held_out)
    found = language.identify(columns(docs, ("doc_id", "text")), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in their 32 leading components, whitened; a deviation beyond 64 bits is NULL."""
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"))
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
        "of.whitened", "of.explained", "identity_error",
    )


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of words that repeat four times and more in all documents, with planted ones, and the texts without the repeats."""
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(documents(spark, sf_dir)))
    best = periodic_runs.greatest(F.col("runs"))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    return found.select("*", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(exact_dedup.EXACT_DEDUP_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal but for white space."""
    docs = columns(documents(spark, sf_dir), ("doc_id", "text"))
    docs = docs.withColumn("text_sha256", exact_dedup.text_sha256(F.col("text")))
    found = exact_dedup.exact_duplicates(docs, with_text=False)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")

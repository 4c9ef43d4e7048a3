"""Sharding by extendible hashing: a directory of hash-prefix bits in which only oversized buckets split.

Every row has a code of bits, first of the hash of its key, then of its position in the stored table, so that rows of one
key can be told apart. A bucket holds the rows that share a prefix. It is a shard if it is within the byte limit or holds a
single row, which cannot be split; otherwise it splits on the next bit. All of it is DataFrame functions: bytes are added up by
a prefix somewhat longer than the data ask for on average, the buckets of all shorter prefixes come from these sums, and only
what still doesn't fit goes on to longer prefixes.

Defined cases: a null text has no bytes, a null key hashes as an empty text; repeated rows and rows of one key are split by
position once the bits of the key are used up, however many they are; a row over the limit is a shard of its
own; extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.shared import stored

KEY_BITS = 60
ALL_BITS = 2 * KEY_BITS
# Sums start at prefixes with about so many buckets, 2 to this power, for each shard.
FINER_BITS = 6
LIMIT_BYTES = 64 << 20


def hash_bits(text: Column) -> Column:
    """The first 60 bits of the md5 of ``text`` as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 2), KEY_BITS, "0")


def text_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def assign_shards(rows: DataFrame, key: str, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``rows`` (with the column n_bytes) with depth, shard (its prefix), shard_bytes and shard_docs.

    The rows are stored once in the shared folder, without columns the caller has left out.
    """
    kept = rows.columns
    code = F.concat(
        hash_bits(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))),
        hash_bits(F.monotonically_increasing_id().cast("string")),
    )
    left = stored(rows.withColumn("_code", code), "shard-rows")
    total = left.agg(F.sum("n_bytes")).first()[0] or 0
    base = min(KEY_BITS, FINER_BITS + max(0, math.ceil(math.log2(max(total, 1) / limit_bytes))))
    done, above = [], -1
    for depth in sorted({base, KEY_BITS, KEY_BITS + base, ALL_BITS}):
        left = left.withColumn("_prefix", F.substring("_code", 1, depth))
        leaves = stored(directory(left, above + 1, depth, limit_bytes), "shard-directory")
        columns = [F.col(f"`{c}`") for c in kept] + [F.col(f"_leaf.{c}") for c in LEAF]
        done.append(left.join(leaves.filter("_leaf IS NOT NULL"), "_prefix").select(*columns))
        open_ = leaves.filter("_leaf IS NULL").select("_prefix")
        if open_.isEmpty():
            break
        left = left.join(open_, "_prefix", "left_semi").drop("_prefix")
        above = depth
    return reduce(DataFrame.unionByName, done)


LEAF = ("depth", "shard", "shard_bytes", "shard_docs")


def directory(rows: DataFrame, first: int, last: int, limit_bytes: int) -> DataFrame:
    """For each prefix of ``last`` bits the shortest prefix of ``first`` bits or more that is a shard, else null."""
    fine = rows.groupBy("_prefix").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    buckets = fine.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn(
        "shard", F.expr("substring(_prefix, 1, depth)")
    )
    sums = buckets.groupBy("depth", "shard").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
    fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1) | (F.col("depth") == ALL_BITS)
    found = buckets.join(sums.filter(fits), ["depth", "shard"])
    best = found.groupBy("_prefix").agg(F.min_by(F.struct(*LEAF), "depth").alias("_leaf"))
    return fine.select("_prefix").join(best, "_prefix", "left")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", limit_bytes: int = LIMIT_BYTES) -> None:
    """Write ``docs`` to ``path``, one folder for each shard, named by ``b`` and its prefix."""
    sized = docs.withColumn("n_bytes", text_bytes("text"))
    shards = assign_shards(sized, key, limit_bytes).withColumn("shard", F.concat(F.lit("b"), "shard"))
    shards.repartition("shard").write.partitionBy("shard").parquet(path)


def shard_sql(limit_bytes: int = LIMIT_BYTES) -> str:
    """The shards of ``documents`` with distinct doc_id, in SQL."""
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS code
  FROM documents),
deep AS (SELECT *, unnest(range(0, 61))::INTEGER AS depth FROM sized),
nodes AS (SELECT *, substr(code, 1, depth) AS shard FROM deep),
sums AS (SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM nodes GROUP BY ALL
         HAVING sum(n_bytes) <= {limit_bytes} OR count(*) = 1)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, depth, shard, shard_bytes, shard_docs
FROM nodes JOIN sums USING (depth, shard)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1"""

"""Token-id files: parquet with one id list per document, in ascending order of the documents.

Files hold ``doc_id``, ``part`` (number of the file's range), ``part_start`` (ids of the range before the
document), ``n_tokens`` and ``ids``. The ids are dictionary-encoded, the sorted numbers delta-encoded, row groups
and pages have set sizes and every page has its entry in the page index: a read of some columns touches no ids, and a
read of some documents only their pages.

Defined cases: a null text is empty and yields the end id alone; null ``doc_id`` sort first; repeated rows and
ties in ``doc_id`` are all written, in the order of their texts' hashes; extra columns are ignored; an empty table
gives empty files. Memory in a task is one Arrow batch plus the bounded word cache.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartloom.llm.shared import columns
from cartloom.llm.tokenizing import encoder

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES, PAGE_BYTES = 32 << 20, 256 << 10

FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_token_files(docs: DataFrame, path: str, vocabulary: str, keeps_spaces: bool, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``path`` in ascending ``doc_id`` order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        texts_to_ids = encoder(vocabulary, keeps_spaces)
        for batch in batches:
            ids = [b + end for b in texts_to_ids.encode(batch.column("text").to_pylist())]
            lengths = np.array([len(b) // 4 for b in ids], dtype=np.int64)
            ends = np.cumsum(lengths)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ids), part, dtype=np.int32)),
                    pa.array(start + ends - lengths),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            start += int(lengths.sum())

    order = (F.col("doc_id"), F.xxhash64("text"))
    ordered = columns(docs, ("doc_id", "text")).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**FORMAT).parquet(path)


def part_bases(spark: SparkSession, path: str) -> DataFrame:
    """part, base: the ids before each range of documents; one row for each file's range."""
    totals = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    return totals.select("part", before.alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files with ``start``, the ids of all documents before each one; columns not asked for aren't read."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return files.join(part_bases(spark, path), "part").withColumn("start", F.col("base") + F.col("part_start")).drop("base")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit integers, from the files."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = np.ascontiguousarray(ids.values.to_numpy(), dtype="<i4").view(np.uint8)
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            names = ["doc_id", "part", "part_start", "n_tokens"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sums, pa.int64())], names=[*names, "ids_crc32"]
            )

    # The sums are taken before the join, so that no ids are shuffled.
    summed = spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(
        crc, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"
    )
    placed = summed.join(part_bases(spark, path), "part")
    return placed.select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")

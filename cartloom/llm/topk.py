"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie in cells column by column. A query adds up its products block of dimensions by block; the products that
are still to come lie, by Cauchy and Schwarz, within the product of the remaining lengths of both vectors, so a
candidate whose best case is below the k-th best worst case is out, and the columns are compacted to those that remain.

The query set meets all rows in a grid: hash blocks of queries against hash groups of candidates, each cell of bounded
size in one task; each gives at most k rows a query, of which the last step keeps k.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do empty ones; vectors
of different dimensions never meet, nor do rows whose ``vec_id`` is null, as queries or candidates; a query never meets rows
of its own ``vec_id``; repeated query rows count once, query rows of one ``vec_id`` with different vectors are one query whose
neighbours are ranked together; repeated candidates count each; equal scores go to the smaller ``vec_id``; extra columns are ignored. Inner products
must stay within 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.llm.shared import columns, stored

# Vectors in a group of candidates and in a block of queries, on average at most.
CELL_VECTORS = 8192
LEAST_CELL_VECTORS = 512
BLOCK_DIMENSIONS = 16
SCALE = 1024


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: the usable vectors with each component x turned into floor(scale * x)."""
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = columns(vectors, ("vec_id", "embedding"))
    return rows.filter(F.coalesce(usable, F.lit(False)) & (F.size("embedding") > 0)).select(
        "vec_id", scaled.alias("v")
    )


def best_in_cell(ids: np.ndarray, v: np.ndarray, own: int, query: np.ndarray, k: int, rest: np.ndarray):
    """The k best of one query among the columns of ``v``; ``rest``: lengths from each block of dimensions on."""
    alive = np.flatnonzero(ids != own)
    partial = np.zeros(len(alive), dtype=v.dtype)
    starts = range(0, len(query), BLOCK_DIMENSIONS)
    for b, start in enumerate(starts):
        part = query[start : start + BLOCK_DIMENSIONS]
        block = v[start : start + BLOCK_DIMENSIONS]
        partial = partial + part @ (block if len(alive) == v.shape[1] else block[:, alive])
        ahead = query[start + BLOCK_DIMENSIONS :].astype(float)
        if len(ahead) and len(alive) > k:
            # The margin covers the rounding of the lengths, never a real difference.
            margin = np.sqrt(ahead @ ahead) * rest[b + 1, alive] * (1 + 1e-9) + 1
            worst = np.partition(partial - margin, len(alive) - k)[len(alive) - k]
            keep = partial + margin >= worst
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
    best = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive[best]], partial[best].astype(np.int64)


def vertical(table: pa.Table, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """ids, and the components with one row for each dimension."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks()
    return ids, np.ascontiguousarray(flat.flatten().to_numpy().reshape(-1, dimensions).T)


def search_cell(k: int):
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and candidates.num_rows:
            dimensions = len(queries.column("v")[0])
            query_ids, q = vertical(queries, dimensions)
            ids, v = vertical(candidates, dimensions)
            largest = float(np.abs(q).max()) * float(np.abs(v).max()) * dimensions
            if largest < 2**52:  # then sums of products are exact in doubles, for which matrices are fast
                q, v = q.astype(float), v.astype(float)
            blocks = range(0, dimensions, BLOCK_DIMENSIONS)
            squares = np.array([(v[b : b + BLOCK_DIMENSIONS].astype(float) ** 2).sum(axis=0) for b in blocks])
            rest = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])
            for own, query in zip(query_ids, q.T):
                near, scores = best_in_cell(ids, v, own, np.ascontiguousarray(query), k, rest)
                found += [(own, i, s) for i, s in zip(near, scores)]
        parts = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 3)]
        return pa.Table.from_arrays(parts, names=["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of each row that ``is_query`` picks with all other rows.

    ``vectors``: vec_id and v, whole numbers as ``whole_numbers`` gives them.
    """
    rows = stored(vectors.filter("vec_id IS NOT NULL").withColumn("d", F.size("v")), "vectors")
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "v"])
    n, m = rows.count(), queries.count()
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_CELL_VECTORS))
    groups, blocks = max(1, -(-n // CELL_VECTORS), spread), max(1, -(-m // CELL_VECTORS))
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    hashed = lambda count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")
    cell = ["d", "query_block", "candidate_group"]
    left = queries.withColumn("query_block", hashed(blocks)).withColumn("candidate_group", numbers(groups))
    # Repeated rows are told apart, so that no group of them meets in one cell.
    salted = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    right = rows.withColumn("candidate_group", salted).withColumn("query_block", numbers(blocks))
    best = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        search_cell(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10"""

"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

The linear grouping scheme: the large pieces are sorted by length and cut into groups of equal cardinality, each length
counts as its group's largest, the few sizes that are left are combined into configurations by a linear program
with column generation, each place of a configuration is given to an actual piece (the last one to the longest that
still fits, so that little of the rounding is lost), and what is left over and the small pieces go where they fit best.

All of that needs only the number of pieces of each length, a histogram with as many rows as a sequence
has tokens, whatever the input. The plan on the driver is made from it and says for ranges of ranks among the pieces of
one length where they go; each piece finds its place by its length and rank. Ranks come from counts by length
and hash bucket, so that no length, however common, meets in one task.

Defined cases: a null text is empty (its one id is the end id); a piece is never dropped; repeated rows are packed
each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from cartloom.llm.shared import columns, stored
from cartloom.llm.tokenizing import encoder

CAPACITY = 2048
# Pieces from this share of a sequence on are large.
LARGE_SHARE = 1 / 8
GROUPS = 64
# A copy of a configuration stands if its actual pieces leave so many tokens at most to the small ones.
SLACK = 256
# The linear program ends within this share of its least number of sequences.
TOLERANCE = 1e-3
# Pieces that a rank bucket of one length holds on average at most.
BUCKET_PIECES = 20_000


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32. Only documents of more than
    ``capacity`` ids are cut; then the first piece has what is left over by the full ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        texts_to_ids = encoder(vocabulary, True)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), texts_to_ids.encode(batch.column("text").to_pylist())
            ):
                ids += end
                n = len(ids) // 4
                start, stop, piece = 0, n % capacity or min(n, capacity), 0
                while start < n:
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return columns(docs, ("doc_id", "text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


@dataclass
class Bins:
    """So many sequences alike: the lengths of their pieces in order, and the tokens still free."""

    copies: int
    lengths: list[int]
    free: int


def group_sizes(counts: np.ndarray, least: int, groups: int) -> list[tuple[int, int]]:
    """The pieces of ``least`` tokens and more, longest first, in ``groups`` groups of equal cardinality: the length that
    a group is rounded up to, its longest, and its pieces. Groups that round to one length are one."""
    total = int(counts[least:].sum())
    each, room = -(-total // groups), 0
    sizes: dict[int, int] = {}
    size = 0
    for length in range(len(counts) - 1, least - 1, -1):
        left = int(counts[length])
        while left:
            if not room:
                size, room = length, each
            take = min(left, room)
            sizes[size] = sizes.get(size, 0) + take
            left, room = left - take, room - take
    return list(sizes.items())


def substitute(
    counts: np.ndarray, places: list[int], copies: int, least: int, slack: int, bins: list[Bins]
) -> None:
    """Give the places of a configuration, so many copies of it, to actual pieces, which leave ``counts``.

    A place gets the longest large piece left that its size holds; the last one gets the longest that the tokens left
    hold, which takes up what the others lost by rounding. Copies without a piece for each place, or that would leave more
    than ``slack`` tokens, are left out.
    """
    capacity = len(counts) - 1
    while copies:
        lengths: list[int] = []
        room = capacity
        for n, size in enumerate(places, 1):
            top = room if n == len(places) else min(size, room)
            left = counts[: top + 1].copy()
            for length in lengths:
                if length <= top:
                    left[length] -= 1
            fitting = np.flatnonzero(left[least:] > 0)
            if not len(fitting):
                return
            lengths.append(least + int(fitting[-1]))
            room -= lengths[-1]
        if room > slack:
            return
        # All copies are alike until one of the lengths runs out.
        same = min([copies] + [int(counts[x]) // lengths.count(x) for x in set(lengths)])
        np.subtract.at(counts, lengths, same)
        bins.append(Bins(same, lengths, room))
        copies -= same


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations (pieces of each size) and how many of each, by the linear program of least sequences.

    Column generation: duals of the present basis price the sizes, the best configuration under these prices is found
    by dynamic programming over the capacity and enters the basis, until none is worth more than one sequence.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    used = demand / np.diag(basis)
    for _ in range(40 * n):
        prices = np.linalg.solve(basis.T, np.ones(n))
        worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            for _ in range(capacity // size):
                better = worth[:-size] + prices[i] > worth[size:] + 1e-12
                if not better.any():
                    break
                worth[size:][better] = worth[:-size][better] + prices[i]
                last[size:][better] = i
        # By the prices scaled with the worth, no plan is shorter than this one by more than that factor.
        if worth.max() <= 1 + TOLERANCE:
            break
        column, room = np.zeros(n), int(worth.argmax())
        while last[room] >= 0:
            column[last[room]] += 1
            room -= int(sizes[last[room]])
        direction = np.linalg.solve(basis, column)
        steps = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(steps.argmin())
        step = steps[leaves]
        used = np.maximum(used - step * direction, 0)
        used[leaves] = step
        basis[:, leaves] = column
    return [(basis[:, k].astype(int), float(used[k])) for k in range(n)]


def plan_sequences(
    counts: np.ndarray, groups: int = GROUPS, large_share: float = LARGE_SHARE, slack: int = SLACK
) -> list[Bins]:
    """Sequences for ``counts[length]`` pieces of each length; the capacity is the largest index."""
    bins, rest = planned_large(counts, groups, large_share, slack)
    return best_fit(bins, rest)


def planned_large(
    counts: np.ndarray, groups: int = GROUPS, large_share: float = LARGE_SHARE, slack: int = SLACK
) -> tuple[list[Bins], np.ndarray]:
    """The sequences of large pieces by their configurations, and the counts of all other pieces."""
    capacity = len(counts) - 1
    rest = counts.astype(np.int64)
    bins: list[Bins] = []
    if rest[capacity]:
        bins.append(Bins(int(rest[capacity]), [capacity], 0))
        rest[capacity] = 0
    least = max(1, int(capacity * large_share))
    if grouped := group_sizes(rest, least, groups):
        sizes, demand = (np.array(x) for x in zip(*grouped))
        found = configurations(sizes, demand.astype(float), capacity)
        # The most frequent first, while there is most choice of pieces.
        for config, used in sorted(found, key=lambda c: -c[1]):
            substitute(rest, np.repeat(sizes, config).tolist(), int(used + 1e-6), least, slack, bins)
    return bins, rest


def best_fit(bins: list[Bins], counts: np.ndarray) -> list[Bins]:
    """Put the remaining pieces, longest first, each into the fullest sequence that has room."""
    capacity = len(counts) - 1
    free: list[list[Bins]] = [[] for _ in range(capacity + 1)]
    for b in bins:
        free[b.free].append(b)
    waiting = np.array([len(x) for x in free])

    def put(b: Bins) -> None:
        free[b.free].append(b)
        waiting[b.free] += 1

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = np.flatnonzero(waiting[length:])
            if len(room):
                at = length + int(room[0])
                b = free[at].pop()
                waiting[at] -= 1
            else:
                b = Bins(left, [], capacity)
            # The fullest sequence with room stays the fullest until it has none.
            each = b.free // length
            filled = min(b.copies, left // each)
            if filled:
                put(Bins(filled, b.lengths + [length] * each, b.free - each * length))
            rest, left = b.copies - filled, left - filled * each
            if rest and left and left < each:
                put(Bins(1, b.lengths + [length] * left, b.free - left * length))
                rest, left = rest - 1, 0
            if rest and b.lengths:
                put(Bins(rest, b.lengths, b.free))
    return [b for at in free for b in at]


def rank_runs(bins: list[Bins], capacity: int) -> dict[str, np.ndarray]:
    """For runs of ranks among the pieces of a length: the first rank, the first sequence, and the place in it."""
    met = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for b in bins:
        offset = 0
        for length in b.lengths:
            rows.append((length, int(met[length]), sequence, offset))
            met[length] += b.copies
            offset += length
        sequence += b.copies
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (with length, doc_id, piece) with sequence_id and offset. ``pieces`` should be stored: it is read
    three times."""
    histogram = pieces.groupBy("length").count().collect()  # a row for each length up to the capacity
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    runs = rank_runs(plan_sequences(counts, groups), capacity)
    buckets = max(64, -(-int(counts.sum()) // BUCKET_PIECES))
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    by_bucket = keyed.groupBy("length", "bucket").count()
    before = by_bucket.select(
        "length",
        "bucket",
        (F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")).alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = (
        keyed.withColumn("within", within)
        .join(before, ["length", "bucket"])
        .select(*pieces.columns, (F.col("before") + F.col("within")).alias("rank"))
    )
    width = int(max(counts.max(), 1)) + 1
    keys = runs["length"] * width + runs["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            found = np.searchsorted(keys, batch.column("length").to_numpy() * width + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1]
                + [
                    pa.array(runs["sequence"][found] + rank - runs["rank"][found]),
                    pa.array(runs["offset"][found]),
                ],
                names=batch.schema.names[:-1] + ["sequence_id", "offset"],
            )

    added = StructType().add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, StructType(pieces.schema.fields + added.fields))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text)."""
    return pack(stored(token_pieces(docs, vocabulary, end_id, capacity), "pieces"), capacity)

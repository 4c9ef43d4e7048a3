"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then a hash of the whole text.

Texts are equal when they are the same without the characters ``[\\x20\\x09-\\x0D]``. One scan gives every row its length and the
hash of its first ``HEAD_CHARS`` characters; equal pairs are counted, combined before they are shuffled, so that a
text of which there are many copies is one row a task. A pair held by one row alone ends there: no other text can be equal.
The second scan hashes the whole text only of rows whose pair is held twice or more, and what goes on are
hashes and numbers, never texts. The pairs are broadcast up to ``MOST_PAIRS`` (8 bytes each); beyond, almost every row has to be
hashed anyway, and all are, by the same scan without the lookup. Groups come from a grouping on the whole
hash, and only rows with one are joined to them: large groups, of which there can only be ``HOT_GROUPS``, by
broadcast, so that no task gathers the copies of one text.

Of a group the row with the most code points stays, of these the one with the smallest ``doc_id`` (null last), of rows
that agree in this too any one, exactly one. All of it is DataFrame functions.

Defined cases: a null text is an empty one, and all empty texts are equal; repeated rows are copies of each other, rows of
one ``doc_id`` with different texts are documents of their own; extra columns pass through whatever their names are; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.shared import stored

WHITE_SPACE = " \t\n\x0b\f\r"
HEAD_CHARS = 64
MOST_PAIRS = 1 << 20
# Groups with more than this part of all hashed rows are joined by broadcast.
HOT_GROUPS = 1000


def normalised(text: Column) -> Column:
    """``text`` without white space."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def exact_duplicates(
    docs: DataFrame, with_text: bool = True, most_pairs: int = MOST_PAIRS, hot_groups: int = HOT_GROUPS
) -> DataFrame:
    """``docs`` with keep_id (``doc_id`` of the row that stays), group_size and kept, one row a document.

    Without ``with_text`` the column ``text`` is left out, and no text is stored between the steps.
    """
    names = [c for c in docs.columns if with_text or c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    plain = normalised(F.col("text"))
    # A pair as one number: two pairs that share it cost a hash too many, no wrong group.
    pair = F.xxhash64(F.octet_length(plain), F.left(plain, F.lit(HEAD_CHARS)))
    pairs = docs.select(pair.alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1").select("pair")
    pairs = stored(pairs, "dedup-pairs")

    whole = F.sha2(plain.cast("binary"), 256)
    points = F.length(F.coalesce(F.col("text"), F.lit("")))
    scanned = docs.select(row.alias("row"), F.col("doc_id"), points.alias("points"), F.col("text"), pair.alias("pair"))
    if pairs.count() <= most_pairs:
        shared = F.broadcast(pairs.withColumn("shared", F.lit(True)))
        scanned = scanned.join(shared, "pair", "left").withColumn("whole", F.when(F.col("shared"), whole))
    else:
        scanned = scanned.withColumn("whole", whole)
    rows = scanned.select("row", "doc_id", "points", "whole", F.monotonically_increasing_id().alias("place"))
    rows = stored(rows, "dedup-rows")

    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "place")
    groups = rows.filter("whole IS NOT NULL").groupBy("whole").agg(F.count("*").alias("size"), F.min(order).alias("best"))
    groups = groups.filter("size > 1").select("whole", "size", F.col("best.doc_id").alias("keep"), F.col("best.place").alias("stays"))
    groups, hashed = stored(groups, "dedup-groups"), rows.filter("whole IS NOT NULL")
    # Not more than hot_groups can be that large; their rows stay where they are.
    is_hot = F.col("size") * hot_groups > hashed.count()
    hot = F.broadcast(groups.filter(is_hot))
    others = hashed.join(hot.select("whole"), "whole", "left_anti").join(groups.filter(~is_hot), "whole", "left")
    grouped = hashed.join(hot, "whole").unionByName(others)
    alone = rows.filter("whole IS NULL").withColumns(
        {"size": F.lit(None).cast("long"), "keep": F.lit(None).cast(rows.schema["doc_id"].dataType), "stays": F.lit(None).cast("long")}
    )
    both = grouped.select(*alone.columns).union(alone)
    copy = F.col("size").isNotNull()
    return both.select(
        *[F.col(f"row.`{c}`") for c in names],
        F.when(copy, F.col("keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (~copy | (F.col("place") == F.col("stays"))).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    mark = next(f"kept_{i}" for i in range(len(docs.columns) + 1) if f"kept_{i}" not in docs.columns)
    packed = docs.select(F.struct("*").alias(mark), "doc_id", "text")
    return exact_duplicates(packed, with_text=False).filter("kept").select(f"{mark}.*")


EXACT_DEDUP_SQL = """
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, COUNT(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM plain
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

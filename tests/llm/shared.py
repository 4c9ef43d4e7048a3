"""Small tables with everything an operator may meet: nulls, empty and long texts, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
WORDS = "alder birch cedar dogwood elm fir ginkgo hazel iris juniper kapok larch maple nutmeg oak pine quince rowan".split()

# Columns whose names operators use inside.
CLASHING = ("class", "keys", "n", "part", "rank", "score", "spans", "text_", "length", "shard", "depth", "comp", "row", "kinds")


def sentence(start, count, step=1):
    return " ".join(f"{WORDS[(start + i * step) % len(WORDS)]}{(start * 31 + i * 7) % 97}" for i in range(count))


def documents(spark, rows):
    """doc_id, text, lang, source, n_chars and clashing columns from (doc_id, text[, lang]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit("x") for c in CLASHING})


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)

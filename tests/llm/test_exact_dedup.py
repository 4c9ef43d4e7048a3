import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cartloom.llm import QUERIES, exact_dedup
from tests.llm.shared import SF_DIR, documents, sentence

CLASH = ("row", "pair", "points", "whole", "place", "size", "keep", "stays", "shared", "keep_id_", "a.b")


def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


def expected(data):
    """Of each (doc_id, text) row: how many rows equal it and whose id stays."""
    groups = {}
    for doc_id, text, *_ in data:
        groups.setdefault(plain(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {key: (len(rows), min(rows)[3]) for key, rows in groups.items()}


def check(spark, data, **options):
    docs = documents(spark, data).withColumns({c: F.lit("x") for c in CLASH})
    found = exact_dedup.exact_duplicates(docs, **options)
    assert found.columns == [*docs.columns, "keep_id", "group_size", "kept"]
    groups, kept, rows = expected(data), {}, found.collect()
    assert len(rows) == len(data)
    for r in rows:
        size, keep = groups[plain(r["text"])]
        assert (r["group_size"], r["keep_id"]) == (size, keep)
        if r["kept"]:
            kept.setdefault(plain(r["text"]), []).append(r["doc_id"])
    assert kept == {key: [keep] for key, (_, keep) in groups.items()}
    assert {r["a.b"] for r in rows} <= {"x"}
    return rows


DATA = [
    (5, "one two"), (3, "one  two"), (9, "onetwo"), (4, "one\t\ttwo"), (8, "one two three"),
    (1, None), (2, ""), (7, " \n\x0b\f\r"), (None, " "), (10, "  "),
    (20, "same head " * 20 + "a"), (21, "same head " * 20 + "b"), (22, "same head " * 20 + "a "),
    (30, "again"), (30, "again"), (30, "again"), (30, "another text"), (None, "lost id"), (None, "lost id"), (40, "lost id"),
    (50, sentence(1, 200_000)), (51, sentence(1, 200_000) + "\n"), (52, "É́"), (53, "É́"), (54, "x\x1cy"), (55, "xy"),
]


@pytest.mark.parametrize("most_pairs, hot_groups", [(exact_dedup.MOST_PAIRS, 1), (0, 5), (0, exact_dedup.HOT_GROUPS)])
def test_against_brute_force(spark, most_pairs, hot_groups):
    check(spark, DATA, most_pairs=most_pairs, hot_groups=hot_groups)


def test_random_texts_and_a_hot_one(spark):
    rng = random.Random(3)
    data = [(i, "".join(rng.choice("ab \n") for _ in range(rng.randrange(8)))) for i in range(600)]
    data += [(1000 + i, "hot text" + " " * (i % 7)) for i in range(400)]
    check(spark, data)


def test_empty_table(spark):
    assert check(spark, []) == []
    assert exact_dedup.deduplicated(documents(spark, [])).count() == 0


def test_deduplicated_keeps_columns_and_rows(spark):
    docs = documents(spark, DATA).withColumns({c: F.lit("x") for c in (*CLASH, "kept", "keep_id", "kept_0")})
    found = exact_dedup.deduplicated(docs)
    assert found.columns == docs.columns
    texts = [plain(r["text"]) for r in found.collect()]
    assert sorted(texts) == sorted({plain(t) for _, t in DATA})


def test_digest_is_of_the_normalised_text(spark):
    rows = QUERIES["op13_exact_dedup"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {r["doc_id"]: r["text_sha256"] for r in rows} == {
        d: hashlib.sha256(plain(t).encode()).hexdigest() for d, t in texts.items()
    }


def test_plan_is_native_and_shuffles_no_text(spark):
    found = exact_dedup.exact_duplicates(documents(spark, DATA), with_text=False)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "text#" not in plan.split("== Physical Plan ==")[1]

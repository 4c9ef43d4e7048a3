import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cartloom.llm import sharding
from cartloom.llm.shared import prepared, shared_path
from tests.llm.shared import SF_DIR, documents


def assigned(docs, limit):
    sized = docs.withColumn("n_bytes", sharding.text_bytes("text")).drop("shard", "depth")
    return [r.asDict() for r in sharding.assign_shards(sized, "doc_id", limit).collect()]


@pytest.mark.parametrize("limit", [1, 2_000, 30_000, 200_000])
def test_against_sql_at_small_limits(spark, limit):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    expected = connection.execute(sharding.shard_sql(limit)).df().sort_values("doc_id").to_dict("records")
    docs = prepared(spark).read.parquet(f"{SF_DIR}/documents.parquet")
    names = list(expected[0])
    found = sorted(({n: r[n] for n in names} for r in assigned(docs, limit)), key=lambda r: r["doc_id"])
    assert found == expected


def check(found, limit):
    shards = {}
    for r in found:
        shards.setdefault((r["depth"], r["shard"]), []).append(r)
    for (depth, shard), rows in shards.items():
        assert len(shard) == depth
        assert sum(r["n_bytes"] for r in rows) == rows[0]["shard_bytes"]
        assert len(rows) == rows[0]["shard_docs"]
        assert rows[0]["shard_bytes"] <= limit or len(rows) == 1
    names = [s for _, s in shards]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    return shards


def test_hot_key_nulls_and_oversized_rows(spark):
    """A third of the rows under one key are split by position; a row over the limit is alone."""
    data = [(i, "x" * 50) for i in range(200)] + [(7, "y" * 60)] * 100 + [(None, "z" * 40)] * 20
    data += [(900, None), (901, ""), (902, "w" * 5000)]
    found = assigned(documents(prepared(spark), data), 400)
    assert len(found) == len(data)
    shards = check(found, 400)
    assert any(len(rows) == 1 and rows[0]["n_bytes"] == 5000 for rows in shards.values())
    assert max(r["depth"] for r in found if r["doc_id"] == 7) > sharding.KEY_BITS


def test_empty_table(spark):
    assert assigned(documents(prepared(spark), []), 100) == []


def test_written_shards(spark):
    docs = documents(prepared(spark), [(i, "x" * 100) for i in range(50)]).select("doc_id", "text")
    path = shared_path(spark, "shards")
    sharding.write_shards(docs, path, limit_bytes=1000)
    back = spark.read.parquet(path)
    assert back.count() == 50
    sizes = back.groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()
    assert len(sizes) >= 5 and all(r["b"] <= 1000 for r in sizes)
    assert os.path.isdir(path.removeprefix("file:"))

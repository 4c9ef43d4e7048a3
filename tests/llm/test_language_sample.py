import numpy as np
from pyspark.sql import functions as F

from cartloom.llm import language
from cartloom.llm.shared import prepared
from tests.llm.shared import documents
from tests.llm.test_language import TEXTS, learning_rows


def test_a_rare_language_is_learned_beside_a_large_one(spark):
    """Two French rows among 12,000 English ones, all of them copies of one text."""
    prepared(spark)
    last = spark.range(20_000, 40_000).orderBy(F.xxhash64("id", F.lit(7)).desc()).limit(2)  # no smallest hash of all
    data = [(i, TEXTS["en"], "en") for i in range(12_000)] + [(r["id"], TEXTS["fr"], "fr") for r in last.collect()]
    docs = documents(spark, data).drop("score")
    model = language.learn(docs, F.lit(True))
    assert model.languages == ["en", "fr"]
    assert language.sampled(docs, F.lit(True)).groupBy("lang").count().collect().__len__() == 2
    found = language.identify(docs.filter("doc_id >= 20000").select("doc_id", "text"), model).collect()
    assert all(r["lang_pred"] == "fr" and not r["rejected"] for r in found)


def test_sample_is_bounded_with_repeated_rows(spark, monkeypatch):
    prepared(spark)
    monkeypatch.setattr(language, "LANGUAGE_ROWS", 7)
    data = [(None if i % 2 else 5, f"text {i % 3}", "en") for i in range(90)] + [(i, "text", "de") for i in range(20)]
    counts = language.sampled(documents(spark, data), F.lit(True)).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in counts} == {"en": 7, "de": 7}


def test_learning_in_tasks_equals_learning_on_the_driver(spark):
    prepared(spark)
    docs = documents(spark, [(i, t, lang) for i, t, lang in learning_rows()]).drop("score")
    model = language.learn(docs.repartition(5), F.lit(True))
    rows = language.sampled(docs, F.lit(True)).orderBy("lang", "at").collect()
    local = language.fit([(r["text"], r["lang"]) for r in rows])
    assert model.languages == local.languages and (model.owner == local.owner).all()
    assert np.allclose(model.idf, local.idf) and np.allclose(model.centroids, local.centroids, atol=1e-5)
    assert np.allclose(model.least, local.least, atol=1e-5)

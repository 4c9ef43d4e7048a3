from pyspark.sql import functions as F

from cartloom.llm import language
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR, documents

TEXTS = {
    "en": "the people of this town walk through the streets and they think that nothing will ever change here",
    "de": "die menschen dieser stadt gehen durch die straßen und sie glauben dass sich hier niemals etwas ändert",
    "fr": "les gens de cette ville marchent dans les rues et ils pensent que rien ne changera jamais ici",
}


def learning_rows():
    rows = []
    for lang, text in TEXTS.items():
        words = text.split()
        rows += [(len(rows) + i, " ".join(words[i % 9 :] + words[: i % 7]), lang) for i in range(30)]
    return rows


def identified(spark, data, learned=None):
    model = language.fit([(t, lang) for _, t, lang in learned if lang and t]) if learned is not None else None
    frame = documents(prepared(spark), data).drop("score")
    model = model or language.learn(frame, F.lit(True))
    return {r["doc_id"]: r for r in language.identify(frame.select("doc_id", "text"), model).collect()}


def test_predictions_and_rejection(spark):
    data = [
        (1, "people think that this is the town"), (2, "die menschen gehen durch diese stadt"), (3, "LES GENS DE CETTE VILLE!"),
        (4, None), (5, ""), (6, " 123 !? _ "), (7, "сегодня хорошая погода в городе и мы идём гулять"), (8, "the " * 200_000),
    ]
    found = identified(spark, data, learning_rows())
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 8)] == ["en", "de", "fr", "en"]
    assert not any(found[i]["rejected"] for i in (1, 2, 3))
    for i in (4, 5, 6):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    assert found[7]["rejected"] and found[7]["lang_pred"] in TEXTS
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_learning_leaves_out_what_it_must(spark):
    rows = learning_rows() + [(1000, "zzz qqq xxx", None), (1001, None, "xx"), (1001, None, "xx")]
    frame = documents(prepared(spark), rows).drop("score")
    model = language.learn(frame, F.col("lang") != "fr")
    assert model.languages == ["de", "en"]
    assert model.similarities([language.gram_places("the people")]).shape == (1, 2)


def test_no_labels_and_empty_tables(spark):
    found = identified(spark, [(1, "some text"), (2, None)])
    assert {(r["lang_pred"], r["rejected"]) for r in found.values()} == {("und", True)}
    assert identified(spark, []) == {}


def test_held_out_accuracy(spark):
    docs = prepared(spark).read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.learn(docs, ~held_out)
    found = language.identify(docs.filter(held_out).select("doc_id", "text", "lang"), model)
    n, right, rejected = found.agg(
        F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int"))
    ).first()
    assert right >= 0.97 * n and rejected <= 0.01 * n

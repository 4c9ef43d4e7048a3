import pytest
from pyspark.sql import functions as F

from cartloom.llm import language
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR


def labelled(spark):
    docs = prepared(spark).read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    docs = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    return [tuple(r) for r in docs.select("text", "lang", held_out).orderBy("doc_id").collect()]


@pytest.mark.parametrize("left_out", ["es", "de", "fr"])
def test_a_language_of_the_same_script_that_was_not_learned_is_rejected(spark, left_out):
    rows = labelled(spark)
    model = language.fit([(t, lang) for t, lang, _ in rows if lang != left_out])
    foreign = [t for t, lang, _ in rows if lang == left_out and len(language.gram_places(t)) > 512]
    assert len(foreign) > 50
    _, _, rejected = model.predict(foreign)
    assert rejected.mean() >= 0.9


def test_short_clean_texts_are_kept(spark):
    rows = labelled(spark)
    model = language.fit([(t, lang) for t, lang, held_out in rows if not held_out])
    words = [t.split() for t, _, held_out in rows if held_out]
    short = [" ".join(w[at : at + n]) for w in words for at in (0, len(w) // 2) for n in (2, 4, 8, 15, 30)]
    short = [t for t in short if len(language.gram_places(t)) > 4]
    _, _, rejected = model.predict(short)
    assert len(short) > 1000 and rejected.mean() <= 0.01

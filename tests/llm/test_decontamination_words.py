import pytest

from cartloom.llm import decontamination as d
from cartloom.llm.shared import prepared
from tests.llm.shared import documents, sentence
from tests.llm.test_decontamination import benchmark


@pytest.mark.parametrize("a, b", [
    ("a b", "a b"), ("word—word", "word-word"), ("don’t", "don't"), ("“so”…", '"so"...'),
    ("a　b，c", "a b,c"), ("﻿a​b", "a b"), ("«ça va»", "ça va"), ("A İx", "a İx"),
])
def test_unicode_spaces_and_punctuation_part_words(a, b):
    assert d.hashes_of(a).tolist() == d.hashes_of(b).tolist()
    assert len(d.word_spans(a)) == len(d.hashes_of(a))


def test_letters_and_marks_of_all_scripts_stay_in_words():
    texts = ("straße", "été", "été", "हिन्दी", "сло", "日本", "x²")
    assert [len(d.hashes_of(t)) for t in texts] == [1] * len(texts)


def test_copies_in_other_typography(spark):
    item = sentence(3, 24)
    words = item.split()
    data = [(1, item.replace(" ", " ")), (2, "—".join(words)), (3, " ".join(f"“{w}”…" for w in words))]
    data = [(i, f"vorher – {t} – nachher") for i, t in data]
    docs = documents(prepared(spark), data + [(4, "clean — text")])
    found = {r["doc_id"]: r for r in d.find(docs, benchmark(spark, [(7, item)])).collect()}
    assert {i: r["score"] for i, r in found.items()} == {1: 1.0, 2: 1.0, 3: 1.0}
    for i, text in data:
        passage = found[i]["passage"]
        assert text[found[i]["start"] : found[i]["end"]] == passage
        assert passage.startswith(words[0]) and passage.endswith(words[-1])
    assert [r["doc_id"] for r in d.decontaminated(docs, benchmark(spark, [(7, item)])).collect()] == [4]

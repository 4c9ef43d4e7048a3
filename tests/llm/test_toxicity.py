import random
import time

import pytest
from pyspark.sql import functions as F

from cartloom.llm import toxicity
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR, documents, sentence


def labels(spark, rows):
    return spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, toxic int, text string")


def rate(text, name, marked=frozenset()):
    return toxicity.rates(text, marked)[toxicity.FEATURES.index(name)]


def test_features():
    assert rate("You are an idiot", "insult_rate") == 0.25
    assert rate("You are an idiot", "personal_rate") == 0.25
    assert rate("the idiot " + "far away " * 10 + "you", "personal_rate") == 0
    for text in ("an 1d10t", "$tupid", "s t u p i d", "stuuupid", "m0ron"):
        assert toxicity.disguised_insults(text), text
    assert toxicity.disguised_insults("nice day 123 4.5 a1 b2 u2 idiot!") == []
    assert rate("QUITE LOUD HERE", "shouted") == 1
    assert rate("inflected gadzookery", "marked", frozenset(["gadz*"])) > 0
    assert set(toxicity.rates(None, frozenset())) == set(toxicity.rates("", frozenset())) == {0.0}


def test_learned_scores(spark):
    data = [(i, sentence(i, 30) + (" stupid loser" if i % 4 == 0 else "")) for i in range(400)]
    data += [(1000, None), (1001, ""), (1002, "idiot " * 50_000), (3, "repeated id")]
    known = [(i, int(i % 4 == 0)) for i in range(0, 400)] + [(5, None), (8, 1), (9999, 1)]
    found = toxicity.score(documents(prepared(spark), data), labels(spark, known), F.col("doc_id") < 300)
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert sum(map(len, got.values())) == len(data) and all(0 <= s <= 1 for v in got.values() for s in v)
    assert all((got[i][0] >= 0.7) == (i % 4 == 0) for i in range(300, 400))
    assert got[1000] == got[1001] and got[1000][0] < 0.7


def test_one_label_no_labels_and_empty_tables(spark):
    docs = documents(prepared(spark), [(1, "a"), (2, "b"), (3, None)])
    always = F.lit(True)
    assert {r["score"] for r in toxicity.score(docs, labels(spark, [(1, 0), (2, 0)]), always).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(docs, labels(spark, []), always).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), labels(spark, [(1, 1)]), always).count() == 0


def test_held_out_accuracy(spark):
    folder = SF_DIR.replace("0.001", "0.1")
    docs, known = (prepared(spark).read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = toxicity.score(docs, known, ~held_out).join(known.filter(held_out), "doc_id")
    right = ((F.col("score") >= 0.7).cast("int") == F.col("toxic")).cast("int")
    accuracy = {r["toxic"]: r["a"] for r in found.groupBy("toxic").agg(F.avg(right).alias("a")).collect()}
    assert accuracy[0] >= 0.99 and accuracy[1] >= 0.8


def slow_rates(text):
    """The counts behind the rates, token by token."""
    words = toxicity.WORD.findall(text.lower())
    insults = [i for i, w in enumerate(words) if w in toxicity.LEXICON]
    persons = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    n, n_chars = max(len(words), 1), max(len(text), 1)
    letters = max(sum(c.isalpha() for c in text.lower()), 1)
    return {
        "insult_rate": len(insults) / n,
        "insult_kinds": len({words[i] for i in insults}),
        "personal_rate": sum(any(abs(i - p) <= toxicity.NEAR for p in persons) for i in insults) / n,
        "second_person_rate": len(persons) / n,
        "capitals": sum(c.isupper() for c in text) / letters,
        "shouted": sum(w.isupper() and len(w) > 2 for w in text.split()) / n,
        "exclamations": text.count("!") / n_chars,
        "questions": text.count("?") / n_chars,
        "signs": sum(not c.isalnum() and not c.isspace() for c in text) / n_chars,
        "digits": sum(c.isdigit() for c in text) / n_chars,
    }


def test_rates_against_token_by_token():
    rng = random.Random(8)
    vocabulary = ["idiot", "You", "your", "SCUM", "moron!", "tree", "Oak", "1d10t", "what?", "x9", "naïve", "--", "LOUD", "pig"]
    for _ in range(200):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))
        for name, expected in slow_rates(text).items():
            assert abs(rate(text, name) - expected) < 1e-12, (name, text)


@pytest.mark.parametrize("insult", ["idiot", "stupid", "rat", "motherfucker"])
def test_disguises_of_any_length(insult):
    long = insult.replace("t", "t" * 70, 1)
    for text in (long, f"x_{insult.replace('t', '7')}_y", " ".join(insult), ".".join(insult), insult.replace("t", "7" * 90)):
        assert insult in toxicity.disguised_insults(f"so {text} end"), text
    assert insult in toxicity.disguised_insults(insult[0] + insult[1:].replace("i", "1").replace("a", "@").replace("o", "0"))
    for text in (insult, f"{insult}!", f"{insult}!!!", f"a {insult}* b"):
        assert toxicity.disguised_insults(text) == [], text


def test_disguises_take_linear_time():
    begin = time.process_time()
    for text in ("abc" * 400_000, "aaabbb" * 200_000, "a1" * 500_000, "a b " * 250_000, "1" * 1_000_000, "_a_1" * 250_000):
        toxicity.disguised_insults(text)
    assert time.process_time() - begin < 20


def test_texts_that_differ_are_learned_from_each(spark):
    """Copies, however many, count once; texts that share some words do not."""
    own = lambda i: " ".join("".join("abcdefghij"[int(c)] for c in str(10**5 + 20 * i + k)) for k in range(12))
    one = [(1, f"shared {own(i)} gadzook") for i in range(40)]
    copies = [(1, "the same text again with zounds") for _ in range(60)]
    other = [(0, f"shared {own(1000 + i)} plain") for i in range(200)]
    frame = prepared(spark).createDataFrame(one + copies + other, "toxic int, text string")
    marked = toxicity.marking_words(frame)
    assert "gadzook" in marked and "zounds" not in marked and "shared" not in marked


def test_texts_are_not_shuffled_for_the_sample(spark):
    docs, known = documents(prepared(spark), [(1, "a")]), labels(spark, [(1, 1)])
    plan = toxicity.sample(docs, known, F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

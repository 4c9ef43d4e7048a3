import time

import numpy as np

from cartloom.llm import decontamination as d
from cartloom.llm.shared import prepared
from tests.llm.shared import documents
from tests.llm.test_decontamination import benchmark

PHRASE = "which of the following"


def templates(count, words=20):
    """Items that begin alike and go on with words of a vocabulary that they share."""
    rng = np.random.default_rng(7)
    return [f"{PHRASE} " + " ".join(f"w{x}" for x in rng.integers(0, 5000, words)) for _ in range(count)]


def everything(words, items):
    """The best copy of each item by aligning it with the whole text."""
    found = {}
    for i, target in enumerate(items.words):
        score, a, b = d.align(target, words)
        if b:
            found[i] = (score, a, b)
    return found


def text_with(rng, items, copies, phrases):
    parts = [f"w{x}" for x in rng.integers(0, 5000, 600)]
    for _ in range(phrases):
        parts.insert(int(rng.integers(0, len(parts))), PHRASE)
    for i in copies:
        words = items[i].split()
        for at in rng.integers(0, len(words), 4):
            words[at] = f"changed{at}"
        parts.insert(int(rng.integers(0, len(parts))), " ".join(words))
    return " ".join(parts)


def test_a_phrase_of_all_items_against_aligning_everything():
    rng = np.random.default_rng(3)
    texts = templates(300) + [f"{PHRASE} is the w1", f"{PHRASE} w1 is w2 the w3 of w4"] * 2
    items = d.Items.of(list(enumerate(texts)))
    held = 0
    for k in range(12):
        words = d.hashes_of(text_with(rng, texts, rng.integers(0, 300, k % 4), k))
        got = {i: (s, a, b) for i, s, a, b in d.copies_in(words, items)}
        seeded = {int(i) for i in items.item[np.isin(items.gram, d.grams(words))]}
        expected = {i: v for i, v in everything(words, items).items() if i in seeded}
        assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in expected.items()}
        for i, (score, a, b) in got.items():
            assert d.align(items.words[i], words[a:b])[0] == score
        assert d.holds_copy(words, items) == bool(got)
        held += len(got)
    assert held > 20


def test_twenty_thousand_items_of_one_phrase():
    """A phrase of all items costs milliseconds, however often a text has it (12 seconds by a window for each item)."""
    rng = np.random.default_rng(5)
    texts = templates(20_000)
    items = d.Items.of(list(enumerate(texts)))
    words = [d.hashes_of(text_with(rng, texts, [77] if k == 3 else [], 5)) for k in range(4)]
    d.copies_in(words[0], items)
    begin = time.process_time()
    found = [d.copies_in(w, items) for w in words]
    assert time.process_time() - begin < 4
    assert [len(f) for f in found[:3]] == [0, 0, 0] and 77 in {f[0] for f in found[3]}


def test_long_texts_full_of_the_phrase():
    texts = templates(2_000)
    items = d.Items.of(list(enumerate(texts)))
    words = d.hashes_of(" ".join([f"{PHRASE} u{i} v{i}" for i in range(500)] + [texts[5]]))
    begin = time.process_time()
    assert 5 in {f[0] for f in d.copies_in(words, items)}
    assert d.holds_copy(words, items)
    assert time.process_time() - begin < 20


def test_scores_at_once_equal_one_by_one():
    rng = np.random.default_rng(2)
    own = [rng.integers(0, 6, rng.integers(1, 15)).astype(np.uint64) for _ in range(80)]
    other = [rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(80)]
    scores, ends = d.best_scores(own, other)
    for a, b, score, end in zip(own, other, scores, ends):
        expected, _, stop = d.align(a, b)
        assert score == round(expected * d.MATCH * len(a))
        assert not stop or stop == end


def test_blocks_and_rows_kept_with_a_shared_phrase(spark, monkeypatch):
    texts = templates(60)
    data = [(i, f"x{i} {texts[i]} y{i}" if i % 3 == 0 else f"x{i} {PHRASE} y{i}") for i in range(60)]
    docs = documents(prepared(spark), data)
    items = benchmark(spark, list(enumerate(texts)))
    monkeypatch.setattr(d, "BLOCK_ITEMS", 25)
    assert {r["doc_id"] for r in d.find(docs, items).collect()} == set(range(0, 60, 3))
    assert {r["doc_id"] for r in d.decontaminated(docs, items).collect()} == {i for i in range(60) if i % 3}

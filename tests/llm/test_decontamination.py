import random

import numpy as np

from cartloom.llm import decontamination as d
from cartloom.llm.shared import prepared
from tests.llm.shared import documents, rows, sentence


def slow_align(a, b):
    """Score of the best local alignment, cell by cell."""
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = d.MATCH if a[i - 1] == b[j - 1] else d.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + same, table[i - 1, j] + d.GAP, table[i, j - 1] + d.GAP)
    return table.max() / (d.MATCH * len(a))


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def edited(rng, text, share):
    words = [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in text.split()]
    return " ".join(words)


def test_against_aligning_every_document_with_every_item(spark):
    rng = random.Random(4)
    items = [(i, sentence(i * 5, 30 + i)) for i in range(8)] + [(90, None), (91, ""), (92, "one two"), (93, sentence(0, 30))]
    data = [(i, f"{sentence(i + 40, 80, 5)} a{i}") for i in range(20)]
    for i in range(24):
        copy = edited(rng, items[i % 8][1], (i // 8) * 0.12)
        data.append((100 + i, f"{sentence(i, 25, 7)} {copy.upper() if i % 2 else copy} {sentence(i, 400 if i == 3 else 25, 11)}"))
    data += [(200, None), (201, ""), (202, "one two"), (203, items[0][1][: len(items[0][1]) // 4])]
    found = d.find(documents(prepared(spark), data), benchmark(spark, items))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()}
    expected = {}
    for doc_id, text in data:
        words = d.hashes_of(text)
        for item_id, item in items:
            target = d.hashes_of(item)
            if len(target) >= d.SEED_WORDS and len(words):
                score = slow_align(target, words)
                if score >= d.LEAST_SCORE:
                    expected[doc_id, item_id] = score
    assert got == expected
    assert len(expected) >= 24


def test_passages_and_rows_kept(spark):
    item = sentence(3, 20)
    data = [(1, f"Vorher ẞ, {item.upper()}. Danach"), (2, "clean text of its own"), (None, item), (2, item), (4, None)]
    docs = documents(prepared(spark), data)
    found = {r["doc_id"]: r for r in d.find(docs, benchmark(spark, [(7, item)])).collect()}
    assert found[1]["passage"].lower() == item and found[1]["score"] == 1.0
    assert data[0][1][found[1]["start"] : found[1]["end"]] == found[1]["passage"]
    kept = d.decontaminated(docs, benchmark(spark, [(7, item)]))
    assert kept.columns == docs.columns
    assert rows(kept.select("doc_id", "text")) == sorted([(2, data[1][1]), (4, None)], key=repr)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, sentence(i * 5, 25)) for i in range(6)]
    docs = documents(prepared(spark), [(i, t) for i, t in items])
    whole = rows(d.find(docs, benchmark(spark, items)))
    monkeypatch.setattr(d, "BLOCK_ITEMS", 2)
    assert rows(d.find(docs, benchmark(spark, items))) == whole


def test_frequent_seeds_do_not_hide_a_copy(spark):
    """A passage in most documents still seeds itself: rarity is by rank within an item."""
    item = sentence(3, 20)
    docs = documents(prepared(spark), [(i, f"u{i} {item} v{i}") for i in range(50)])
    assert d.find(docs, benchmark(spark, [(1, item)])).count() == 50


def test_empty_tables(spark):
    prepared(spark)
    assert d.find(documents(spark, []), benchmark(spark, [(1, "a b c d")])).count() == 0
    assert d.decontaminated(documents(spark, [(1, "a b c d")]), benchmark(spark, [])).count() == 1


def test_alignment_against_cell_by_cell():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        score, start, end = d.align(a, b)
        assert score == slow_align(a, b)
        if score >= d.LEAST_SCORE:
            assert slow_align(a, b[start:end]) == score

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cartloom.llm import QUERIES, periodic_runs
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR, documents, sentence


def brute_force(words):
    """(start, length, period) of all runs of at least two periods, by trying every period."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        same = [words[i] == words[i + p] for i in range(n - p)] + [False]
        start = 0
        for i, s in enumerate(same):
            if not s:
                if i - start >= p and (start, i - start + p) not in found:
                    found[start, i - start + p] = p
                start = i + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def plain_runs(text):
    words = (text or "").encode().split()
    runs = sorted((r for r in brute_force(words) if r[1] >= max(6, 4 * r[2])), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return runs, b" ".join(w for i, w in enumerate(words) if i not in dropped)


def repeating(rng, alphabet, most_words, parts):
    words = []
    for _ in range(parts):
        words += [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        root = [rng.choice(alphabet) for _ in range(rng.randrange(1, 6))]
        words += [root[i % len(root)] for i in range(rng.randrange(1, most_words))]
    return words


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(1500):
        words = [rng.randrange(1, rng.randrange(2, 5)) for _ in range(rng.randrange(1, 45))]
        assert [tuple(r) for r in periodic_runs.runs_in(words, max(words)).tolist()] == brute_force(words)


def test_texts_with_runs_between_other_words():
    rng = random.Random(2)
    for _ in range(1500):
        text = " \n".join(repeating(rng, "abc", 40, rng.randrange(1, 4)))
        runs, collapsed = periodic_runs.text_runs(text.encode())
        assert ([tuple(r) for r in runs.tolist()], collapsed) == plain_runs(text)


def test_common_extensions():
    rng = np.random.default_rng(3)
    numbers = rng.integers(1, 3, 200).tolist()
    tree = periodic_runs.SuffixTree(numbers, 2)
    pairs = rng.integers(0, 201, (2000, 2))
    a, b = pairs[pairs[:, 0] != pairs[:, 1]].T
    text = [*numbers, 0]

    def common(i, j):
        k = 0
        while max(i, j) + k < 200 and text[i + k] == text[j + k]:
            k += 1
        return k

    assert tree.common(a, b).tolist() == [common(i, j) for i, j in zip(a.tolist(), b.tolist())]
    suffixes = sorted(range(201), key=lambda i: text[i:])
    assert np.argsort(tree.rank).tolist() == suffixes
    turned = [0 if c == 0 else 3 - c for c in text]
    assert np.argsort(tree.reversed_rank()).tolist() == sorted(range(201), key=lambda i: turned[i:])


def test_stretches_hold_every_run():
    rng = random.Random(4)
    for _ in range(500):
        words = repeating(rng, "ab", 60, 3)
        numbers = np.array([ord(w) for w in words], dtype=np.uint64)
        found = periodic_runs.stretches(numbers)
        for s, length, _ in plain_runs(" ".join(words))[0]:
            assert any(a <= s and s + length <= b for a, b in found)


DATA = [
    (1, "x " + "a b c " * 5 + "a y"), (2, "a a a a a a"), (3, "a a a a a"), (4, None), (5, ""), (6, " \t\n\x0b\f\r"), (None, "b " * 9),
    (7, "a b " * 4), (7, "a b " * 4), (8, "a b a b a b a"), (9, "a b a b " * 4), (10, "é é " * 6),
    (11, sentence(1, 3000)), (12, "one two\tthree\n" * 4 + "four " * 7), (13, "a a a a a a b " * 5),
]


def test_operator_on_odd_rows(spark):
    found = periodic_runs.periodic_runs(documents(prepared(spark), DATA)).collect()
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"].encode()) for r in found), key=repr)
    assert got == sorted(((d, *plain_runs(t)) for d, t in DATA), key=repr)
    assert periodic_runs.periodic_runs(documents(spark, [])).count() == 0


def test_greatest_run(spark):
    run = lambda *r: dict(zip(("start", "length", "period"), r))
    cases = [[run(0, 9, 2), run(3, 14, 3), run(9, 28, 6)], [run(2, 8, 2), run(2, 12, 3)], []]
    frame = spark.createDataFrame([(c,) for c in cases], f"runs array<{periodic_runs.RUN}>")
    found = frame.select(periodic_runs.greatest(frame["runs"]).alias("r")).collect()
    assert [tuple(r["r"]) if r["r"] else None for r in found] == [(3, 14, 3), (2, 8, 2), None]


@pytest.mark.parametrize(
    "words, runs",
    [
        (["a"] * 50_000, [(0, 50_000, 1)]),
        ([f"w{i % 7000}" for i in range(49_000)], [(0, 49_000, 7000)]),
        ([f"w{i % 20_000}" for i in range(49_000)], []),
    ],
)
def test_long_texts(words, runs):
    start = time.perf_counter()
    found, _ = periodic_runs.text_runs(" ".join(words).encode())
    assert [tuple(r) for r in found.tolist()] == runs
    assert time.perf_counter() - start < 30


def altered(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected_row(doc_id, text):
    runs, collapsed = plain_runs(b" ".join(altered(doc_id, text)).decode())
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def test_planted_runs_on_odd_rows(spark):
    data = [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(300)] + [(None, "a b"), (3, None), (11, " ")]
    found = periodic_runs.with_planted_runs(documents(prepared(spark), data)).collect()
    got = sorted(((r["doc_id"], (r["text"] or "").encode().split()) for r in found), key=repr)
    assert got == sorted(((d, altered(d, t)) for d, t in data), key=repr)


def test_query_against_brute_force(spark):
    found = QUERIES["op12_periodic_runs"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for n, t in found.dtypes if n not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == sorted(expected_row(r["doc_id"], r["text"]) for r in texts)
    assert sum(r[1] > 0 for r in rows) > 5

"""Encoding, token files and packing."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartloom.llm import packing, token_files
from cartloom.llm.shared import prepared, shared_path
from cartloom.llm.tokenizing import TextEncoder, vocabulary
from tests.llm.shared import documents, rows, sentence

BYTES, LOWER = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD_TEXTS = [
    "", " ", "  ", "   ", "a  b", "a   b", "a \n b", "a\n \nb", "x \n", "x\n ", "tab\tword \t x", " lead", "end ", "end  ",
    "don't  'll we're", "foo<|endoftext|>bar <|endoftext|>", "ΣΑΣ ΟΔΟΣ, x", "İstanbul. Ünïcödé!!! é ok", "1234 56,7.",
    "日本語 テキスト。", "x\x1c \x1cy", "a .. b... ,,", "a.b. c.\nd,\n\ne! f?g", "x.\ny\n", "(a). b", "\x01 a", "“q”. r", "a. ",
    "ŉ. x", "aª. x", "é. x", "क़ x", "  a", "a b  c",
]


@pytest.mark.parametrize("path, keeps_spaces", [(BYTES, True), (LOWER, False)])
def test_pieces_give_the_ids_of_the_whole_text(path, keeps_spaces):
    whole, pieces = Tokenizer.from_file(path), TextEncoder(path, keeps_spaces)
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "ß", " ", " ", "\n", ".", ",", "'s", "1", "\t", "-", "Ñ", "ſ"]
    texts = ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(3000)]
    for text, ids in zip(texts, pieces.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    assert pieces.encode([None]) == [b""]


def expected_ids(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark):
    prepared(spark)
    data = [(9, "Nine words."), (2, None), (5, ""), (-1, sentence(1, 5000)), (7, "a b c"), (7, "c b a")]
    path = shared_path(spark, "test-tokens")
    token_files.write_token_files(documents(spark, data), path, LOWER, False, 2)
    ids = {(d, t): expected_ids(LOWER, t, 2) for d, t in data}
    found = [tuple(r) for r in token_files.checksums(spark, path).orderBy("start").collect()]
    assert [r[0] for r in found] == sorted(d for d, _ in data)
    start = 0
    for doc_id, at, n, checksum in found:
        assert at == start
        assert (n, checksum) in [(len(i), crc(i)) for (d, _), i in ids.items() if d == doc_id]
        start += n
    read = token_files.read_token_files(spark, path)
    assert {(r["doc_id"], tuple(r["ids"])) for r in read.collect()} == {(d, tuple(i)) for (d, _), i in ids.items()}
    # Metadata alone reads no ids.
    plan = read.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "doc_id" in x)
    assert "ids" not in scan.split("ReadSchema")[-1]


def test_token_files_of_an_empty_table(spark):
    path = shared_path(prepared(spark), "test-tokens")
    token_files.write_token_files(documents(spark, []), path, LOWER, False, 2)
    assert token_files.checksums(spark, path).count() == 0


def check_packing(found, data, capacity):
    by_doc, by_sequence = {}, {}
    for doc_id, piece, start, length, checksum, sequence, offset in found:
        by_doc.setdefault(doc_id, []).append((piece, start, length, checksum))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for doc_id, text in data:
        ids = expected_ids(BYTES, text, 0)
        pieces = sorted(by_doc[doc_id])
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert all(p[2] == capacity for p in pieces[1:]) and (len(pieces) == 1 or len(ids) > capacity)
        assert [p[1] for p in pieces] == list(np.cumsum([0] + [p[2] for p in pieces])[:-1])
        assert sum(p[2] for p in pieces) == len(ids)
        assert all(crc(ids[a : a + n]) == c for _, a, n, c in pieces)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    prepared(spark)
    rng = random.Random(2)
    data = [(i, sentence(i, rng.randrange(1, 120))) for i in range(400)] + [(1000, None), (1001, ""), (1002, sentence(1, 2000))]
    found = rows(packing.pack_documents(documents(spark, data), BYTES, 0, 256))
    sequences = check_packing(found, data, 256)
    total = sum(len(expected_ids(BYTES, t, 0)) for _, t in data)
    assert sequences <= 1.01 * -(-total // 256) + 1


def test_packing_repeated_rows_and_empty_table(spark):
    prepared(spark)
    found = rows(packing.pack_documents(documents(spark, [(1, "a b"), (1, "a b")]), BYTES))
    assert len(found) == 2 and len({(r[5], r[6]) for r in found}) == 2
    assert packing.pack_documents(documents(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, rng.integers(1, 800)) if seed else np.full(50, 60)
    counts = np.bincount(lengths, minlength=101)
    bins = packing.plan_sequences(counts, groups=12, slack=2)
    placed = np.zeros(101, dtype=int)
    for b in bins:
        assert sum(b.lengths) + b.free == 100 and b.free >= 0 and b.lengths
        np.add.at(placed, b.lengths, b.copies)
    assert (placed == counts).all()
    best = max(-(-int(lengths.sum()) // 100), int((lengths > 50).sum()))
    assert sum(b.copies for b in bins) <= best * 1.05 + 1
    runs = packing.rank_runs(bins, 100)
    assert len(set(zip(runs["length"], runs["rank"]))) == len(runs["rank"])


@pytest.mark.parametrize("scale", [1, 100_000])
def test_configurations_place_the_large_pieces(scale):
    rng = np.random.default_rng(7)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049) * scale
    bins, rest = packing.planned_large(counts)
    large = slice(int(2048 * packing.LARGE_SHARE), 2048)
    assert rest[large].sum() <= 0.1 * counts[large].sum()
    placed = rest.copy()
    for b in bins:
        assert sum(b.lengths) + b.free == 2048 and b.free >= 0
        np.add.at(placed, b.lengths, b.copies)
    assert (placed == counts).all()
    least = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(b.copies for b in packing.plan_sequences(counts)) <= 1.005 * least


def test_group_sizes_have_equal_cardinality():
    assert packing.group_sizes(np.bincount([9, 8, 8, 7, 5, 4, 3, 1], minlength=11), 3, 4) == [(9, 2), (8, 2), (5, 2), (3, 1)]
    assert packing.group_sizes(np.bincount([6] * 10, minlength=11), 3, 4) == [(6, 10)]
    assert packing.group_sizes(np.zeros(11, dtype=int), 3, 4) == []


def test_configurations_reach_the_linear_optimum():
    sizes, demand = np.array([50, 30, 20]), np.array([10.0, 10.0, 10.0])  # ten full sequences hold them all
    found = packing.configurations(sizes, demand, 100)
    assert (sum(c * u for c, u in found) >= demand - 1e-6).all()
    assert abs(sum(u for _, u in found) - 10) < 0.02

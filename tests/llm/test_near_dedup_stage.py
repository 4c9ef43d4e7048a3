import itertools
import random

import corpus_pipeline
from cartloom.llm import minhash
from tests.llm.shared import documents, sentence
from tests.llm.test_minhash import edited


def similarity(a, b):
    shared = len(set(a.tolist()) & set(b.tolist()))
    return shared / (len(a) + len(b) - shared)


def leads(data, least):
    """The smallest number of each component, by comparing all pairs."""
    sets = {i: minhash.shingles(t) for i, t in data}
    lead = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if similarity(sets[a], sets[b]) >= least]
    for _ in sets:
        for a, b in links:
            lead[a] = lead[b] = min(lead[a], lead[b])
    return {i for i in lead if lead[i] == i}


def planted():
    """Pairs on either side of 0.80 and of 0.85."""
    rng = random.Random(11)
    data = []
    for i in range(60):
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))
        data += [(2 * i, base), (2 * i + 1, edited(rng, base, 1 + i % 4))]
    return data


def test_stage_links_from_80_per_cent_on(spark):
    data = planted()
    sets = dict((i, minhash.shingles(t)) for i, t in data)
    between = [i for i in range(0, len(data), 2) if 0.80 <= similarity(sets[i], sets[i + 1]) < 0.85]
    below = [i for i in range(0, len(data), 2) if similarity(sets[i], sets[i + 1]) < 0.80]
    assert len(between) >= 5 and len(below) >= 5
    kept = corpus_pipeline.without_near_duplicates(spark, documents(spark, data), "")
    assert {r["doc_id"] for r in kept.collect()} == leads(data, 0.80)
    found = minhash.near_duplicates(documents(spark, data))  # op1's
    assert {r["doc_id"] for r in found.filter("kept").collect()} == leads(data, 0.85)


def test_large_group_around_80_per_cent(spark):
    """Buckets too large for pairs, with links on either side."""
    rng = random.Random(6)
    base = sentence(1, 150)
    data = [(i, edited(rng, base, rng.randrange(0, 9))) for i in range(150)]
    kept = corpus_pipeline.without_near_duplicates(spark, documents(spark, data), "")
    assert {r["doc_id"] for r in kept.collect()} == leads(data, 0.80)


def test_exact_path_at_80_per_cent(spark):
    rng = random.Random(9)
    sets = [(minhash.shingles(t), t) for t in (edited(rng, sentence(i % 4, 80 + i % 5), rng.randrange(0, 6)) for i in range(120))]
    by_class = {minhash.class_of(s): (s, t) for s, t in sets}
    crowd = spark.createDataFrame([(c, len(s), c) for c, (s, _) in by_class.items()], "class long, n long, comp long")
    texts = spark.createDataFrame([(c, t) for c, (_, t) in by_class.items()], "class long, text string")
    pairs = {frozenset((r["left"], r["right"])) for r in minhash.rare_shingle_pairs(crowd, texts, 80).collect()}
    links = {
        frozenset((a, b)) for a, b in itertools.combinations(by_class, 2) if similarity(by_class[a][0], by_class[b][0]) >= 0.80
    }
    assert links and links <= pairs


def test_keys_of_a_collection():
    assert [minhash.collection_for(p) for p in (85, 80)] == [minhash.COLLECTION, 10]

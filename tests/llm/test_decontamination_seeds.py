from cartloom.llm import decontamination as d
from cartloom.llm.shared import prepared
from tests.llm.shared import documents
from tests.llm.test_decontamination import benchmark


def test_a_large_group_of_one_edited_copy_beside_an_exact_one(spark):
    """The trigrams that the group keeps are the item's commonest."""
    words = [f"word{i}" for i in range(30)]
    edited = " ".join("changed" if i % 4 == 3 else w for i, w in enumerate(words))
    docs = documents(prepared(spark), [(0, " ".join(words))] + [(i, f"u{i} {edited} v{i}") for i in range(1, 301)])
    items = benchmark(spark, [(7, " ".join(words))])
    found = {r["doc_id"]: r["score"] for r in d.find(docs, items).collect()}
    assert set(found) == set(range(301))
    assert found[0] == 1.0 and all(0.5 <= found[i] < 1 for i in range(1, 301))
    assert d.decontaminated(docs, items).count() == 0


def test_the_better_copy_counts_whichever_seeds_lead_to_it(spark):
    words = [f"word{i}" for i in range(20)]
    item, half = " ".join(words), " ".join(words[:12])
    docs = documents(prepared(spark), [(1, f"{half} {'x ' * 90} {item}")] + [(i, item) for i in range(2, 20)])
    assert {r["score"] for r in d.find(docs, benchmark(spark, [(1, item)])).collect()} == {1.0}

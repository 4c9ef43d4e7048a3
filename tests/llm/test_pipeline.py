import re

import corpus_pipeline
from cartloom.llm import decontamination, secret_scan
from cartloom.llm.shared import prepared
from tests.llm.shared import SF_DIR, documents, sentence
from tests.llm.test_minhash import brute_force

BY_NAME = dict(corpus_pipeline.STAGES)


def test_stages_one_after_the_other(spark):
    docs = prepared(spark).read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "MinHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(spark.createDataFrame(stage(spark, frames[-1], SF_DIR).collect(), docs.schema))
        assert frames[-1].columns == docs.columns
    known, single, clean, redacted = ({r["doc_id"]: r["text"] for r in f.collect()} for f in frames[1:])
    assert set(known) == set(texts)  # all of them are in a language that it knows
    components = brute_force(known.items(), corpus_pipeline.NEAR_PERCENT)
    assert set(single) == {d for d, (n, c) in components.items() if d == c}
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = lambda t: " ".join(re.findall("[0-9A-Za-z\x80-\U0010ffff]+", t.lower()))
    held = {d for d, t in single.items() if any(plain(i) in plain(t) for i in items)}
    assert set(clean) == set(single) - held
    assert set(redacted) == set(clean)
    for doc_id, text in redacted.items():
        assert not re.search(secret_scan.BASE_RULES[2].long_pattern, text)
        assert ("<secret>" in text) or text == texts[doc_id]
    packed = BY_NAME["best-fit packing"](spark, frames[-1], SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(redacted)
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_stages_on_odd_rows(spark):
    """Every stage takes nulls, empty texts, repeated rows and clashing columns, and an empty table."""
    data = [(1, "The words of this text.", "en"), (1, "The words of this text.", "en"), (2, None, None), (None, "", None)]
    data += [(3, sentence(1, 3000), "en"), (4, "password=0123456789abcdef01 is the words", "en")]
    for rows in (data, []):
        for name, stage in corpus_pipeline.STAGES:
            docs = documents(spark, rows)
            found = stage(spark, docs, SF_DIR)
            if name != "best-fit packing":
                assert found.columns == docs.columns, name
            found.collect()


def test_a_benchmark_copy_goes_and_a_clean_document_stays(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    docs = documents(prepared(spark), [(1, f"before {item} after"), (2, sentence(1, 50))])
    stage = BY_NAME["benchmark decontamination"]
    assert [r["doc_id"] for r in stage(spark, docs, SF_DIR).collect()] == [2]
    assert decontamination.LEAST_SCORE <= 0.5

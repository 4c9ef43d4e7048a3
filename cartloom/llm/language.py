"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of its letter n-grams: byte trigrams of the lower-cased text with everything but letters
turned into single spaces, hashed to ``FEATURES`` places, logarithmic counts times inverse document frequency, of length one.
Labelled texts of each language are clustered into ``CLUSTERS`` centroids (spherical k-means); a text has the
language of the centroid with the greatest cosine. It is rejected as being of no learned language if that cosine is
below ``REJECT_SHARE`` of what the ``REJECT_QUANTILE`` least similar learning texts of about its length reach with their
nearest centroid, or if it has no letter. Short texts, which are few and less similar, are held against pieces cut out of all
learning texts as well.

The model is learned from at most ``LANGUAGE_ROWS`` labelled rows of each language, picked by hash, so that no language is lost
beside a larger one; every text, learned from or predicted, is taken as a whole. Texts become counts of n-grams in the
tasks, languages are clustered in a task each, and only sums, centroids and quantiles reach the driver.

Defined cases: null texts and texts without letters are ``und`` with score 0 and rejected; without any labelled row all
are; equal cosines go to the first language in order; null ``lang`` is never learned from; repeated rows and extra columns do
no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from cartloom.llm.shared import stored

FEATURE_BITS = 13
FEATURES = 1 << FEATURE_BITS
CLUSTERS = 4
# Learning rows of a language.
LANGUAGE_ROWS = 1_000
# Groups of input partitions that rank the rows of a language each for itself, before the ranks of all.
RANKED_APART = 256
ROUNDS = 8
REJECT_SHARE, REJECT_QUANTILE = 0.6, 0.001
UNKNOWN = "und"
# Lengths in n-grams that part the texts for rejection.
LENGTH_STEPS = np.array([4, 8, 16, 32, 64, 128, 256, 512])
# The first so many steps learn from pieces, too.
SHORT_STEPS = 6
# Texts in one matrix.
ROWS_AT_ONCE = 128

NOT_LETTERS = re.compile(r"[\W\d_]+")


def gram_places(text: str | None) -> np.ndarray:
    """The place of each n-gram of a text among the features; none if it has no letter."""
    letters = NOT_LETTERS.sub(" ", (text or "").lower()).strip(" ")
    if not letters:
        return np.zeros(0, dtype=np.int64)
    b = np.frombuffer(f"  {letters} ".encode(errors="replace"), dtype=np.uint8).astype(np.uint32)
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)


def pieces(places: np.ndarray) -> list[np.ndarray]:
    """A run of the n-grams of a longer text for each short length step; where it is cut depends on the text alone."""
    random = np.random.default_rng([len(places), int(places.sum())])
    shortest = 1
    out = []
    for longest in LENGTH_STEPS[:SHORT_STEPS]:
        n = int(random.integers(shortest, longest + 1))
        if n < len(places):
            start = int(random.integers(0, len(places) - n + 1))
            out.append(places[start : start + n])
        shortest = longest + 1
    return out


def counts_of(places: list[np.ndarray]) -> np.ndarray:
    """Logarithmic counts, a row for each text."""
    rows = np.repeat(np.arange(len(places)) * FEATURES, [len(p) for p in places])
    flat = np.bincount(rows + np.concatenate(places), minlength=len(places) * FEATURES)
    return np.log1p(flat.astype(np.float32)).reshape(len(places), FEATURES)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # a column for each
    owner: np.ndarray  # language of each centroid
    least: np.ndarray  # cosine below which a text is rejected, by length step

    def similarities(self, places: list[np.ndarray]) -> np.ndarray:
        """Greatest cosine of each text with each language."""
        vectors = counts_of(places) * self.idf
        cosines = vectors @ self.centroids / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        return np.stack([cosines[:, self.owner == i].max(axis=1) for i in range(len(self.languages))], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether rejected of each text."""
        names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        places = [gram_places(t) for t in texts]
        known = [i for i, p in enumerate(places) if len(p)] if self.languages else []
        for start in range(0, len(known), ROWS_AT_ONCE):
            part = known[start : start + ROWS_AT_ONCE]
            similar = self.similarities([places[i] for i in part])
            best = similar.argmax(axis=1)
            steps = np.searchsorted(LENGTH_STEPS, [len(places[i]) for i in part])
            for i, language, row, step in zip(part, best, similar, steps):
                names[i] = self.languages[language]
                scores[i] = min(1.0, max(0.0, float(row[language])))
                rejected[i] = scores[i] < self.least[step]
        return names, scores, rejected


def cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids of unit vectors by cosine; starts far apart, so that the outcome doesn't depend on chance."""
    centers = unit(rows.mean(axis=0, keepdims=True))
    while len(centers) < min(k, len(rows)):
        centers = np.concatenate([centers, rows[[(rows @ centers.T).max(axis=1).argmin()]]])
    for _ in range(ROUNDS):
        nearest = (rows @ centers.T).argmax(axis=1)
        means = [rows[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(centers)]
        centers = unit(np.array(means))
    return centers


def idf_of(seen: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequencies from how many of ``n`` texts have each n-gram."""
    return (np.log((1 + n) / (1 + seen)) + 0.1).astype(np.float32)


def centers_of(own: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Centroids of the texts of one language."""
    return cluster(
        np.concatenate([unit(counts_of(own[s : s + ROWS_AT_ONCE]) * idf) for s in range(0, len(own), ROWS_AT_ONCE)]),
        CLUSTERS,
    )


def model_of(centers: dict[str, np.ndarray], idf: np.ndarray) -> LanguageModel:
    """A model that rejects nothing yet but texts without letters."""
    nothing = np.zeros(len(LENGTH_STEPS) + 1)
    languages = sorted(centers)
    if not languages:
        return LanguageModel([], np.zeros(FEATURES, np.float32), np.zeros((FEATURES, 0)), np.zeros(0), nothing)
    owner = np.repeat(np.arange(len(languages)), [len(centers[x]) for x in languages])
    return LanguageModel(languages, idf, np.concatenate([centers[x] for x in languages]).T.copy(), owner, nothing)


def steps_and_cosines(model: LanguageModel, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Length step and cosine with the nearest centroid, of each text and of its pieces."""
    held = [piece for p in places for piece in (p, *pieces(p))]
    cosines = [model.similarities(held[s : s + ROWS_AT_ONCE]).max(axis=1) for s in range(0, len(held), ROWS_AT_ONCE)]
    return np.searchsorted(LENGTH_STEPS, [len(p) for p in held]), np.concatenate([np.zeros(0), *cosines])


def bounds(quantiles: dict[int, float]) -> np.ndarray:
    """The cosine below which a text is rejected, by length step."""
    lowest = np.array([quantiles.get(s, np.inf) for s in range(len(LENGTH_STEPS) + 1)])
    # A length that no learning text has takes the next longer one that some have; short texts are less similar.
    lowest = np.minimum.accumulate(lowest[::-1])[::-1]
    return np.where(np.isfinite(lowest), lowest, 0) * REJECT_SHARE


def fit(rows: list[tuple[str, str]]) -> LanguageModel:
    """Learn from (text, language) pairs."""
    found = [(p, lang) for text, lang in rows if len(p := gram_places(text))]
    seen = np.zeros(FEATURES)
    for p, _ in found:
        seen[np.unique(p)] += 1
    idf = idf_of(seen, len(found))
    languages = {lang for _, lang in found}
    model = model_of({x: centers_of([p for p, lang in found if lang == x], idf) for x in languages}, idf)
    if languages:
        steps, cosines = steps_and_cosines(model, [p for p, _ in found])
        model.least = bounds({int(s): np.quantile(cosines[steps == s], REJECT_QUANTILE) for s in np.unique(steps)})
    return model


def smallest(rows: DataFrame, *order: Column | str) -> DataFrame:
    """``rows`` (with lang) with at, their place by ``order``: the first ``LANGUAGE_ROWS`` of each language.

    Groups of input partitions choose theirs first, so that no task ranks a whole language.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(RANKED_APART))
    of_group = F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    of_all = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = rows.withColumn("group", group).withColumn("at", of_group).filter(F.col("at") <= LANGUAGE_ROWS)
    return first.withColumn("at", of_all).filter(F.col("at") <= LANGUAGE_ROWS).drop("group")


def sampled(docs: DataFrame, learned: Column) -> DataFrame:
    """lang, at, text: the ``LANGUAGE_ROWS`` rows of each language with the smallest hashes, whatever the partitions are."""
    rows = docs.filter(learned & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", F.xxhash64(F.col("doc_id"), F.lit(7)).alias("o"), "text")
    # Only keys take part in the choice; then the chosen rows' texts are read.
    chosen = smallest(rows.select("lang", "o"), "o")
    last = stored(chosen.groupBy("lang").agg(F.max("o").alias("last")), "sample-bounds")
    near = rows.join(last, "lang").filter(F.col("o") <= F.col("last")).drop("last")
    # Again, for rows that repeat a doc_id.
    return smallest(near, "o", F.xxhash64("text")).select("lang", "at", "text")


def learn(docs: DataFrame, learned: Column) -> LanguageModel:
    """Fit on a bounded sample of each language among the rows of ``docs`` (doc_id, text, lang) that ``learned`` picks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_places(t) for t in batch.column("text").to_pylist()]
            grams = pa.array([p.astype(np.int16) for p in found], pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("at"), grams], names=["lang", "at", "places"]
            )

    counted = sampled(docs, learned).mapInArrow(count, "lang string, at int, places array<short>")
    texts = stored(counted.filter(F.size("places") > 0), "language-sample")
    n = texts.count()
    each = texts.select(F.explode(F.array_distinct("places")).alias("place"))
    seen = np.zeros(FEATURES)
    for row in each.groupBy("place").count().collect():
        seen[row["place"]] = row["count"]
    idf = idf_of(seen, n)
    send = docs.sparkSession.sparkContext.broadcast
    sent_idf = send(idf)

    def centers(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("at").to_pylist(), group.column("places").to_numpy()), key=lambda r: r[0])
        found = centers_of([np.asarray(p, dtype=np.int64) for _, p in rows], sent_idf.value).astype(np.float64)
        names = pa.array([group.column("lang")[0].as_py()] * len(found), pa.string())
        return pa.Table.from_arrays([names, pa.array(list(found), pa.list_(pa.float64()))], names=["lang", "center"])

    clustered: dict[str, list] = {}
    for row in texts.groupBy("lang").applyInArrow(centers, "lang string, center array<double>").collect():
        clustered.setdefault(row["lang"], []).append(row["center"])
    model = model_of({x: np.array(c, dtype=np.float32) for x, c in clustered.items()}, idf)
    sent = send(model)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [np.asarray(p, dtype=np.int64) for p in batch.column("places").to_numpy(zero_copy_only=False)]
            steps, cosines = steps_and_cosines(sent.value, places)
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), pa.array(cosines)], names=["step", "cosine"])

    lowest = texts.select("places").mapInArrow(compare, "step int, cosine double").groupBy("step")
    found = lowest.agg(F.percentile("cosine", F.lit(REJECT_QUANTILE)).alias("q")).collect() if n else []
    model.least = bounds({row["step"]: row["q"] for row in found})
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` (with text) with lang_pred, score and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = sent.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                names=batch.schema.names + ["lang_pred", "score", "rejected"],
            )

    added = StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(predict, StructType(docs.schema.fields + added.fields))

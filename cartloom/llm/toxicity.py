"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are rates: insults of a lexicon and the same in disguise (digits and signs for letters, letters
spelled out one by one or drawn out), how near they stand to words of the second person, words that mark toxic
texts in the learning rows, capitals, exclamation marks, other signs, digits and repeated characters. They come from
the whole text, whatever its length, and from nothing but the text.

Trees are boosted on ``TREE_SHARE`` of at most ``SAMPLE_ROWS`` labelled rows, picked by hash; an isotonic regression on the others
turns their margin into a probability.

Defined cases: null and empty texts have all rates at 0 and get the score of such a text; without learning rows, or
with one label only, every score is the mean label (0 without any); rows whose label is null are not learned from; a repeated
``doc_id`` is learned from once for each pair of its rows and labels; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.shared import columns, stored

SAMPLE_ROWS = 20_000
TREE_SHARE = 0.75
TREES, DEPTH, STEP = 25, 4, 0.2
# Words and word beginnings of the learning rows: in this share and this number of the toxic ones at least, and so many
# times as often as in others.
WORD_SHARE, WORD_TEXTS, WORD_LIFT = 0.03, 10, 8.0
MOST_WORDS = 300
# Learning texts of one label whose words agree in so many minimum hashes count once there: all of equal words, and of others
# a share of their similarity to that power.
COPY_HASHES = 4
# Lengths of word beginnings, marked with a star: words inflect.
BEGINNINGS = (4, 5)
# Words to either side in which a second person makes an insult personal.
NEAR = 6

LEXICON = frozenset(
    "arse arsehole ass asshole bastard bitch bullshit clown coward crap creep cretin cunt degenerate dick dickhead dimwit "
    "disgusting dolt douche dumb dumbass dunce fool freak fuck fucker fucking garbage halfwit hate idiot idiotic idiots "
    "ignorant imbecile inbred jackass jerk kill loser losers lowlife lunatic maggot moron moronic morons motherfucker "
    "nitwit numbskull parasite pathetic pervert pig pigs prick psycho rat repulsive retard retarded rubbish scum scumbag "
    "shit shithead shitty shut sicko simpleton slime slut sucker stupid subhuman swine thug trash turd twat twit ugly "
    "useless vermin vile wanker whore worthless wretch "
    "abschaum arsch arschloch blöd blödmann depp dreck dreckig dumm dummkopf hure idioten miststück schlampe schwachkopf "
    "schwein scheiße trottel versager wertlos widerlich "
    "abruti bâtard connard connasse con crétin débile dégoûtant enculé imbécile lamentable merde minable ordure pourri salaud "
    "salope stupide débiles racaille "
    "asqueroso basura bastardo cabrón estúpido estúpida gilipollas idiotas imbécil inútil mierda patético pendejo perdedor "
    "puta puto tonto".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves ya u ur youre youve thou thee du dich dir dein deine deiner euch euer ihr sie tu te toi "
    "ton ta tes vous votre vos tú ti contigo usted ustedes vosotros tus vuestro".split()
)
WORD = re.compile(r"[^\W\d_]+")
SIGN_FOR_LETTER = re.compile(r"[\d@$!*]")
DISGUISED = re.compile(r"(?:[^\W_]|[@$!*])+")
SPELLED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W_])")
DRAWN_OUT = re.compile(r"(.)\1{2,}")
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"})
NOT_LETTERS = re.compile(r"[^a-z]+")

FEATURES = (
    "words insults insult_rate insult_kinds disguised disguised_rate personal personal_rate second_person_rate "
    "marked marked_rate marked_kinds capitals shouted exclamations questions signs digits repeats"
).split()


def shortened(token: str) -> tuple[str, ...]:
    """``token``, and where it has drawn-out characters also with these once and twice."""
    if not DRAWN_OUT.search(token):
        return (token,)
    return token, DRAWN_OUT.sub(r"\1", token), DRAWN_OUT.sub(r"\1\1", token)


def read_insult(token: str) -> str | None:
    """The insult that ``token`` spells with digits and signs for letters, if any; marks behind a word are no disguise."""
    for form in shortened(token):
        plain = form.translate(PLAIN)
        for reading in (plain, plain.rstrip("i"), form.replace("1", "l").translate(PLAIN), NOT_LETTERS.sub("", form)):
            if reading in LEXICON and reading != form.rstrip("!*"):
                return reading
    return None


def disguised_insults(lowered: str) -> list[str]:
    """Insults that are not spelled as words: with digits and signs in them, letter by letter, or drawn out. Underscores part
    words; tokens may have any length."""
    found = []
    done = 0
    for m in SIGN_FOR_LETTER.finditer(lowered):
        start = m.start()
        if start < done:
            continue
        while start > done and lowered[start - 1].isalnum():
            start -= 1
        token = DISGUISED.match(lowered, start).group()
        done = start + len(token)
        if insult := read_insult(token):
            found.append(insult)
    for m in SPELLED.finditer(lowered):
        joined = NOT_LETTERS.sub("", m.group())
        found += [w for w in (joined,) if w in LEXICON]
    done = 0
    for m in DRAWN_OUT.finditer(lowered):
        start, end = m.span()
        if start < done:
            continue
        while start > done and lowered[start - 1].isalpha():
            start -= 1
        while end < len(lowered) and lowered[end].isalpha():
            end += 1
        done = end
        found += [w for w in shortened(lowered[start:end])[1:] if w in LEXICON][:1]
    return found


def rates(text: str | None, marked: frozenset[str]) -> list[float]:
    """The features of a text, in the order of ``FEATURES``."""
    text = text or ""
    lowered = text.lower()
    words = WORD.findall(lowered)
    n, n_chars = max(len(words), 1), max(len(text), 1)
    distinct = set(words)
    insults = distinct & LEXICON
    marks = (distinct | {f"{w[:k]}*" for k in BEGINNINGS for w in distinct}) & marked if marked else marked
    persons = distinct & SECOND_PERSON
    n_insults = n_marks = n_persons = n_personal = 0
    if insults or marks or persons:
        at_insult = [i for i, w in enumerate(words) if w in insults]
        at_person = np.array([i for i, w in enumerate(words) if w in persons])
        n_insults, n_persons = len(at_insult), len(at_person)
        n_marks = sum(not marks.isdisjoint((w, *(f"{w[:k]}*" for k in BEGINNINGS))) for w in words) if marks else 0
        if n_insults and n_persons:
            right = np.searchsorted(at_person, at_insult)
            after = at_person[np.minimum(right, n_persons - 1)]
            before = at_person[np.maximum(right - 1, 0)]
            gap = np.minimum(np.abs(after - at_insult), np.abs(before - np.array(at_insult)))
            n_personal = int((gap <= NEAR).sum())
    n_disguised = len(disguised_insults(lowered))
    signs = Counter(text)
    letters = max(sum(map(len, words)), 1)
    capitals = sum(c for s, c in signs.items() if s.isupper())
    return [
        math.log1p(len(words)),
        math.log1p(n_insults),
        n_insults / n,
        len(insults),
        math.log1p(n_disguised),
        n_disguised / n,
        math.log1p(n_personal),
        n_personal / n,
        n_persons / n,
        math.log1p(n_marks),
        n_marks / n,
        len(marks),
        capitals / letters,
        sum(len(w) > 2 for w in text.split() if w.isupper()) / n,
        signs["!"] / n_chars,
        signs["?"] / n_chars,
        sum(c for s, c in signs.items() if not s.isalnum() and not s.isspace()) / n_chars,
        sum(c for s, c in signs.items() if s.isdigit()) / n_chars,
        sum(m.end() - m.start() for m in DRAWN_OUT.finditer(lowered)) / n_chars,
    ]


def sample(docs: DataFrame, labels: DataFrame, learned: Column) -> DataFrame:
    """doc_id, text, toxic, for_trees: at most ``SAMPLE_ROWS`` labelled rows that ``learned`` picks, by hash."""
    known = columns(labels, ("doc_id", "toxic")).filter(learned & F.col("toxic").isNotNull())
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    chosen = known.distinct().orderBy(order, "doc_id", "toxic").limit(SAMPLE_ROWS)
    for_trees = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(1000)) < int(1000 * TREE_SHARE)
    # At most SAMPLE_ROWS pairs of numbers: the texts stay where they are.
    return columns(docs, ("doc_id", "text")).join(F.broadcast(chosen), "doc_id").withColumn("for_trees", for_trees)


def least_hash(words: str, seed: int) -> Column:
    return F.array_min(F.transform(words, lambda w: F.xxhash64(w, F.lit(seed))))


def marking_words(rows: DataFrame) -> frozenset[str]:
    """Words and beginnings of words that toxic texts of ``rows`` hold much more often than others; at most ``MOST_WORDS``."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    texts = rows.select("toxic", words.alias("words"))
    texts = texts.withColumn("copy", F.xxhash64(*[least_hash("words", k) for k in range(COPY_HASHES)]))
    texts = stored(texts.dropDuplicates(["toxic", "copy"]), "learning-words")
    toxic = F.sum("toxic")
    size = texts.agg(toxic.alias("toxic"), F.count("*").alias("n")).first()
    if not size["toxic"] or size["toxic"] == size["n"]:
        return frozenset()
    longer = lambda k: F.transform(
        F.filter("words", lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*"))
    )
    forms = F.array_distinct(F.concat(F.col("words"), *[longer(k) for k in BEGINNINGS]))
    counted = (
        texts.select("toxic", F.explode(forms).alias("word"))
        .filter(F.length("word") > 2)
        .groupBy("word")
        .agg(toxic.alias("t"), F.count("*").alias("n"))
    )
    other = (F.col("n") - F.col("t") + 1) / (size["n"] - size["toxic"] + 1)
    share = F.col("t") / size["toxic"]
    best = counted.filter((F.col("t") >= WORD_TEXTS) & (share >= WORD_SHARE) & (share >= WORD_LIFT * other))
    return frozenset(r["word"] for r in best.orderBy(F.desc("t"), "word").limit(MOST_WORDS).collect())


def with_features(rows: DataFrame, marked: frozenset[str]) -> DataFrame:
    """``rows`` with their text turned into features."""
    kept = [c for c in rows.columns if c != "text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rates(t, marked) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(found, pa.list_(pa.float64()))], names=[*kept, "features"]
            )

    types = dict(rows.dtypes)
    return rows.mapInArrow(read, ", ".join([f"`{c}` {types[c]}" for c in kept] + ["features array<double>"]))


def learn(rows: DataFrame) -> tuple[GBTClassificationModel, IsotonicRegressionModel] | float:
    """Trees and calibration from ``rows`` (features, toxic, for_trees), or the mean label if there is one label only."""
    rows = rows.select(array_to_vector("features").alias("vector"), F.col("toxic").cast("double").alias("label"), "for_trees")
    counts = {r["for_trees"]: (r["n"], r["t"]) for r in rows.groupBy("for_trees").agg(F.count("*").alias("n"), F.sum("label").alias("t")).collect()}
    n, t = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if any(not 0 < counts.get(part, (0, 0))[1] < counts.get(part, (0, 0))[0] for part in (True, False)):
        return float(t) / n if n else 0.0
    trees = GBTClassifier(featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5).fit(rows.filter("for_trees"))
    margins = trees.transform(rows.filter("NOT for_trees")).select("label", margin().alias("margin"))
    return trees, IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margins)


def margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def score(docs: DataFrame, labels: DataFrame, learned: Column) -> DataFrame:
    """doc_id and score of each of ``docs``, learned from the labelled rows that ``learned`` (of doc_id) picks."""
    rows = stored(sample(docs, labels, learned), "labelled")
    marked = marking_words(rows)
    model = learn(stored(with_features(rows, marked), "learning-features"))
    features = with_features(columns(docs, ("doc_id", "text")), marked)
    if isinstance(model, float):
        return features.select("doc_id", F.lit(model).alias("score"))
    trees, calibration = model
    scored = trees.transform(features.select("doc_id", array_to_vector("features").alias("vector")))
    found = calibration.transform(scored.select("doc_id", margin().alias("margin")))
    return found.select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))

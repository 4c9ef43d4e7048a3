"""Near-duplicate documents: MinHash with tensored banding, links confirmed on the full shingle sets.

A document is its set of distinct runs of ``SHINGLE_WORDS`` words. Two collections of ``COLLECTION`` keys, each of ``ROWS``
minimum hashes, are combined in pairs: every key of the first with every key of the second makes a table, so
``COLLECTION`` squared tables of 2 ``ROWS`` rows cost only 2 ``COLLECTION`` ``ROWS`` hashes. Documents that agree in some table
are candidates. The least similarity is a parameter, ``percent``; ``collection_for`` takes as many keys as it needs for a pair
at that similarity to be missed less than once in 13,000 (8 keys at 0.85: once in 14,200; 10 keys at 0.80: once in 13,700).

1. Documents of equal sets become one class before anything else, so exact copies, however many, are one row.
2. In each bucket the class that shares most buckets with others is confirmed against the rest, and what is linked is merged.
3. Buckets that now hold one component are done. Of small ones the pairs between components are confirmed.
4. For classes in larger ones, links are found exactly, without forming their pairs: linked sets share a shingle
   among the few rarest of each (prefix filter), and rare shingles are shared by few. Thus a group of thousands of near copies
   costs about as many comparisons as it has members, and none is left out.

Links become components by alternating star contraction; every round is a table in the shared folder.

Defined cases: documents without words (null or empty texts) have an empty set, are linked with nothing and kept; those of fewer
words than a shingle are one shingle; rows that repeat a ``doc_id`` are compared like others, and a null ``doc_id`` counts
only where its whole component has none; extra columns are ignored by ``components`` and kept by ``deduplicated``; empty
tables give empty results. Sets are told apart by 64-bit hashes of shingles and of sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.llm.hashing import MIX, WHITE_SPACE, scrambled, word_hashes
from cartloom.llm.shared import columns, stored

SHINGLE_WORDS = 5
ROWS, COLLECTION = 2, 8
# Linked at 100 * intersection >= percent * union; this one is op1's.
PERCENT = 85
# Pairs at the least similarity that the tables miss, at most.
MISSED = 1 / 13_000
# Buckets of up to so many classes are compared pair by pair.
SMALL_BUCKET = 16
# Classes that one task compares with the same class.
COMPARED_AT_ONCE = 256
SIZE_STEP = 1.02
# Rare shingles that a row of the exact path carries along at most.
CARRIED = 64
# Hash bins of a set's shingles: a pair shares at most the sum, over the bins, of the smaller count.
BINS = 128


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit shingle hashes of a text, ascending."""
    # bytes.lower changes A to Z only.
    h = word_hashes((text or "").encode().lower(), WHITE_SPACE)
    if not len(h):
        return h
    width = min(SHINGLE_WORDS, len(h))
    mixed = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : i + len(mixed)]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(scrambled(mixed))


def collection_for(percent: int) -> int:
    """The keys of a collection for links from ``percent`` on."""
    return math.ceil(math.log(MISSED / 2) / math.log(1 - (percent / 100) ** ROWS))


@lru_cache(maxsize=None)
def hash_functions(collection: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the hash functions of both collections."""
    random = np.random.default_rng(20240607)
    factors = random.integers(0, 1 << 63, 2 * ROWS * collection, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 1 << 63, 2 * ROWS * collection, dtype=np.uint64)


def collection_keys(s: np.ndarray, collection: int = COLLECTION) -> np.ndarray:
    """The keys of both collections for a non-empty set, one after the other."""
    minima = np.array([(s * a + b).min() for a, b in zip(*hash_functions(collection))], dtype=np.uint64)
    keys = np.arange(2 * collection, dtype=np.uint64)
    for row in range(ROWS):
        keys = scrambled(keys * MIX + minima[row::ROWS])
    return keys.view(np.int64)


def class_of(s: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))).view(np.int64))


def sketches(docs: DataFrame, collection: int = COLLECTION) -> DataFrame:
    """doc_id, n_shingles, class and the keys of each of ``docs``; no class for an empty set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([collection_keys(s, collection) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "keys"],
            )

    return columns(docs, ("doc_id", "text")).mapInArrow(
        sketch, "doc_id long, n_shingles long, class long, keys array<long>"
    )


def sizes_fit(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def buckets(classes: DataFrame, collection: int = COLLECTION) -> DataFrame:
    """key, class, n: the tables' buckets of two classes and more.

    A pair of keys is shared only where each of them is, so the pairs are made of keys that two classes and more have.
    """
    # Keys of different places in a collection never agree but by chance, as the place is mixed in.
    single = classes.select("class", "n", F.posexplode("keys").alias("place", "key"))
    met = single.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1").select("key")
    first = F.collect_list(F.when(F.col("place") < collection, F.col("key")))
    second = F.collect_list(F.when(F.col("place") >= collection, F.col("key")))
    of_class = single.join(met, "key").groupBy("class").agg(
        F.first("n").alias("n"), first.alias("first"), second.alias("second")
    )
    rows = of_class.select("class", "n", F.explode("first").alias("a"), "second")
    keyed = rows.select("class", "n", "a", F.explode("second").alias("b")).select(F.xxhash64("a", "b").alias("key"), "class", "n")
    keyed = stored(keyed, "keyed")
    shared = keyed.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
    return keyed.join(shared, "key")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs`` (left, right; distinct) whose sets are linked. ``texts``: class, text.

    The right texts are brought to the left one, in groups of bounded size.
    """
    groups = pairs.groupBy("left").agg(F.ceil(F.count("*") / COMPARED_AT_ONCE).cast("int").alias("groups"))
    part = F.pmod(F.xxhash64("right"), F.col("groups")).cast("int").alias("part")
    dealt = pairs.join(groups, "left").select("left", "right", part)
    right = dealt.join(texts, dealt["right"] == texts["class"]).select(
        "left", "part", F.lit(1).alias("side"), "class", "text"
    )
    left = dealt.select("left", "part").distinct().join(texts, F.col("left") == texts["class"]).select(
        "left", "part", F.lit(0).alias("side"), "class", "text"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_set = None, None
        for batch in batches:
            found: list[tuple[int, int]] = []
            for at, side, other, text in zip(*[batch.column(c).to_pylist() for c in ("left", "side", "class", "text")]):
                s = shingles(text)
                if class_of(s) != other:  # another text under the same doc_id
                    continue
                if side == 0:
                    own, own_set = at, s
                elif own == at and linked(own_set, s, percent):
                    found.append((at, other))
            kinds = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))]
            yield pa.RecordBatch.from_arrays(kinds, names=["left", "right"])

    together = left.unionByName(right).repartition("left", "part").sortWithinPartitions("left", "part", "side")
    return together.mapInArrow(compare, "left long, right long")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of the component, for every node of ``edges`` (left, right) but the roots."""
    edges = stored(edges.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lower, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def with_component(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (with class) with comp, their component so far."""
    found = roots.select(F.col("node").alias("class"), "root")
    return rows.join(found, "class", "left").withColumn("comp", F.coalesce("root", "class")).drop("root")


def overlap(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """The least intersection of linked sets of these sizes."""
    return F.ceil((a + b) * percent / (100.0 + percent) - 1e-9)


def size_step(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(SIZE_STEP) + 1e-9).cast("int")


def rare_shingle_pairs(crowd: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """left, right: the pairs among ``crowd`` (class, n, comp) that can be linked and lie in different components.

    By a common order of the shingles from the rarest on, two sets with an overlap of o share one of the first n - o + 1 of
    each. The smaller set need only look that far for a partner of its own size, the larger for each range of smaller sizes.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch.column("class").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(text)
                if class_of(s) == own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), own)), pa.array(s.view(np.int64))], names=["class", "token"]
                    )

    held = crowd.select("class").join(texts, "class").dropDuplicates(["class"])
    tokens = stored(held.mapInArrow(spread, "class long, token long"), "crowd")
    counted = tokens.groupBy("class", F.pmod("token", F.lit(BINS)).alias("bin")).agg(F.count("*").cast("int").alias("c"))
    counts = counted.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.coalesce(F.element_at("m", i.cast("long")), F.lit(0)))
    bins = stored(counts.select("class", dense.alias("bins")), "bins")
    common = tokens.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("class").orderBy("df", "token")
    placed = tokens.join(common, "token").withColumn("place", F.row_number().over(order))
    n = F.col("n")
    # Alone, a shingle finds nobody, but takes its place.
    rows = placed.join(crowd, "class").filter((F.col("place") <= n - F.ceil(n * percent / 100.0 - 1e-9) + 1) & (F.col("df") > 1))
    # What a pair shares further on, it has met by before: the shingles up to there go along, up to a bound.
    earlier = Window.partitionBy("class").orderBy("place").rowsBetween(-CARRIED, -1)
    before = F.when(F.col("place") <= CARRIED, F.collect_list("token").over(earlier))
    rows = rows.select("token", "place", "class", "n", "comp").withColumn("before", before).join(bins, "class")
    rows = stored(rows, "prefixes")
    index = rows.filter(F.col("place") <= n - overlap(n, n, percent) + 1).withColumn("step", size_step(n))
    least = F.ceil(n * percent / 100.0 - 1e-9)
    probe = rows.withColumn("step", F.explode(F.sequence(size_step(least), size_step(n))))
    smallest = F.greatest(least, F.floor(F.pow(F.lit(SIZE_STEP), F.col("step")) - 1e-6))
    probe = probe.filter(F.col("place") <= n - overlap(n, smallest, percent) + 1)
    # Only pairs between components are formed: what is not of a shingle's main component meets all others, what is of it
    # meets those that are not.
    per_comp = index.groupBy("token", "step", "comp").agg(F.count("*").alias("c"))
    main = per_comp.groupBy("token", "step").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps")
    )
    a = index.join(main, ["token", "step"]).select(
        "token", "step", "comps", F.col("class").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"),
        F.col("place").alias("px"), F.col("before").alias("bx"), F.col("bins").alias("kx"), (F.col("comp") == F.col("main")).alias("x_main"),
    )
    b = probe.join(main, ["token", "step"]).select(
        "token", "step", F.col("class").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"),
        F.col("place").alias("py"), F.col("before").alias("by"), F.col("bins").alias("ky"), (F.col("comp") == F.col("main")).alias("y_main"),
    )
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    reach = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) + 1
    fits = (F.col("cx") != F.col("cy")) & smaller & sizes_fit(F.col("nx"), F.col("ny"), percent)
    fits = fits & (reach >= overlap(F.col("nx"), F.col("ny"), percent))
    fits = fits & ~F.coalesce(F.arrays_overlap("bx", "by"), F.lit(False))
    # An exact bound, so that large groups of near copies that are not linked do not all reach the confirmation.
    most = F.aggregate(F.zip_with("kx", "ky", lambda p, q: F.least(p, q)), F.lit(0), lambda acc, v: acc + v)
    fits = fits & (most >= overlap(F.col("nx"), F.col("ny"), percent))
    on = ["token", "step"]
    first = a.join(b.filter("NOT y_main"), on).filter(fits)
    second = a.filter("NOT x_main").join(b.filter("y_main"), on).filter(fits)
    pairs = first.select("x", "y").union(second.select("x", "y"))
    return pairs.select(F.col("x").alias("left"), F.col("y").alias("right")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class of each of ``docs`` (doc_id, text), linked from ``percent`` on."""
    collection = collection_for(percent)
    rows = stored(sketches(docs, collection), "sketches")
    in_class = rows.filter("class IS NOT NULL")
    classes = in_class.groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
    )
    classes = stored(classes, "classes")
    met = stored(buckets(classes, collection), "buckets")
    wanted = met.select("class").distinct().join(classes.select("class", "first_id"), "class")
    own = columns(docs, ("doc_id", "text"))
    texts = own.join(wanted, own["doc_id"].eqNullSafe(wanted["first_id"])).select("class", "text")
    texts = stored(texts, "texts")

    popular = met.groupBy("class").agg(F.sum("held").alias("popularity"))
    chosen = F.max_by(F.struct(F.col("class").alias("left"), F.col("n").alias("left_n")), F.struct("popularity", "class"))
    pivots = met.join(popular, "class").groupBy("key").agg(chosen.alias("p")).select("key", "p.*")
    star = met.join(pivots, "key").filter((F.col("class") != F.col("left")) & sizes_fit(F.col("n"), F.col("left_n"), percent))
    star = stored(star.select("left", F.col("class").alias("right")).distinct(), "star")
    edges = stored(confirmed(star, texts, percent), "links")
    roots = components(edges)

    rest = with_component(met, roots)
    open_ = rest.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    rest = stored(rest.join(open_.select("key"), "key"), "open")
    small = rest.filter(F.col("held") <= SMALL_BUCKET)
    other = small.select("key", F.col("class").alias("right"), F.col("n").alias("right_n"), F.col("comp").alias("right_comp"))
    pairs = small.withColumnRenamed("class", "left").join(other, "key").filter(
        (F.col("left") < F.col("right")) & (F.col("comp") != F.col("right_comp")) & sizes_fit(F.col("n"), F.col("right_n"), percent)
    )
    crowd = rest.filter(F.col("held") > SMALL_BUCKET).select("class", "n", "comp").distinct()
    more = pairs.select("left", "right").union(rare_shingle_pairs(stored(crowd, "crowd"), texts, percent))
    more = more.distinct().join(star, ["left", "right"], "left_anti")
    more = more.join(star.select(F.col("left").alias("right"), F.col("right").alias("left")), ["left", "right"], "left_anti")
    edges = edges.union(confirmed(stored(more, "pairs"), texts, percent))
    roots = components(edges)

    owned = with_component(classes.select("class", "first_id"), roots)
    lead = owned.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    by_class = owned.join(lead, "comp").select("class", "component_id")
    found = rows.select("doc_id", "n_shingles", "class").join(by_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        "class",
    )


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest ``doc_id``, once if its row is repeated."""
    found = stored(near_duplicates(docs, percent).filter("kept"), "kept")
    kept = found.groupBy("doc_id").agg(F.count("*").alias("_times")).withColumnRenamed("doc_id", "_kept_id")
    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"])).drop("_kept_id")
    if found.count() == kept.count():
        return joined.drop("_times")
    # Rows that repeat a doc_id: one of each text.
    once = joined.filter("_times = 1")
    number = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))
    repeated = joined.filter("_times > 1").withColumn("_number", number).filter("_number = 1").drop("_number")
    return once.union(repeated).drop("_times")


NEAR_DUPLICATE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM words),
flat AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 85 * (nx + ny - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, r.y AS component_id, doc_id = r.y AS kept
FROM sets JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) r ON x = doc_id"""

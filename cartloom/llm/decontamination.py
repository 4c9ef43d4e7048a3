"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The word trigrams of the test items are looked for in all documents and counted; the rarer ``RARE_SHARE`` of those that occur
seed each item; the others that occur are seeds of last resort. Around every place where a document has a seed of an item, the passage that a copy of the item would fill, with room
for insertions, is aligned with the item word by word: ``MATCH`` for equal words, ``MISMATCH`` for different ones, ``GAP`` for
left-out or inserted ones. The best local alignment's share of a full match is the score; from ``LEAST_SCORE`` on the document
holds a copy, whether exact, edited or partly rewritten.

Items go to the tasks in blocks of bounded size (``BLOCK_ITEMS`` and ``BLOCK_BYTES``; a larger benchmark takes a pass
for each block), documents never move: no text is shuffled, and a document, however long, is aligned only around seeds.

Words are runs of letters, digits and marks, in lower case; white space, punctuation, symbols and invisible characters part them,
ASCII or not. Defined cases: null and empty texts hold and are nothing; items of less
than ``SEED_WORDS`` words can't be told from chance and are never found; items of equal text are found each; repeated
documents give repeated rows; extra columns are ignored by ``find`` and kept by ``decontaminated``; empty tables give an empty
result or, for no items, all documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from cartloom.llm.hashing import NO_WORD, word_hashes
from cartloom.llm.shared import columns

SEED_WORDS = 3
# Share of an item's seeds, from the rarest on, that come first; passages that only others lead to come after them.
RARE_SHARE = 0.75
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
# A seed of more items than that leads only to those whose words are about.
FEW_ITEMS = 16
# Items whose lengths differ by no more than the share that makes so many steps a doubling are looked at together.
KINDS_A_DOUBLING = 2
# Passages merged, and cells of alignments computed, at once.
MERGED_AT_ONCE, CELLS_AT_ONCE = 1 << 18, 1 << 18

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
MAP_BITS = 20


# Categories of the characters that part words: spaces, punctuation, symbols, controls and invisible characters.
PARTING = frozenset("Zs Zl Zp Pc Pd Ps Pe Pi Pf Po Sm Sc Sk So Cc Cf".split())
NO_LETTER = re.compile(r"[^\x00-\x7f\w]")


@lru_cache(maxsize=4096)
def in_word(character: str) -> str:
    """A blank for a character that parts words, any other as it is."""
    return " " if unicodedata.category(character) in PARTING else character


def lowered(text: str) -> str:
    """Lower case, with a blank for each non-ASCII character that parts words."""
    text = text.lower()
    return text if text.isascii() else NO_LETTER.sub(lambda m: in_word(m[0]), text)


def hashes_of(text: str | None) -> np.ndarray:
    return word_hashes(lowered(text or "").encode(), NO_WORD)


def grams(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each run of ``SEED_WORDS`` words."""
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(SEED_WORDS):
        mixed = (mixed ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


@dataclass
class Items:
    """Test items with the seeds that lead to them."""

    ids: list
    words: list[np.ndarray]
    # One row for each seed's place: its hash (ascending), the item, the place in it.
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    first: np.ndarray  # whether it is one of the item's rarer seeds
    _map: np.ndarray | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        """Words of the items by number, and the items by the words that they have."""
        self.length = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.length)])
        flat = np.concatenate([np.zeros(0, np.uint64), *self.words])
        self.vocabulary, number = np.unique(flat, return_inverse=True)
        self.number = number.astype(np.int32)
        # Items of about one length are of one kind.
        self.kind = (KINDS_A_DOUBLING * np.log2(np.maximum(self.length, 1))).astype(np.int64)
        owner = np.repeat(np.arange(len(self.words)), self.length)
        keys = self.kind[owner] * len(self.vocabulary) + self.number
        order = np.argsort(keys, kind="stable")
        self.kind_word, self.kind_item = keys[order], owner[order]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_map": None}

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word of a text among the items' words; -1 for those that no item has."""
        if not len(self.vocabulary):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    def alike(self, seeds: np.ndarray) -> list[np.ndarray]:
        """``seeds`` (rows) by the kind of their item."""
        kinds = self.kind[self.item[seeds]]
        return [seeds[kinds == k] for k in np.unique(kinds)]

    def reaching(self, seeds: np.ndarray, p: int, numbers: np.ndarray) -> np.ndarray:
        """Those of ``seeds`` (of items of one kind) with an item that has each second word in the passages around ``p``."""
        item, place = self.item[seeds], self.place[seeds]
        length = self.length[item]
        room = length // 2 + 4
        start, end = max(0, p - int((place + room).max())), p + int((length + room - place).max())
        about = np.unique(numbers[start:end])
        keys = self.kind[item[0]] * len(self.vocabulary) + about[about >= 0]
        a, b = np.searchsorted(self.kind_word, keys), np.searchsorted(self.kind_word, keys, side="right")
        held = np.concatenate([self.kind_item[x:y] for x, y in zip(a.tolist(), b.tolist())])
        return seeds[np.bincount(held, minlength=len(self.words))[item] >= LEAST_SCORE * length]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        words = [hashes_of(text) for _, text in rows]
        per_item = [grams(w) for w in words]
        gram = np.concatenate([np.zeros(0, np.uint64), *per_item])
        item = np.repeat(np.arange(len(rows)), [len(g) for g in per_item])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in per_item]])
        order = np.argsort(gram, kind="stable")
        return cls([i for i, _ in rows], words, gram[order], item[order], place[order], np.ones(len(gram), dtype=bool))

    def rare(self, counts: dict[int, int]) -> Items:
        """The seeds with the rarer share of each item marked, by the documents that hold them; those in no document go."""
        n = np.array([counts.get(int(g), 0) for g in self.gram.view(np.int64)], dtype=np.int64)
        order = np.lexsort((self.place, n, self.item))
        order = order[n[order] > 0]
        owner = self.item[order]
        first = np.searchsorted(owner, owner, side="left")
        held = np.searchsorted(owner, owner, side="right") - first
        rarer = np.zeros(len(self.gram), dtype=bool)
        rarer[order[np.arange(len(order)) - first < np.ceil(held * RARE_SHARE)]] = True
        kept = np.sort(order)
        return Items(self.ids, self.words, self.gram[kept], self.item[kept], self.place[kept], rarer[kept])

    def hits(self, words: np.ndarray) -> np.ndarray:
        """The places of ``words`` at which a seed may begin."""
        if self._map is None:
            self._map = np.zeros(1 << MAP_BITS, dtype=bool)
            self._map[(self.gram >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True
        found = grams(words)
        maybe = np.flatnonzero(self._map[(found >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
        at = np.searchsorted(self.gram, found[maybe])
        real = at < len(self.gram)
        real[real] = self.gram[at[real]] == found[maybe[real]]
        return maybe[real]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Score of the best local alignment, and the words of ``passage`` it covers, end exclusive."""
    steps = np.arange(len(passage) + 1) * -GAP
    rows = [np.zeros(len(passage) + 1, dtype=np.int64)]
    for word in item:
        above = rows[-1]
        row = np.zeros_like(above)
        np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        rows.append(np.maximum.accumulate(row + steps) - steps)
    table = np.array(rows)
    best = int(table.max())
    if best < LEAST_SCORE * MATCH * len(item):
        return best / (MATCH * len(item)), 0, 0
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    end = j
    while table[i, j] > 0:
        if table[i, j] == table[i - 1, j - 1] + (MATCH if passage[j - 1] == item[i - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best / (MATCH * len(item)), int(j), int(end)


def best_scores(targets: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Raw score of the best local alignment of each target with its passage, and the word of the passage where it ends;
    all pairs are aligned at once, row by row."""
    # Words are numbered, so that what fills up the shorter ones equals nothing.
    numbers = np.unique(np.concatenate([*targets, *passages]), return_inverse=True)[1]
    lengths = [len(x) for x in (*targets, *passages)]
    parts = np.split(numbers, np.cumsum(lengths)[:-1])
    rows, width = max(lengths[: len(targets)]), max(lengths[len(targets) :])
    own, other = np.full((len(targets), rows), -1, np.int32), np.full((len(targets), width), -2, np.int32)
    for k in range(len(targets)):
        own[k, : lengths[k]] = parts[k]
        other[k, : len(passages[k])] = parts[len(targets) + k]
    steps = np.arange(width + 1, dtype=np.int32) * -GAP
    above = np.zeros((len(targets), width + 1), dtype=np.int32)
    best, ends = np.zeros(len(targets), np.int32), np.zeros(len(targets), np.int64)
    for i in range(rows):
        row = np.zeros_like(above)
        np.maximum(above[:, :-1] + np.where(other == own[:, i : i + 1], MATCH, MISMATCH), above[:, 1:] + GAP, out=row[:, 1:])
        np.maximum(row, 0, out=row)
        above = np.maximum.accumulate(row + steps, axis=1) - steps
        at = above.argmax(axis=1)
        top = above[np.arange(len(at)), at]
        ends[top > best] = at[top > best]
        np.maximum(best, top, out=best)
    return best, ends


def merged(spans: np.ndarray) -> np.ndarray:
    """Columns item, start, end, rarer seed: those of an item that meet become one."""
    order = np.lexsort((spans[1], spans[0]))
    item, start, end, first = spans[:, order]
    # Far enough apart that no item's end reaches the next item's start.
    shift = item * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, start[1:] + shift[1:] > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(item)) - 1
    return np.stack([item[at], start[at], reach[last] - shift[last], np.maximum.reduceat(first, at)])


def passages(words: np.ndarray, items: Items) -> np.ndarray:
    """Columns item, start, end, rarer seed: where ``words`` may hold a copy of an item.

    A seed that many items have leads only to those that can reach the least score there: a match for each second word
    of the item at least, counted by the words that are about.
    """
    hits = items.hits(words)
    found = grams(words)[hits]
    first, last = np.searchsorted(items.gram, found), np.searchsorted(items.gram, found, side="right")
    numbers = items.numbers(words) if (last - first > FEW_ITEMS).any() else None
    spans, held = [np.zeros((4, 0), dtype=np.int64)], 0
    for p, a, b in zip(hits.tolist(), first.tolist(), last.tolist()):
        k = np.arange(a, b)
        if b - a > FEW_ITEMS:
            k = np.concatenate([items.reaching(part, p, numbers) for part in items.alike(k)])
        item = items.item[k]
        length = items.length[item]
        room = length // 2 + 4
        start = p - items.place[k]
        ends = np.minimum(len(words), start + length + room)
        spans.append(np.stack([item, np.maximum(0, start - room), ends, items.first[k]]))
        held += len(k)
        if held > MERGED_AT_ONCE:
            spans = [merged(np.concatenate(spans, axis=1))]
            held = 0
    together = np.concatenate(spans, axis=1)
    return merged(together) if together.shape[1] else together


def scored(words: np.ndarray, items: Items, spans: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Those of ``spans`` that reach the least score, their raw scores and the words where the alignments end, in parts."""
    numbers = items.numbers(words)
    seen = np.zeros(len(items.vocabulary) + 1, dtype=bool)
    part: list[int] = []
    rows = width = 0

    def done() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of = spans[:, part]
        best, ends = best_scores([items.words[i] for i in of[0]], [words[a:b] for a, b in of[1:3].T])
        real = best >= LEAST_SCORE * MATCH * items.length[of[0]]
        return of[:, real], best[real], ends[real] + of[1][real]

    # Pairs of about one size together.
    for k in np.lexsort((spans[2] - spans[1], items.length[spans[0]])).tolist():
        item, start, end = spans[:3, k].tolist()
        own = items.number[items.starts[item] : items.starts[item + 1]]
        seen[numbers[start:end]] = True
        seen[-1] = False
        matches = np.count_nonzero(seen[own])
        seen[numbers[start:end]] = False
        # No alignment matches more words than the passage has of the item's.
        if matches < LEAST_SCORE * len(own):
            continue
        rows, width = max(rows, len(own)), max(width, end - start)
        if part and (len(part) + 1) * width > CELLS_AT_ONCE:
            yield done()
            part, rows, width = [], len(own), end - start
        part.append(k)
    if part:
        yield done()


def copies_in(words: np.ndarray, items: Items) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, end word) of the best copy of each item that a text of ``words`` holds."""
    best: dict[int, tuple[int, int, int]] = {}
    for spans, scores, ends in scored(words, items, passages(words, items)):
        for item, score, end in zip(spans[0].tolist(), scores.tolist(), ends.tolist()):
            if score < best.get(item, (0,))[0]:
                continue
            # An alignment that is worth something covers at most as many words more as it matches, twice over.
            start = max(0, end - 3 * len(items.words[item]))
            _, a, b = align(items.words[item], words[start:end])
            best[item] = max(best.get(item, (0, 0, 0)), (score, -start - a, start + b))
    return [(i, score / (MATCH * len(items.words[i])), -a, b) for i, (score, a, b) in sorted(best.items())]


def holds_copy(words: np.ndarray, items: Items) -> bool:
    """Whether a text of ``words`` holds a copy of any item; the passages that rarer seeds lead to come first."""
    spans = passages(words, items)
    parts = (spans[:, spans[3] > 0], spans[:, spans[3] == 0])
    return any(len(scores) for part in parts for _, scores, _ in scored(words, items, part))


def seed_counts(docs: DataFrame, items: Items) -> dict[int, int]:
    """In how many of all documents each seed occurs; at most a row for each seed comes back."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = hashes_of(text)
                seen.update(np.unique(grams(words)[sent.value.hits(words)].view(np.int64)).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["gram", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row["gram"]: row["n"] for row in counted.collect()}


def item_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, with their seeds."""
    rows = columns(benchmark, ("item_id", "text")).filter(F.col("text").isNotNull())
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    for block in range(blocks):
        of_block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # Fixed by the block's bounds.
        found = sorted(of_block.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        items = Items.of([(r["item_id"], r["text"]) for r in found])
        yield items.rare(seed_counts(docs, items))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, start, end, passage: the best copy of each item in each of ``docs`` that holds one.

    Places count code points.
    """
    schema = "doc_id long, item_id long, score double, start long, end long, passage string"
    docs = columns(docs, ("doc_id", "text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(docs, benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string())
            for batch in batches:
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    copies = copies_in(hashes_of(text), sent.value)
                    # Lower case can have other lengths, so places are taken in the text as it is where it has as many words.
                    spans = word_spans(text) if copies else []
                    for item, score, a, b in copies:
                        start, end = spans[a][0], spans[b - 1][1]
                        rows.append((doc_id, sent.value.ids[item], score, start, end, text[start:end]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                    names=["doc_id", "item_id", "score", "start", "end", "passage"],
                )

        out = out.unionByName(docs.mapInArrow(search, schema))
    return out


def word_spans(text: str) -> list[tuple[int, int]]:
    """Places of the words; those of the lower-cased text where lower case changes the length of a character."""
    low = lowered(text)
    if len(low) == len(text):
        return [m.span() for m in WORD.finditer(low)]
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    if len(origin) != len(low):
        origin = [min(i, len(text) - 1) for i in range(len(low))]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in WORD.finditer(low)]


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a copy of a test item."""
    for items in item_blocks(docs, benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not holds_copy(hashes_of(t), sent.value) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, StructType(docs.schema.fields))
    return docs

"""Periodic runs: stretches of words that repeat with a period at least ``LEAST_EXPONENT`` times, and texts without the repeats.

A run is a stretch with smallest period q (words q apart are the same) that no neighbouring word extends with that period.
Candidates come from Lyndon roots: under one of two orders of the words, the usual and the reversed one, every run holds a
longest Lyndon word of one period that starts at some word, and that word ends where the next smaller suffix starts. Each such
root is extended to both sides by longest common extensions, in constant time from Ukkonen's suffix trees of the stretch and of its
reversal: a common extension is the string depth of the lowest common ancestor of two leaves, the least depth on the Euler
tour between them, looked up in a table of minima over powers of two. The leaves' order also ranks the suffixes.

Trees are only grown where a run can be: in a run of ``LEAST_EXPONENT`` = 4 periods and six words each word comes at least four
times and each three words at least three times, and so do they in any stretch around it. Stretches in which this holds everywhere are
found by counting, again and again until nothing falls away; no run and no word beside a run that continues it lies outside.

Each text is handled as a whole by one task; trees take about 2 KB a word of such a stretch, nothing of the rest of a text.

Defined cases: a null or empty text has no words, no runs and an empty text; any other bytes than ``[\\x20\\x09-\\x0D]`` are
letters of words; words with other bytes are different; repeated rows and repeated or null ``doc_id`` give a row each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.hashing import WHITE_SPACE, scrambled, word_hashes
from cartloom.llm.shared import columns

LEAST_EXPONENT, LEAST_WORDS = 4, 6
# How often each word and each ``GRAM`` words of a run come in it, at least.
WORD_TIMES, GRAM, GRAM_TIMES = 4, 3, 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class SuffixTree:
    """Ukkonen's suffix tree of whole numbers from 1 to ``largest`` and an end mark, with its Euler tour.

    ``rank`` is the place of each suffix among all in order, the end mark being smallest.
    """

    def __init__(self, numbers: list[int], largest: int):
        self.text, self.symbols = [*numbers, 0], largest + 1
        self.starts, self.ends, self.edges = self._grow()
        leaves, gaps = self._tour(0)
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        # Least depths over 1, 2, 4, ... neighbouring gaps between leaves.
        self.minima = [gaps]
        while 2 ** len(self.minima) <= len(gaps):
            last, half = self.minima[-1], 2 ** (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _grow(self) -> tuple[list[int], list[int], dict[int, int]]:
        text, symbols, n = self.text, self.symbols, len(self.text)
        starts, ends, links, edges = [0], [0], [0], {}
        node, edge, length, pending = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            pending += 1
            open_link = 0
            while pending:
                if not length:
                    edge = i
                key = node * symbols + text[edge]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(starts)
                    starts.append(i), ends.append(n), links.append(0)
                    if open_link:
                        links[open_link], open_link = node, 0
                else:
                    first = starts[below]
                    along = min(ends[below], i + 1) - first
                    if length >= along:
                        node, edge, length = below, edge + along, length - along
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if open_link:
                            links[open_link] = node
                        break
                    split = len(starts)
                    edges[key], edges[split * symbols + symbol] = split, split + 1
                    starts += (first, i)
                    ends += (first + length, n)
                    links += (0, 0)
                    starts[below] = first + length
                    edges[split * symbols + text[first + length]] = below
                    if open_link:
                        links[open_link] = split
                    open_link = split
                pending -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        return starts, ends, edges

    def _tour(self, end_mark: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order of the leaves, and the depths of the lowest common ancestors of neighbouring leaves.

        ``end_mark`` 0 makes it the smallest symbol, -1 the largest.
        """
        keys = np.fromiter(self.edges.keys(), dtype=np.int64, count=len(self.edges))
        nodes = np.fromiter(self.edges.values(), dtype=np.int64, count=len(self.edges))
        parents, symbols = np.divmod(keys, self.symbols)
        order = np.argsort(parents * self.symbols + (symbols + end_mark) % self.symbols)
        bounds = np.searchsorted(parents[order], np.arange(len(self.starts) + 1)).tolist()
        children, lengths = nodes[order].tolist(), (np.array(self.ends) - np.array(self.starts)).tolist()
        following, last = bounds[:-1], bounds[1:]
        depths, path, tour, leaf_at = [0] * len(lengths), [0], [], []
        while path:
            node = path[-1]
            at = following[node]
            if at < last[node]:
                tour.append(depths[node])
                following[node] = at + 1
                child = children[at]
                depths[child] = depths[node] + lengths[child]
                path.append(child)
            else:
                if lengths[node] and bounds[node] == last[node]:
                    leaf_at.append(len(tour))
                    tour.append(depths[node])
                path.pop()
        tour, leaf_at = np.array(tour), np.array(leaf_at)
        # Between two leaves the tour turns at their lowest common ancestor, its least depth there.
        return len(self.text) - tour[leaf_at], np.minimum.reduceat(tour, leaf_at[:-1] + 1) if len(leaf_at) > 1 else tour[:0]

    def reversed_rank(self) -> np.ndarray:
        """The place of each suffix if the order of the symbols is reversed, the end mark still being smallest."""
        leaves, _ = self._tour(-1)
        rank = np.empty(len(leaves), dtype=np.int64)
        rank[leaves[::-1]] = np.arange(len(leaves))
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b``, different ones, have in common, pair by pair."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(float))[1] - 1
        found = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - 2**k])
        return found


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word from each place ends: at the next smaller suffix."""
    rank = rank.tolist()
    n = len(rank) - 1
    ends = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        j, own = i + 1, rank[i]
        while j < n and rank[j] > own:
            j = ends[j]
        ends[i] = j
    return np.array(ends[:n], dtype=np.int64)


def runs_in(numbers: list[int], largest: int) -> np.ndarray:
    """(start, length, period) of every run of at least two periods, by start and period; numbers from 1 to ``largest``."""
    n = len(numbers)
    forward, backward = SuffixTree(numbers, largest), SuffixTree(numbers[::-1], largest)
    found = []
    for rank in (forward.rank, forward.reversed_rank()):
        starts, ends = np.arange(n), lyndon_ends(rank)
        left = backward.common(n - starts, n - ends)
        length = left + ends - starts + forward.common(starts, ends)
        found.append(np.stack([starts - left, length, ends - starts], axis=1)[length >= 2 * (ends - starts)])
    both = np.unique(np.concatenate(found), axis=0)
    return both[np.lexsort((both[:, 2], both[:, 0]))]


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the stretches that may hold runs: each word and each few words in them come often enough in them."""
    done, todo = [], [(0, len(words))]
    while todo:
        start, end = todo.pop()
        if end - start < LEAST_WORDS:
            continue
        _, numbers, times = np.unique(words[start:end], return_inverse=True, return_counts=True)
        often = times[numbers] >= WORD_TIMES
        good = often[: len(often) - GRAM + 1].copy()
        gram = numbers[: len(good)].astype(np.uint64)
        for k in range(1, GRAM):
            good &= often[k : len(good) + k]
            # Different ones that share a number only make a stretch too long.
            gram = scrambled(gram) + numbers[k : len(good) + k].astype(np.uint64)
        at = np.flatnonzero(good)
        if len(at):
            _, same, times = np.unique(gram[at], return_inverse=True, return_counts=True)
            good[at[times[same] < GRAM_TIMES]] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).view(np.int8)))
        parts = [(start + int(a), start + int(b) + GRAM - 1) for a, b in zip(edges[::2], edges[1::2])]
        if parts == [(start, end)]:
            done.append((start, end))
        else:
            todo += parts
    return sorted(done)


def text_runs(data: bytes) -> tuple[np.ndarray, bytes]:
    """The runs of a text that count, and its words, joined by one space, without those after the first period of a run."""
    words, runs = data.split(), []
    for start, end in stretches(word_hashes(data, WHITE_SPACE)):
        numbers: dict[bytes, int] = {}
        found = runs_in([numbers.setdefault(w, len(numbers) + 1) for w in words[start:end]], len(numbers))
        runs.append(found + [start, 0, 0])
    found = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
    found = found[found[:, 1] >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * found[:, 2])]
    if len(found):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
    return found, b" ".join(words)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, texts = [], []
        for text in batch.column(1):
            found, collapsed = text_runs(text.as_buffer().to_pybytes() if text.is_valid else b"")
            runs.append(found)
            texts.append(collapsed)
        ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
        all_ = np.concatenate([np.zeros((0, 3), dtype=np.int64), *runs])
        parts = [pa.array(np.ascontiguousarray(all_[:, i])) for i in range(3)]
        lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
        collapsed = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, collapsed], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start and period) and the collapsed text of every row."""
    rows = columns(docs, ("doc_id", "text"))
    return rows.mapInArrow(_found, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string")


def greatest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as fractions, the first of equal ones; NULL without runs."""
    better = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document by the crc32 h of its number repeats a root of words from some word on.

    With g = h / 10 and n words, word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    rows = columns(docs, ("doc_id", "text")).withColumns({"g": F.floor(h / 10), "words": F.when(h % 10 == 0, split)})
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, (F.col("g") % F.nullif(n, F.lit(0))).cast("int")))
    rest = n - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    root = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(root, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), repeated)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))

"""Benchmark decontamination by SimHash windows.

An item of n words is looked for in every window of n words of every text. Words
are lower-cased A-Z; a window is weighed by its shingles of five words (each with
its count). Two windows match if their weighted Jaccard similarity (shared over
joint counts) is 0.8 or more.

1. A text in which no item shingle occurs can't match anything; the others keep
   only the places within an item's length of one that does. This loses nothing.
2. Each window there of the size of an item that holds one of its shingles gets
   a SimHash of 64 bits over its weighted shingles, from running sums, so a window
   costs the same whatever its length. Long regions are summed in pieces.
3. Items are indexed by four blocks of 16 bits, each under every value within two
   bits of its own, and a window is looked up under every value within two bits of
   its own: any window within 19 bits of an item has a block within four, which
   meets it so, surely.
4. What lies within ``RADIUS`` is verified by the exact weighted similarity; the
   best window of each text and item is reported.
5. A window may match and still be further off, where few shingles weigh much or
   by chance. So the items of which the places around hold enough shingles are
   counted: each of their windows that step 4 hasn't looked at and that has as
   many places with one of the item's shingles as a match needs is verified
   alike. A match has no fewer, so this loses nothing.
6. A text of fewer words than an item is one window, of all its words. Items are
   found for it by counting the shingles that they hold of it, without SimHash,
   and verified alike: this loses nothing.

At a similarity of 0.8 about 10 bits of 64 are expected to differ, 19 are three
standard deviations off: of 24,460 random pairs of 14 to 300 words at 0.8 and
more, one was further apart and left to step 5. Items shorter than a shingle are one shingle of all
their words and match exactly.

The item index is what tasks share: about 2.2 KB an item and 16 bytes a shingle,
so some 65 MB for ``ITEMS_TOGETHER`` items of 60 words. Larger benchmarks are
looked up in turns, cut so that no turn has more than ``WORDS_TOGETHER``
words either: each turn's findings are kept as Parquet before the next turn's
items are read, so driver and tasks hold one index at a time.

Null or empty texts and items match nothing. Repeated rows are judged each.
Ties: the first window. Empty tables: empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed
from tidemark.llm.wordhash import Run, mix, word_runs

SHINGLE = 5
PERCENT = 80
RADIUS = 19
BLOCKS = 4
#: Bits by which an index entry, and a value looked up, differ from the block itself at most.
NEAR = 2
#: Items, and their words, whose index is held by a task at once (a longer item goes alone).
ITEMS_TOGETHER = 20_000
WORDS_TOGETHER = 4_000_000
#: Shingles of a text whose signs are summed at once.
SUMMED = 1 << 16
#: Windows looked up at once.
LOOKED_UP = 1 << 9
#: Bits of the table that tells which shingles may be an item's.
SIEVE = 22

LEAKS = "doc_id bigint, item_id bigint, similarity double, start bigint, words bigint"


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i in range(size if len(total) else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i]
    return mix(total + np.uint64(size))


def _signs(grams: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each gram's hash."""
    bits = np.unpackbits(mix(grams ^ np.uint64(0x1234567)).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).reshape(-1, 8).view(np.uint64).ravel()


@dataclass
class Item:
    item_id: int
    words: int
    grams: np.ndarray
    counts: np.ndarray


class Index:
    """The items of a benchmark by shingle and by SimHash block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[Item] = []
        prints = []
        for run in word_runs(pa.array([t for _, t in items], pa.string()), fold=True):
            for k in range(len(run.bounds) - 1):
                h = run.hashes[run.upto[k] : run.upto[k + 1]]
                if len(h):
                    grams = _grams(h, min(SHINGLE, len(h)))
                    self.items.append(Item(items[run.first + k][0], len(h), *np.unique(grams, return_counts=True)))
                    prints.append(_packed(_signs(grams).sum(0, dtype=np.int64)[None])[0])
        self.prints = np.array(prints, np.uint64)
        flips = [0] + [sum(1 << b for b in c) for n in range(1, NEAR + 1) for c in combinations(range(16), n)]
        flips = self.flips = np.array(flips, np.uint64)
        self.entries = []
        for b in range(BLOCKS):
            value = (self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)
            at = (value[:, None] ^ flips).ravel().astype(np.int64)
            order = np.argsort(at, kind="stable")
            self.entries.append((np.append(0, np.cumsum(np.bincount(at, minlength=1 << 16))), np.repeat(np.arange(len(prints)), len(flips))[order].astype(np.int32)))
        self.sizes = sorted({i.words for i in self.items})
        self.short = sorted({n for n in self.sizes if n < SHINGLE})
        known = np.concatenate([np.zeros(0, np.uint64), *(i.grams for i in self.items)])
        self.known, which = np.unique(known, return_inverse=True)
        #: Of each known shingle the items that have it, and of each item the words and shingles.
        order = np.argsort(which, kind="stable")
        self.holders = np.repeat(np.arange(len(self.items)), [len(i.grams) for i in self.items])[order].astype(np.int32)
        self.held = np.concatenate([np.zeros(0, np.int64), *(i.counts for i in self.items)])[order].astype(np.int32)
        self.held_from = np.append(0, np.cumsum(np.bincount(which, minlength=len(self.known))))
        self.words = np.array([i.words for i in self.items], np.int64)
        self.totals = np.array([i.counts.sum() for i in self.items], np.int64)
        #: Shingles that a window of an item's size shares with it, at least, if they match.
        self.least = -(-2 * PERCENT * self.totals // (100 + PERCENT))
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[(self.known >> np.uint64(64 - SIEVE)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Positions of grams that some item has."""
        at = np.flatnonzero(self.sieve[(grams >> np.uint64(64 - SIEVE)).astype(np.int64)])
        if len(at) and len(self.known):
            at = at[self.known[np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)] == grams[at]]
        return at

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS bits, by way of the blocks."""
        found = [np.zeros(0, np.int64)]
        for low in range(0, len(prints), LOOKED_UP):
            some = prints[low : low + LOOKED_UP]
            for b, (upto, held) in enumerate(self.entries):
                value = (((some >> np.uint64(16 * b)) & np.uint64(0xFFFF))[:, None] ^ self.flips).astype(np.int64)
                size = upto[value + 1] - upto[value]
                w = np.repeat(np.arange(len(some)), size.sum(1))
                size, first = size.ravel(), upto[value].ravel()
                i = held[np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())]
                ok = np.bitwise_count(some[w] ^ self.prints[i]) <= RADIUS
                found.append((w[ok] + low) * len(self.items) + i[ok])
        pairs = np.unique(np.concatenate(found))
        return pairs // max(1, len(self.items)), pairs % max(1, len(self.items))

    def search(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item_id, similarity, start, words) of the best window for each item of a text."""
        best: dict[int, tuple[float, int]] = {}
        for size in self.short:
            for at in self.hits(_grams(words, size)):
                best_here = _grams(words[at : at + size], size)
                for k, item in enumerate(self.items):
                    if item.words == size and item.grams[0] == best_here[0]:
                        best.setdefault(k, (1.0, int(at)))
        grams = _grams(words, SHINGLE)
        hits = self.hits(grams)
        longest = self.sizes[-1] if self.sizes else 0
        if len(hits):
            cuts = np.flatnonzero(np.diff(hits) > longest) + 1
            for group in np.split(hits, cuts):
                low, high = max(0, int(group[0]) - longest), min(len(words), int(group[-1]) + SHINGLE + longest)
                self._region(words, grams, low, high, group, best)
            if len(words) < longest:
                self._whole(words, grams, hits, best)
        return [(self.items[k].item_id, s, at, min(self.items[k].words, len(words))) for k, (s, at) in sorted(best.items())]

    def _whole(self, words: np.ndarray, grams: np.ndarray, hits: np.ndarray, best: dict) -> None:
        """A text as the one window for the items that are longer than it."""
        shared = np.zeros(len(self.items), np.int64)
        for k in np.searchsorted(self.known, grams[hits]):
            shared[self.holders[self.held_from[k] : self.held_from[k + 1]]] += 1
        for k in np.flatnonzero((self.words > len(words)) & (100 * shared >= PERCENT * self.totals)):
            s = _similar(self.items[k], grams)
            if 100 * s >= PERCENT:
                best[int(k)] = (s, 0)

    def _region(self, words: np.ndarray, grams: np.ndarray, low: int, high: int, hits: np.ndarray, best: dict) -> None:
        """Windows with a hit in shingles low..high, of the sizes of the items that hold one, piece by piece."""
        longest = self.sizes[-1]
        for start in range(low, max(low + 1, high - SHINGLE + 1), SUMMED):
            stop = min(high - SHINGLE + 1, start + SUMMED + longest)
            here = hits[(hits >= start) & (hits < stop)]
            if len(here):
                self._piece(grams[start:stop], start, here - start, SUMMED, best)

    def _piece(self, own: np.ndarray, low: int, hits: np.ndarray, most: int, best: dict) -> None:
        at = np.searchsorted(self.known, own[hits])
        known, often = np.unique(at, return_counts=True)
        first, size = self.held_from[known], self.held_from[known + 1] - self.held_from[known]
        entries = np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        holders, which = np.unique(self.holders[entries], return_inverse=True)
        shared = np.bincount(which, np.minimum(self.held[entries], np.repeat(often, size)))
        sums = np.zeros((len(own) + 1, 64), np.int32)
        np.cumsum(_signs(own), axis=0, out=sums[1:])
        found = np.append(0, np.cumsum(np.bincount(hits, minlength=len(own))))
        looked: dict[int, set[int]] = {}
        for size in np.unique(self.words[holders]).tolist():
            n = size - SHINGLE + 1
            if n < 1 or len(own) < n:
                continue
            starts = np.flatnonzero(found[n:] > found[:-n])
            starts = starts[starts < most]
            windows, items = self.near(_packed(sums[starts + n] - sums[starts]))
            ok = self.words[items] == size
            for w, k in zip(windows[ok].tolist(), items[ok].tolist(), strict=True):
                looked.setdefault(k, set()).add(int(starts[w]))
                self._judge(k, own, int(starts[w]), low, best)
        for k in holders[shared >= self.least[holders]].tolist():
            n = int(self.words[k]) - SHINGLE + 1
            if n < 1 or len(own) < n:
                continue
            mine = np.append(0, np.cumsum(np.bincount(hits[np.isin(own[hits], self.items[k].grams)], minlength=len(own))))
            starts = np.flatnonzero(mine[n:] - mine[:-n] >= self.least[k])
            for w in starts[starts < most].tolist():
                if w not in looked.get(k, ()):
                    self._judge(k, own, w, low, best)

    def _judge(self, k: int, own: np.ndarray, at: int, low: int, best: dict) -> None:
        """Verify the window at a place of a piece for an item."""
        s = _similar(self.items[k], own[at : at + int(self.words[k]) - SHINGLE + 1])
        if 100 * s >= PERCENT and (k not in best or (-s, low + at) < (-best[k][0], best[k][1])):
            best[k] = (s, low + at)


def _similar(item: Item, grams: np.ndarray) -> float:
    """Shared over joint counts of shingles."""
    own, counts = np.unique(grams, return_counts=True)
    at = np.minimum(np.searchsorted(item.grams, own), len(item.grams) - 1)
    shared = int(np.minimum(np.where(item.grams[at] == own, item.counts[at], 0), counts).sum())
    return shared / (int(item.counts.sum()) + len(grams) - shared)


def _texts(run: Run) -> Iterator[tuple[int, np.ndarray]]:
    for k in range(len(run.bounds) - 1):
        yield run.first + k, run.hashes[run.upto[k] : run.upto[k + 1]]


def _turns(benchmark: DataFrame) -> Iterator[tuple[Index, bool]]:
    """Indices of some items, one after the other, and whether it is the only one."""
    held: list[tuple[int, str]] = []
    words = turns = 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null").toLocalIterator():
        n = text.count(" ") + 1
        if held and (len(held) == ITEMS_TOGETHER or words + n > WORDS_TOGETHER):
            yield Index(held), False
            held, words, turns = [], 0, turns + 1
        held.append((item, text))
        words += n
    if held:
        yield Index(held), not turns


def _candidates(index: Index, run: Run) -> np.ndarray:
    """Texts of a run that hold an item's shingle."""
    marked = np.zeros(len(run.bounds) - 1, bool)
    for size in {SHINGLE, *index.short}:
        at = index.hits(_grams(run.hashes, size))
        marked[np.searchsorted(run.upto, at, "right") - 1] = True
    return marked


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each text and item that it holds: doc_id, item_id, similarity, start, words."""
    sc = docs.sparkSession.sparkContext
    out = None
    for index, alone in _turns(benchmark):
        shared = sc.broadcast(index)
        del index

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for run in word_runs(batch.column(1), fold=True):
                    marked = _candidates(shared.value, run)
                    rows.extend((ids[i], *found) for i, words in _texts(run) if marked[i - run.first] for found in shared.value.search(words))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.float64() if k == 2 else pa.int64()) for k in range(5)], ["doc_id", "item_id", "similarity", "start", "words"])

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, LEAKS)
        if not alone:
            found = checkpointed(found)
            shared.destroy()
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], LEAKS) if out is None else out


def _leaking(shared: Broadcast) -> Callable:
    """A column function: does a text hold an item of the index?"""

    @F.arrow_udf("boolean")
    def leaking(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), bool)
        for run in word_runs(texts, fold=True):
            marked = _candidates(shared.value, run)
            for i, words in _texts(run):
                out[i] = marked[i - run.first] and bool(shared.value.search(words))
        return pa.array(out)

    return leaking


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, columns unchanged."""
    sc, key, found = docs.sparkSession.sparkContext, [F.xxhash64("text").alias("__x"), F.xxhash64(F.lit(1), "text").alias("__y")], None
    for index, alone in _turns(benchmark):
        shared = sc.broadcast(index)
        del index
        leaking = _leaking(shared)(F.col("text"))
        if alone:
            return docs.filter(~leaking)
        texts = checkpointed(docs.select("text").filter(leaking).select(*key).distinct())
        shared.destroy()
        found = texts if found is None else found.unionAll(texts)
    return docs if found is None else docs.select("*", *key).join(found.distinct(), ["__x", "__y"], "left_anti").select(*docs.columns)


def op9_decontaminate(spark, sf_dir):
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

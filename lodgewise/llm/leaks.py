"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact weighted similarity."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from lodgewise.llm.common import plain_docs, released, slices
from lodgewise.llm.words import shingles, words

_BLOCKS = 8  # of 8 bits each
SLICE = 1 << 20  # bytes of text at once: each takes about 50 bytes of memory
_SPAN = 4096  # places of a text whose windows get their fingerprints at once: each takes about 2 KB of memory


class Weights:
    """log(1 + N / f) of each shingle: N items in the whole benchmark, f of them hold it (what none holds counts as f = 1).

    Only shingles of several items are kept; all others have the same weight.
    """

    def __init__(self, n_items: int, known: np.ndarray, frequency: np.ndarray):
        order = np.argsort(known)
        few, at = np.unique(frequency[order], return_inverse=True)
        self.known, self.weight = known[order], np.array([math.log(1 + n_items / f) for f in few.tolist()])[at]
        self.default = math.log(1 + n_items) if n_items else 1.0

    def of(self, run: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(run), self.default)
        at = np.minimum(np.searchsorted(self.known, run), len(self.known) - 1)
        return np.where(self.known[at] == run, self.weight[at], self.default)

    def total(self, bag: Counter) -> float:
        return sum(w * c for w, c in zip(self.of(np.array([*bag], np.uint64)).tolist(), bag.values(), strict=True))


class Items:
    """Benchmark items as shingles with fingerprints, and the index of their fingerprints' blocks."""

    def __init__(self, ids: list, texts: list[str], size: int, radius: int, weights: Weights):
        prints, _, _, first = words(pa.array(texts, pa.string()))
        found, at = shingles(prints, first, size)
        counts = np.diff(first)
        keep = np.flatnonzero(counts > 0)
        self.size, self.radius = size, radius
        self.ids, self.words = [ids[i] for i in keep], counts[keep]
        self.bags = [Counter(found[at[i] : at[i + 1]].tolist()) for i in keep]
        self.totals = [weights.total(bag) for bag in self.bags]
        holders: dict[int, set[int]] = {}
        for bag, n in zip(self.bags, self.words, strict=True):
            for s in bag:
                holders.setdefault(s, set()).add(int(n))
        self.lengths_of = holders
        self.known = np.array(sorted(holders), np.uint64)
        self.by_length = {int(n): np.flatnonzero(self.words == n) for n in np.unique(self.words)}
        self.prints = np.array([simhash(np.array(list(b.elements()), np.uint64), np.array([len(list(b.elements()))]), weights)[0] for b in self.bags], np.uint64)
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= radius // _BLOCKS
        # index[n][block][value]: which items of n words have a block within radius // 8 bits of the value
        self.index = {
            n: np.stack([near[(self.prints[own] >> np.uint64(8 * b)).astype(np.uint8)].T for b in range(_BLOCKS)]) for n, own in self.by_length.items()
        }

    def near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all fingerprints within the radius: one of their blocks agrees but for radius // 8 bits."""
        own = self.by_length[n]
        hit = np.zeros((len(prints), len(own)), bool)
        for b in range(_BLOCKS):
            hit |= self.index[n][b][(prints >> np.uint64(8 * b)).astype(np.uint8)]
        window, item = np.nonzero(hit)
        distance = np.bitwise_count(prints[window] ^ self.prints[own[item]])
        good = distance <= self.radius
        return window[good], own[item[good]], distance[good]

    def similarity(self, bag: Counter, item: int, weights: Weights) -> float:
        other = self.bags[item]
        both = weights.total(Counter({s: min(c, other[s]) for s, c in bag.items() if s in other}))
        return both / (weights.total(bag) + self.totals[item] - both)


def simhash(run: np.ndarray, size: np.ndarray | int, weights: Weights, starts: np.ndarray | None = None) -> np.ndarray:
    """Fingerprints of the windows of `size` shingles of `run` that begin at `starts` (default: the first)."""
    starts = np.zeros(1, np.int64) if starts is None else starts
    signs = ((run[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64) * 2 - 1
    sums = np.concatenate([np.zeros((1, 64)), np.cumsum(np.rint(signs * weights.of(run)[:, None] * 1024), axis=0)])
    bits = (sums[starts + size] - sums[starts]) >= 0
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _search(items: Items, weights: Weights, column: pa.Array, least: float) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(text, item, first word, words, distance, similarity): the best window of each text and item, the earliest of equal ones."""
    prints, _, _, first = words(column)
    short = [n for n in items.by_length if n < items.size]
    for size, lengths in [(items.size, [n for n in items.by_length if n >= items.size]), *((n, [n]) for n in short)]:
        found, at = shingles(prints, first, size)
        if not len(found) or not lengths:
            continue
        place = np.minimum(np.searchsorted(items.known, found), len(items.known) - 1)
        hits = np.flatnonzero(items.known[place] == found)
        owner = np.searchsorted(at, hits, side="right") - 1
        for text in np.unique(owner).tolist():
            here = hits[owner == text] - at[text] if len(hits) < 1000 else hits[np.searchsorted(owner, text) : np.searchsorted(owner, text, side="right")] - at[text]
            run = found[at[text] : at[text + 1]]
            wanted = {n for p in here.tolist() for n in items.lengths_of[int(run[p])]} & set(lengths)
            best: dict = {}
            for n in sorted(wanted):
                width = min(max(n - size + 1, 1), len(run))
                marks = np.zeros(len(run) + 1, np.int64)  # windows that hold a shingle of the benchmark; the others have no similarity
                np.add.at(marks, np.maximum(here - width + 1, 0), 1)
                np.add.at(marks, here + 1, -1)
                starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                starts = starts[starts + width <= len(run)]
                while len(starts):
                    some, starts = np.split(starts, [np.searchsorted(starts, starts[0] + _SPAN)])
                    low, high = int(some[0]), int(some[-1]) + width
                    window, item, distance = items.near(simhash(run[low:high], width, weights, some - low), n)
                    for w, i, d in zip(window.tolist(), item.tolist(), distance.tolist(), strict=True):
                        start = int(some[w])
                        s = items.similarity(Counter(run[start : start + width].tolist()), i, weights)
                        rank = (s, -start)
                        if s >= least and (items.ids[i] not in best or rank > best[items.ids[i]][0]):
                            best[items.ids[i]] = rank, (text, i, start, min(n, int(first[text + 1] - first[text])), d, s)
            yield from (v for _, v in best.values())


def _weights(given: DataFrame, size: int) -> Weights:
    """Items that hold each shingle, counted over the whole benchmark; the null shingle counts the items with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            prints, _, _, first = words(batch.column("text"))
            found, at = shingles(prints, first, size)
            own = [np.unique(found[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
            shingle, n = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *shingle.view(np.int64).tolist()], pa.int64()), pa.array([sum(len(s) > 0 for s in own), *n.tolist()], pa.int64())], ["shingle", "n"]
            )

    counts = given.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    got = counts.filter("shingle IS NULL OR n > 1").toArrow()
    shingle, n = got.column("shingle").combine_chunks(), np.asarray(got.column("n"), dtype=np.int64)
    real = np.asarray(shingle.is_valid())
    return Weights(int(n[~real].sum()), np.asarray(shingle.drop_null(), dtype=np.int64).view(np.uint64), n[real])


def _shared(benchmark: DataFrame, size: int, radius: int, item_bytes: int) -> Iterator[tuple[Broadcast, Broadcast]]:
    """The items as broadcast values of about `item_bytes` of text each, all with the weights of the whole benchmark."""
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // item_bytes))
    weights = _weights(given, size)
    common = benchmark.sparkSession.sparkContext.broadcast(weights)
    for i in range(passes):
        part = given.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Items([r["item_id"] for r in part], [r["text"] for r in part], size, radius, weights)), common


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.75, radius: int = 28, item_bytes: int = 16 << 20) -> DataFrame:
    """One row per row of `docs` and benchmark item found in it: doc_id, item_id, start_word, n_words, distance, similarity.

    Windows of as many words as an item slide over whole texts, word by word (a shorter text is one window); those
    that share a shingle with any item get a 64-bit SimHash of their weighted shingles. All items within `radius`
    bits come from an index of 8 blocks: at that distance one block differs by at most radius // 8 bits. Windows and
    items whose weighted Jaccard similarity reaches `least` are reported, the best window of each item. At a
    similarity of 0.75 the mean distance is 11 bits, and 28 is more than four standard deviations above it.

    Items are broadcast `item_bytes` of text at a time; a larger benchmark takes more passes over the documents, with
    the same rows as one pass: weights come from counts over the whole benchmark.
    Null or empty texts and items have no windows; equal item ids count as one item with its best window; repeated
    documents are reported each; null ids stay null.
    """
    out, rows = None, plain_docs(docs)
    schema = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"
    for shared, common in _shared(benchmark, size, radius, item_bytes):

        def run(batches: Iterator[pa.RecordBatch], shared=shared, common=common) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in slices(batches, limit=SLICE):
                found = list(_search(items, common.value, batch.column("text"), least)) if items.bags else []
                if found:
                    text, item, start, n, distance, similarity = zip(*found, strict=True)
                    arrays = [batch.column("doc_id").take(pa.array(text)), pa.array([items.ids[x] for x in item], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(distance, pa.int32()), pa.array(similarity, pa.float64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"])
            released()

        once = rows.mapInArrow(run, schema)
        out = once if out is None else out.unionByName(once)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, least: float = 0.75, radius: int = 28, item_bytes: int = 16 << 20) -> DataFrame:
    """The rows of `docs`, with all their columns, in which `find_leaks` finds no item."""
    for shared, common in _shared(benchmark, size, radius, item_bytes):

        def run(batches: Iterator[pa.RecordBatch], shared=shared, common=common) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in slices(batches, limit=SLICE):
                clean = np.ones(batch.num_rows, bool)
                if items.bags:
                    clean[[x[0] for x in _search(items, common.value, pc.fill_null(batch.column("text"), ""), least)]] = False
                yield batch.filter(pa.array(clean))
            released()

        docs = docs.mapInArrow(run, docs.schema)
    return docs

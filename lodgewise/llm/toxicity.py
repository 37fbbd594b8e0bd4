"""Toxicity scores by weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lodgewise.llm.common import Chunks, Kept, plain_docs, released, slices, written

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6)
SLICE = 2 << 20  # bytes of text at once
SEEDS = ("idiot", "stupid", "moron", "pathetic", "worthless", "disgusting", "scum", "trash", "loser", "clown", "hate")
_SEED_WEIGHT = 3.0  # what a seed counts before any evidence
#: Votes of surface patterns, each with what it looks for.
PATTERNS = {
    "insult after you": re.compile(r"\byou(?:'re| are)? (?:an? |such an? )?(?:%s)\b" % "|".join(SEEDS), re.I),
    "shouting": re.compile(r"(?:\b[A-Z]{4,}\b[ ,]+){3}"),
    "many marks": re.compile(r"[!?]{3}"),
    "masked word": re.compile(r"\b[A-Za-z]+[*#@$]{2,}[A-Za-z]*\b"),
}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def terms_of(word: str) -> list[str]:
    """The word and its beginnings (marked by a star), in small letters."""
    return [word, *(f"{word[:n]}*" for n in _PREFIXES if len(word) > n)]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    voters: list[str] = field(default_factory=list)
    accuracy: np.ndarray | None = None  # of each voter: P(toxic | it votes)
    correlation: np.ndarray | None = None  # of the voters' votes within a class


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row, accuracy of each voter, correlations between voters.

    `votes` is rows x voters of 0 and 1, `start` a first guess of the posterior. A voter votes with one chance
    in each class; what a voter says counts less the more it repeats others: its evidence is divided by one plus
    its correlations of over 0.3 with them inside the classes.
    """
    posterior, n = start.astype(float), votes.shape[0]
    correlation = np.eye(votes.shape[1])
    for _ in range(rounds):
        mass = np.array([(1 - posterior).sum(), posterior.sum()])
        prior = (mass + 1) / (n + 2)
        hit1 = (posterior @ votes + 0.1) / (mass[1] + 0.2)
        hit0 = ((1 - posterior) @ votes + 0.1 * votes.mean(axis=0) + 1e-6) / (mass[0] + 0.2)
        rest = votes - np.outer(posterior, hit1) - np.outer(1 - posterior, hit0)
        spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
        correlation = (rest.T @ rest) / n / np.outer(spread, spread)
        share = 1 / np.where(correlation > 0.3, correlation, 0).sum(axis=1).clip(1)
        given = share * np.log(hit1 / hit0)
        silent = share * np.log((1 - hit1).clip(1e-6) / (1 - hit0).clip(1e-6))
        odds = np.log(prior[1] / prior[0]) + votes @ given + (1 - votes) @ silent
        posterior = 1 / (1 + np.exp(-odds.clip(-30, 30)))
    mass1, mass0 = posterior @ votes, (1 - posterior) @ votes
    return posterior, (mass1 + 0.5) / (mass1 + mass0 + 1), correlation


def _times(x: np.ndarray, w: np.ndarray, step: int = 1024) -> np.ndarray:
    """x @ w a block of rows at a time: numpy widens a matrix of short floats whole, twice its size."""
    return np.concatenate([x[i : i + step] @ w for i in range(0, max(len(x), 1), step)])


def linear(x: np.ndarray, target: np.ndarray, start: np.ndarray, steps: int = 400, rate: float = 2.0, penalty: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient steps with momentum, drawn towards `start`; both classes weigh the same."""
    w, b, mw, mb = start.astype(np.float64), 0.0, np.zeros(x.shape[1]), 0.0
    weigh = target / max(target.sum(), 1e-9) + (1 - target) / max((1 - target).sum(), 1e-9)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(_times(x, w) + b).clip(-30, 30)))
        error = weigh * (p - target) / 2
        mw, mb = 0.9 * mw + error.astype(x.dtype) @ x + penalty * (w - start), 0.9 * mb + error.sum()
        w, b = w - rate * mw, b - rate * mb
    return w, b


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, max_terms: int = 1000, max_voters: int = 60) -> Model:
    """Fit on at most `max_rows` labelled rows outside the held-out fold (those with the smallest hash of their id).

    Voters: terms that mark toxic rows, the seed lexicon, and PATTERNS; the human label is one more voter, not the
    truth. A term counts if its log-likelihood ratio exceeds the logarithm of the number of terms, so that about one
    would by chance; of rows with one label and the same set of words (copies) only one takes part, or
    every word of a copied text would look like evidence. The classifier learns the label model's posterior from at most `max_terms` terms. A doc_id with several labels counts as toxic if one of them is 1. Without labels of both
    classes the seed lexicon decides alone.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("_y"))
    sample = ids.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    labelled = plain_docs(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    hashes = F.transform(F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+")), lambda w: F.xxhash64(w))
    same = F.xxhash64(F.array_sort(hashes)).alias("_same")
    once = labelled.select("_id", "_y", same).groupBy("_same", "_y").agg(F.min("_id").alias("_id")).select("_id", "_y").distinct()
    once = written(once, "sample")
    rows = plain_docs(docs).join(F.broadcast(once), F.col("doc_id") == F.col("_id")).select("text", "_y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        n = Counter()
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("_y").to_pylist(), strict=True):
                n[y] += 1
                seen[y].update({t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)})
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([*terms, ""], pa.string()), *(pa.array([*(seen[y][t] for t in terms), n[y]], pa.int64()) for y in (0, 1))],
            ["term", "n0", "n1"],
        )

    counts = rows.mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = written(counts.filter("n0 + n1 >= 3 OR term = ''"), "terms")
    total = counts.filter("term = ''").collect()
    all0, all1 = (total[0]["n0"], total[0]["n1"]) if total else (0, 0)
    if not all0 or not all1:
        return Model({t: 4.0 for t in SEEDS}, -2.0, list(SEEDS))
    share, n = all1 / (all0 + all1), F.col("n0") + F.col("n1")
    ratio = sum(F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * F.lit(p)))).otherwise(0.0) for c, p in (("n1", share), ("n0", 1 - share)))
    signed = F.when(F.col("n1") > n * F.lit(share), ratio).otherwise(-ratio)
    best = counts.filter("term <> ''").withColumn("z", signed).filter(F.abs("z") > F.lit(math.log(max(counts.count(), 2))))
    chosen = [(r["term"], r["z"]) for r in best.orderBy(F.abs("z").desc(), "term").limit(max_terms).collect()]
    terms = [t for t, _ in chosen] + [t for t in SEEDS if t not in dict(chosen)]
    place = {t: i for i, t in enumerate(terms)}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, votes = [], []
            for text in batch.column("text").to_pylist():
                found = {t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)}
                hits.append(sorted(place[t] for t in found if t in place))
                votes.append([i for i, r in enumerate(PATTERNS.values()) if r.search(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_y"), pa.array(hits, pa.list_(pa.int32())), pa.array(votes, pa.list_(pa.int32()))], ["y", "hits", "votes"]
            )

    got = rows.mapInArrow(mark, "y int, hits array<int>, votes array<int>").collect()
    x, extra = np.zeros((len(got), len(terms)), np.float32), np.zeros((len(got), len(PATTERNS)))
    gold = np.array([r["y"] for r in got], float)
    for i, r in enumerate(got):
        x[i, r["hits"]] = 1
        extra[i, r["votes"]] = 1
    del got
    lexicon = [i for i, (_, s) in enumerate(chosen) if s > 0][:max_voters]
    lexicon += [place[t] for t in SEEDS if place[t] not in lexicon]
    votes = np.column_stack([gold, extra, x[:, lexicon]])
    posterior, accuracy, correlation = label_model(votes, 0.05 + 0.9 * gold)
    w, b = linear(x, posterior, np.array([_SEED_WEIGHT if t in SEEDS else 0.0 for t in terms]))
    names = ["human label", *PATTERNS, *(terms[i] for i in lexicon)]
    del x, votes
    released()
    return Model({t: float(w[i]) for t, i in place.items() if abs(w[i]) > 1e-6}, float(b), names, accuracy, correlation)


def _scorer(model: Model, keep_bytes: int = 64 << 20):
    """A function that scores a column of texts; it keeps the terms of chunks in at most `keep_bytes`."""
    weights, bias = model.weights, model.bias
    value, place = np.array([*weights.values()] or [0.0]), {t: i for i, t in enumerate(weights)}
    known = Kept(keep_bytes)

    def run(texts: pa.Array) -> np.ndarray:
        chunks = Chunks(texts)
        known.take_in([c for c in chunks.distinct if c not in known])
        for c in chunks.distinct:
            if c not in known:
                known[c] = tuple({place[t] for w in _WORD.findall(c.decode().lower()) for t in terms_of(w) if t in place})
        found = [known[c] for c in chunks.distinct]
        some = np.flatnonzero(np.array([bool(x) for x in found] or [False])[chunks.codes]) if len(chunks.codes) else np.zeros(0, int)
        owner = np.searchsorted(chunks.first, some, side="right") - 1
        pairs = {(d, t) for d, c in zip(owner.tolist(), chunks.codes[some].tolist(), strict=True) for t in found[c]}
        sums = np.full(len(texts), bias)
        for d, t in sorted(pairs):
            sums[d] += value[t]
        return 1 / (1 + np.exp(-sums.clip(-30, 30)))

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Whole texts are scored by the terms they hold, whatever the id, language or source; a null text is empty, and
    an empty text gets the score of a text without any term. A null doc_id is not held out. Repeated rows are
    scored each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches, limit=SLICE):
            p = scorer(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])
        released()

    scored = plain_docs(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is not predicted toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches, limit=SLICE):
            yield batch.filter(pa.array(scorer(pc.fill_null(batch.column("text"), "")) < 0.5))
        released()

    return docs.mapInArrow(run, docs.schema)

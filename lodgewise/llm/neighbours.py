"""Nearest neighbours by a block matrix join: int8 tiles bound the cosines, survivors are computed again in double."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

_BLOCK = "block long, dim int, n int, ids binary, vectors binary, codes binary, scales binary, errors binary"


def _quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, the scale of each, and the length of what the codes leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def blocks(vectors: DataFrame, ident: str, vector: str, rows: int, copies: int) -> DataFrame:
    """Rows of up to `rows` vectors of one length as matrices. Null, zero and non-finite vectors take no part, nor null ids.

    Of equal vectors in a block only the `copies` smallest ids stay, once each: no others can come among the nearest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = np.asarray(batch.column(0), dtype=np.int64)
            lists = batch.column(1)
            flat = np.asarray(lists.values.cast(pa.float64()).fill_null(math.nan), dtype=np.float64)
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            sizes = np.diff(offsets)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                some = np.flatnonzero(sizes == dim)
                x = flat[offsets[:-1][some][:, None] + np.arange(dim)]
                top = np.abs(x).max(axis=1)
                good = np.isfinite(top) & (top > 0)
                x, own = x[good], ids[some][good]
                order = np.argsort(own, kind="stable")
                x, own = x[order], own[order]
                _, kind = np.unique(x, axis=0, return_inverse=True)
                order = np.lexsort((own, kind))
                order = order[np.r_[True, (np.diff(kind[order]) != 0) | (np.diff(own[order]) != 0)][: len(order)]]  # repeated rows
                group = kind[order]
                first = np.r_[0, np.flatnonzero(np.diff(group)) + 1] if len(group) else np.zeros(0, int)
                rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
                few = np.sort(order[rank < copies])
                x, own = x[few], own[few]
                for at in range(0, len(x), rows):
                    y, i = x[at : at + rows], own[at : at + rows]
                    safe = y / np.abs(y).max(axis=1)[:, None]  # keeps the squares of very large and small numbers in range
                    codes, scale, error = _quantised(safe / np.linalg.norm(safe, axis=1)[:, None])
                    row = [part << 33 | made, dim, len(y), *(a.tobytes() for a in (i, y, codes, scale, error))]
                    made += 1
                    kinds = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 5
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in _BLOCK.split(", ")])

    some = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("vector")).filter("id IS NOT NULL AND vector IS NOT NULL")
    return some.mapInArrow(run, _BLOCK)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of matching rows in double precision, summed from the first component to the last."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    with np.errstate(all="ignore"):
        for i in range(a.shape[1]):
            dot += a[:, i] * b[:, i]
            aa += a[:, i] * a[:, i]
            bb += b[:, i] * b[:, i]
        out = dot / (np.sqrt(aa) * np.sqrt(bb))
    odd = ~np.isfinite(out) | ~np.isfinite(aa) | ~np.isfinite(bb) | (aa < 1e-290) | (bb < 1e-290)
    if odd.any():  # squares out of range: scaled first
        x, y = (v[odd] / np.abs(v[odd]).max(axis=1)[:, None] for v in (a, b))
        out[odd] = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
    return out


def _tile(q: dict, c: dict, heaps: list[list[tuple[float, int]]], k: int) -> None:
    """Put what a tile holds into the heaps of its queries: the k best, larger score first, then smaller id."""
    dim = q["dim"]
    qi, ci = (np.frombuffer(b["ids"], np.int64) for b in (q, c))
    qv, cv = (np.frombuffer(b["vectors"], np.float64).reshape(-1, dim) for b in (q, c))
    wide = np.float32 if dim <= 1024 else np.float64  # products of int8 are whole numbers and stay exact
    product = (np.frombuffer(q["codes"], np.int8).reshape(-1, dim).astype(wide) @ np.frombuffer(c["codes"], np.int8).reshape(-1, dim).astype(wide).T).astype(np.float64)
    (qs, qe), (cs, ce) = ((np.frombuffer(b["scales"]), np.frombuffer(b["errors"])) for b in (q, c))
    near = product * qs[:, None] * cs[None, :]
    doubt = qe[:, None] + (1 + qe[:, None]) * ce[None, :] + 1e-9
    near[qi[:, None] == ci[None, :]] = -math.inf
    order = np.argsort(ci, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(ci[order]) != 0])
    least = near - doubt
    if len(first) < len(ci):  # an id counts once, with its best bound
        least = np.maximum.reduceat(least[:, order], first, axis=1)
    if len(first) > k:
        floor = np.partition(least, len(first) - k, axis=1)[:, len(first) - k]
    else:
        floor = np.full(len(qi), -math.inf)
    floor = np.maximum(floor, [h[0][0] if len(h) == k else -math.inf for h in heaps])
    rows, columns = np.nonzero((near + doubt >= floor[:, None]) & (near > -math.inf))
    scores = _cosines(qv[rows], cv[columns])
    for r, s, i in zip(rows.tolist(), scores.tolist(), ci[columns].tolist(), strict=True):
        heap, item = heaps[r], (s, -i)
        if len(heap) < k or item > heap[0]:
            twin = next((n for n, x in enumerate(heap) if x[1] == -i), None)
            if twin is not None:  # a repeated id counts once, with its best score
                if heap[twin] < item:
                    heap[twin] = item
                    heapq.heapify(heap)
            elif len(heap) < k:
                heapq.heappush(heap, item)
            else:
                heapq.heapreplace(heap, item)


def nearest(vectors: DataFrame, is_query: Column, ident: str = "vec_id", vector: str = "embedding", k: int = 5, rows: int = 2048, share: float = 0.02) -> DataFrame:
    """The k nearest others of each query by cosine: query_id, rank, vec_id, score. Exact, whatever the size.

    Blocks of queries meet blocks of candidates in a grid of cells: each block of one side goes to every cell of
    its row or column, `share` (of queries among all rows) sets the shape of the grid so that little is copied. In
    a cell the int8 product of two blocks and its error bounds leave few pairs, which heaps merge. Vectors of
    another length than the query's are no candidates; rows that share an id count as one with its best score.
    """
    cells = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, round(math.sqrt(cells * share)))
    down = max(1, cells // across)
    asked = blocks(vectors.filter(is_query), ident, vector, rows, 1 << 30)
    given = blocks(vectors, ident, vector, rows, k + 1)

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int, prefix: str) -> DataFrame:
        keyed = df.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
        return keyed.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns})

    left, right = dealt(asked, "a", across, "b", down, "q_"), dealt(given, "b", down, "a", across, "c_")
    met = left.join(right, (left["a"] == right["a"]) & (left["b"] == right["b"]) & (left["q_dim"] == right["c_dim"]))
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, heaps = None, []

        def out() -> pa.RecordBatch:
            found = [(i, -n, s) for i, h in zip(np.frombuffer(q["ids"], np.int64).tolist(), heaps, strict=True) for s, n in h]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if q is None or row["q_block"] != q["block"]:
                    if q is not None:
                        yield out()
                    q = {c: row[f"q_{c}"] for c in names}
                    heaps = [[] for _ in range(q["n"])]
                _tile(q, {c: row[f"c_{c}"] for c in names}, heaps, k)
        if q is not None:
            yield out()

    ordered = met.select(*[f"q_{c}" for c in names], *[f"c_{c}" for c in names]).sortWithinPartitions("q_block")
    found = ordered.mapInArrow(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

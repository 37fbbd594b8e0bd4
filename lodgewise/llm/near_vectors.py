"""Near copies among vectors: randomly rotated binary codes with stored correction factors choose the pairs to recompute."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodgewise.llm.common import written
from lodgewise.llm.graph import components
from lodgewise.llm.neighbours import _cosines

_SAMPLE, _SAMPLE_BYTES = 65_536, 128 << 20
_CELL, _NEAR = 512, 8
_BLOCK, _TILE, _PAIRS = 4096, 1024, 200_000


def rotation(dim: int) -> np.ndarray:
    """A random rotation of `dim` dimensions, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _units(lists: pa.Array, dim: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of some rows, as they are and with length one."""
    flat, offsets = np.asarray(lists.values, dtype=np.float64), np.asarray(lists.offsets, dtype=np.int64)
    x = flat[offsets[rows][:, None] + np.arange(dim)]
    safe = x / np.abs(x).max(axis=1)[:, None]
    return x, safe / np.linalg.norm(safe, axis=1)[:, None]


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signs of the rotated vectors, packed, and for each the inner product of the vector with its code (0 to 1)."""
    turned = unit @ rotation(unit.shape[1]).T
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def slack(factor: np.ndarray, least: float, dim: int, sigmas: float) -> np.ndarray:
    """How far below `least` the estimate of a pair of cosine `least` or more can lie.

    With a the correction factor, a code is a times its vector plus a rest of length sqrt(1 - a^2) that stands upright
    on it, so the estimate <code, y> / a misses <x, y> by sqrt(1 - a^2) / a * <rest, y>. Of y only the part beside x
    counts, at most sqrt(1 - least^2) long, and against it the rest points anywhere in dim - 1 dimensions: `sigmas`
    standard deviations are allowed, and never more than the whole length, beyond which nothing can lie.
    """
    room = min(1.0, sigmas / math.sqrt(max(1, dim - 1)))
    return np.sqrt(np.maximum(0, 1 - factor**2)) / factor * math.sqrt(max(0.0, 1 - least**2)) * room + 1e-5


def fit_cells(classes: DataFrame, n_of_dim: dict[int, int], near: int, cell: int, sample: int) -> dict[int, np.ndarray]:
    """Centres of cells per dimension, from a sample of at most `sample` vectors and 128 MB: those with the smallest
    hashes. One centre for `cell` vectors, at most one for four vectors of the sample; no centres where cells would not outnumber `near`."""
    widest = max(n_of_dim, default=1)
    few = classes.select("vector").orderBy(F.xxhash64("vector")).limit(max(1, min(sample, _SAMPLE_BYTES // (8 * max(1, widest)))))
    lists = few.toArrow().column(0).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    sizes = np.diff(np.asarray(lists.offsets, dtype=np.int64)) if len(lists) else np.zeros(0, np.int64)
    out, rng = {}, np.random.default_rng(17)
    for dim in np.unique(sizes).tolist():
        _, x = _units(lists, dim, np.flatnonzero(sizes == dim))
        k = min(math.ceil(n_of_dim.get(dim, 0) / cell), len(x) // 4)
        if k <= near:
            continue
        centres = x[rng.choice(len(x), k, replace=False)]
        for _ in range(4):
            nearest = np.concatenate([np.argmax(x[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(x), 4096)])
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            length = np.linalg.norm(sums, axis=1)
            centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
        out[dim] = centres
    return out


def index(classes: DataFrame, near: int = _NEAR, cell: int = _CELL, sample: int = _SAMPLE) -> DataFrame:
    """classes with code, factor and the `near` cells that lie nearest; every row is indexed."""
    spark = classes.sparkSession
    n_of_dim = {r.dim: r.n for r in classes.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(10_000).collect()}
    centres = spark.sparkContext.broadcast(fit_cells(classes, n_of_dim, near, cell, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.diff(np.asarray(lists.offsets, dtype=np.int64))
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), 2048):
                    some = rows[at : at + 2048]
                    _, unit = _units(lists, dim, some)
                    packed, factor = codes(unit)
                    if dim in centres.value:
                        close = np.argpartition(-(unit @ centres.value[dim].T), near - 1, axis=1)[:, :near]
                        cells = np.sort(close, axis=1).astype(np.int32)
                    else:
                        cells = np.zeros((len(some), 1), np.int32)
                    offsets = np.arange(len(some) + 1, dtype=np.int32) * cells.shape[1]
                    added = [pa.array([dim] * len(some), pa.int32()), pa.array([c.tobytes() for c in packed], pa.binary()), pa.array(factor), pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel()))]
                    took = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*took.columns, *added], [*batch.schema.names, "dim", "code", "factor", "cells"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{kinds}, dim int, code binary, factor double, cells array<int>")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each of n rows reaches over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def _meet(table: pa.Table, least: float, sigmas: float) -> pa.Table:
    """The pairs of one block of a cell, or of two: links of each row (cid, null, n) and a forest over them (null, a, b)."""
    i, j, cell, dim = (table.column(c)[0].as_py() for c in ("i", "j", "cell", "dim"))
    table = table.combine_chunks()
    column = lambda c: table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0)
    block, m, cid, node = (np.asarray(column(c), dtype=np.int64) for c in ("block", "m", "cid", "node"))
    x, unit = _units(column("vector"), dim, np.arange(len(block)))
    cells = np.asarray(column("cells").flatten(), dtype=np.int32).reshape(len(block), -1)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    bits = np.unpackbits(np.frombuffer(b"".join(column("code").to_pylist()), np.uint8).reshape(len(block), -1), axis=1)[:, :dim]
    factor = np.asarray(column("factor"), dtype=np.float64)
    signs = (bits * np.float32(2) - np.float32(1)) / (math.sqrt(dim) * factor).astype(np.float32)[:, None]
    turned = (unit @ rotation(dim).T).astype(np.float32)
    floor = (least - slack(factor, least, dim, sigmas)).astype(np.float32)
    links, found_a, found_b = np.zeros(len(block), np.int64), [], []
    for p in range(0, len(left), _TILE):
        rows = left[p : p + _TILE]
        for q in range(p if i == j else 0, len(right), _TILE):
            others = right[q : q + _TILE]
            a, b = np.nonzero(signs[rows] @ turned[others].T >= floor[rows][:, None])
            a, b = rows[a], others[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            for at in range(0, len(a), _PAIRS):
                r, s = a[at : at + _PAIRS], b[at : at + _PAIRS]
                both = cells[r][:, :, None] == cells[s][:, None, :]
                first = np.where(both.any(axis=2), cells[r], np.iinfo(np.int32).max).min(axis=1)
                r, s = r[first == cell], s[first == cell]  # a pair that meets in several cells counts in one
                linked = _cosines(x[r], x[s]) >= least
                r, s = r[linked], s[linked]
                np.add.at(links, r, m[s])
                np.add.at(links, s, m[r])
                tree = _forest(r, s, len(block)) if len(r) else np.arange(len(block))
                child = np.flatnonzero(tree != np.arange(len(block)))
                found_a.append(child)
                found_b.append(tree[child])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (found_a, found_b))
    tree = _forest(a, b, len(block)) if len(a) else np.arange(len(block))
    child, some = np.flatnonzero(tree != np.arange(len(block))), np.flatnonzero(links)
    none = lambda n: pa.nulls(n, pa.int64())
    out = [[pa.array(cid[some]), none(len(child))], [pa.array(links[some]), none(len(child))], [none(len(some)), pa.array(node[child])], [none(len(some)), pa.array(node[tree[child]])]]
    return pa.table([pa.concat_arrays(c) for c in out], names=["cid", "n", "a", "b"])


def link(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", least: float = 0.9, near: int = _NEAR, cell: int = _CELL,
         sample: int = _SAMPLE, sigmas: float = 6.0) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row. Pairs of cosine `least` or more, computed in double, are linked.

    Equal vectors are one class, so copies are never paired. Each class goes to the `near` cells whose centres lie
    nearest; classes of one cell are compared in blocks, by binary code and correction factor first, in double where the
    confidence bound of `sigmas` standard deviations leaves a link possible. A pair counts in the first cell it shares;
    blocks return sums and forests, no pairs. Links are lost only where no cell is shared.

    Null vectors, zero ones and those with null or non-finite components, rows without an id, and vectors of different
    lengths link with nothing; a row without an id has a null component and is kept. Rows with the same id and vector
    are one vector and all get its row; different vectors under one id share its component. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    value = F.col(vector).cast(kind)
    fit = F.col(ident).isNotNull() & value.isNotNull() & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.select(F.col(ident).cast("long").alias("vec_id"), F.when(F.coalesce(fit, F.lit(False)), value).alias("vector"))
    units = rows.filter("vector IS NOT NULL").distinct()
    classes = written(units.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("m")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    indexed = written(index(classes, near, cell, sample), "codes")
    placed = indexed.select("*", F.explode("cells").alias("cell"))
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))  # a row per centre
    keyed = placed.join(sizes, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = keyed.select("*", other).select("dim", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "node", "m", "vector", "code", "factor", "cells")
    found = written(met.groupBy("dim", "cell", "i", "j").applyInArrow(lambda t: _meet(t, least, sigmas), "cid long, n long, a long, b long"), "links")
    links = found.filter("cid IS NOT NULL").groupBy("cid").agg(F.sum("n").alias("n"))
    roots = components(found.filter("a IS NOT NULL").select("a", "b"))
    facts = classes.join(links, "cid", "left").join(roots.withColumnRenamed("root", "component"), "node", "left")
    facts = written(facts.select("vector", "m", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")), "facts")
    total = facts.agg(F.sum("m")).first()[0] or 0
    often = F.col("m") * 1000 > total  # a thousand classes at most
    hot = F.broadcast(facts.filter(often).drop("m"))
    joined = rows.join(hot, "vector").unionByName(rows.join(hot.select("vector"), "vector", "left_anti").join(facts.filter(~often).drop("m"), "vector", "left"), allowMissingColumns=True)
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

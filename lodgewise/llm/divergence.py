"""How far the sources of a language differ in their words: one-hot products of (source, count level) columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodgewise.llm.common import raw_bytes, slices, written

_SLICE = 2 << 20
_HELD = 1_000_000
_GROUPS = 128  # sources side by side in one product
_TERMS, _COLUMNS, _TILE = 2048, 4096, 1024


def _inside(data: np.ndarray) -> np.ndarray:
    return ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)


def _terms(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of texts, and the code and the text of each occurrence."""
    data, offsets = raw_bytes(column)
    inside = _inside(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    small = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(small[inside]))])
    coded = found.dictionary_encode()
    return coded.dictionary.cast(pa.large_string()).cast(pa.string()), np.asarray(coded.indices, dtype=np.int64), np.searchsorted(offsets, start, side="right") - 1


def _cut(text: str, limit: int) -> Iterator[pa.Array]:
    """Parts of one long text, cut where no term stands."""
    raw = text.encode()
    gaps = np.flatnonzero(~_inside(np.frombuffer(raw, np.uint8)))
    at = 0
    while at < len(raw):
        later = gaps[np.searchsorted(gaps, at + limit) :]
        end = int(later[0]) if len(later) else len(raw)
        yield pa.array([raw[at:end].decode()])
        at = max(end, at + 1)


def term_counts(docs: DataFrame, slice_bytes: int = _SLICE) -> DataFrame:
    """lang, source, term, n (occurrences), docs: partial sums, many per term. Null lang, source and text are empty. A row
    without a term stands for each group that occurs."""
    names = ["lang", "source", "term"]

    def marks(group: pa.Table) -> pa.Table:
        own = group.group_by(names[:2], use_threads=False).aggregate([])
        zero = pa.array(np.zeros(own.num_rows, np.int64))
        return pa.table([*(own.column(c).combine_chunks() for c in names[:2]), pa.nulls(own.num_rows, pa.string()), zero, zero], names=[*names, "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(names, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*names, "n", "docs"])

        for batch in slices(batches, "text", slice_bytes):
            if not batch.num_rows:
                continue
            lang, source, text = (batch.column(c) for c in range(3))
            group = pa.table([lang, source], names=names[:2])
            held.append(marks(group))
            if batch.num_rows == 1 and len(text[0].as_py()) > 2 * slice_bytes:
                parts = []
                for part in _cut(text[0].as_py(), slice_bytes):
                    terms, code, _ = _terms(part)
                    parts.append(pa.table([terms, pa.array(np.bincount(code, minlength=len(terms)))], names=["term", "n"]))
                whole = pa.concat_tables(parts).group_by("term", use_threads=False).aggregate([("n", "sum")])
                m = whole.num_rows
                own = [pa.array([v[0].as_py()] * m, pa.string()) for v in (lang, source)]
                held.append(pa.table([*own, *(whole.column(c).combine_chunks() for c in ("term", "n_sum")), pa.array(np.ones(m, np.int64))], names=[*names, "n", "docs"]))
            else:
                terms, code, doc = _terms(text)
                each = pa.table({"doc": doc, "code": code}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
                doc, code, n = (np.asarray(each.column(c).combine_chunks(), dtype=np.int64) for c in ("doc", "code", "count_all"))
                langs, sources = lang.dictionary_encode(), source.dictionary_encode()
                sides = {"a": np.asarray(langs.indices, dtype=np.int64)[doc], "b": np.asarray(sources.indices, dtype=np.int64)[doc], "code": code, "n": n}
                both = pa.table(sides).group_by(["a", "b", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
                a, b, code = (both.column(c).combine_chunks() for c in ("a", "b", "code"))
                sums = [both.column(c).combine_chunks().cast(pa.int64()) for c in ("n_sum", "count_all")]
                held.append(pa.table([langs.dictionary.take(a), sources.dictionary.take(b), terms.take(code), *sums], names=[*names, "n", "docs"]))
            if sum(t.num_rows for t in held) > _HELD:
                held = [summed()]
                if held[0].num_rows > _HELD // 2:
                    yield from held.pop().to_batches(65536)
        if held:
            yield from summed().to_batches(65536)

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*plain).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """lang, source, term, n, total (over the language), first (one row per language and term) for terms in at least
    `least` documents of the language; a row without a term for each group."""
    partial = term_counts(docs).repartition("lang", "term")
    each = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    sums = each.withColumns({"total": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term), "least": F.min("source").over(of_term)})
    return sums.filter((F.col("docs") >= least) | F.col("term").isNull()).select("lang", "source", "term", "n", "total", (F.col("source") == F.col("least")).alias("first"))


def _share(count: str | Column, total: str, terms: str) -> Column:
    """p = 1 + floor(10^9 (count + 2) / (total + 2 terms)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * wide((F.col(count) if isinstance(count, str) else count) + F.lit(2))
    under = wide(F.greatest(F.col(total) + 2 * F.col(terms), F.lit(1)))
    return F.lit(1).cast("long") + F.call_function("div", top, under)


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class _Cell:
    """The sources that meet in one cell, and the sum of prices of each pair of them."""

    def __init__(self, key: tuple):
        self.key, self.sources, self.block, self.rare, self.terms = key, [], [], [], 0
        self.sums: np.ndarray | None = None

    def close(self) -> None:
        """All sources are known. Each pair begins as if no term occurred in either; blocks of terms put that right."""
        self.rare_p, self.blocks = np.array(self.rare, np.int64), np.array(self.block)
        gap = self.rare_p[:, None] - self.rare_p[None, :]
        self.absent = gap * gap // (self.rare_p[:, None] + self.rare_p[None, :])
        self.sums = self.terms * self.absent

    def add(self, term: np.ndarray, slot: np.ndarray, n: np.ndarray, p: np.ndarray) -> None:
        """Price a block of terms: rows hold term (ascending from 0), slot of the source, count and share."""
        if not len(term):
            return
        groups = len(self.sources)
        key = np.concatenate([np.arange(groups) << 48, (slot << 48) | n])
        levels, where = np.unique(key, return_inverse=True)
        n_terms = int(term[-1]) + 1
        if len(levels) > max(_COLUMNS, 2 * groups) and n_terms > 1:
            half = int(np.searchsorted(term, (n_terms + 1) // 2))
            self.add(term[:half], slot[:half], n[:half], p[:half])
            self.add(term[half:] - term[half], slot[half:], n[half:], p[half:])
            return
        self.sums -= n_terms * self.absent
        column, zero, owner = where[groups:], where[:groups], (levels >> 48).astype(np.int64)
        share = np.empty(len(levels), np.int64)
        share[zero], share[column] = self.rare_p, p
        hot = np.zeros((n_terms, len(levels)), np.float32)
        hot[:, zero] = 1
        hot[term, zero[slot]] = 0
        hot[term, column] = 1
        for i in range(0, len(levels), _TILE):
            left = np.ascontiguousarray(hot[:, i : i + _TILE].T)
            for j in range(i, len(levels), _TILE):
                joint = left @ hot[:, j : j + _TILE]  # whole numbers below 2^24: exact in single precision
                a, b = np.nonzero(joint)
                a, b, times = a + i, b + j, joint[a, b].astype(np.int64)
                use = owner[a] < owner[b]
                if self.key[2] != self.key[3]:
                    use &= self.blocks[owner[a]] != self.blocks[owner[b]]
                a, b, times = a[use], b[use], times[use]
                gap = share[a] - share[b]
                np.add.at(self.sums, (owner[a], owner[b]), times * (gap * gap // (share[a] + share[b])))

    def rows(self) -> pa.RecordBatch:
        a, b = np.triu_indices(len(self.sources), 1)
        if self.key[2] != self.key[3]:
            use = self.blocks[a] != self.blocks[b]
            a, b = a[use], b[use]
        names = np.array(self.sources, object)
        columns = [pa.array([self.key[1]] * len(a), pa.string()), pa.array(names[a], pa.string()), pa.array(names[b], pa.string()), pa.array(self.sums[a, b], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, cell, total and term; those with total -1 name the sources of the cell (n: terms to begin with)."""
    cell: _Cell | None = None
    slots: dict[str, int] = {}
    held: list[tuple[np.ndarray, ...]] = []  # term begins here, slot, n, p
    floor, count, last = 0, 0, None

    def flush() -> None:
        nonlocal held, count
        if held:
            begins, slot, n, p = (np.concatenate(x) for x in zip(*held, strict=True))
            cell.add(np.cumsum(begins) - 1, slot, n, p)
        held, count = [], 0

    for batch in batches:
        part, gi, gj, total, n, p, block = (np.asarray(batch.column(c), dtype=np.int64) for c in ("part", "gi", "gj", "total", "n", "p", "block"))
        lang, source, term = (batch.column(c).to_pylist() for c in ("lang", "source", "term"))
        coded = np.asarray(batch.column("term").dictionary_encode().indices.fill_null(-1), dtype=np.int64)
        keys = list(zip(part.tolist(), lang, gi.tolist(), gj.tolist(), strict=True))
        at = 0
        while at < len(keys):
            if cell is None or keys[at] != cell.key:
                if cell is not None:
                    if cell.sums is None:
                        cell.close()
                    flush()
                    yield cell.rows()
                cell, slots, last = _Cell(keys[at]), {}, None
            if total[at] < 0:
                slots[source[at]] = len(cell.sources)
                cell.sources.append(source[at])
                cell.block.append(int(block[at]))
                cell.rare.append(int(p[at]))
                cell.terms = int(n[at])
                at += 1
                continue
            if cell.sums is None:
                cell.close()
            fresh = term[at] != last
            if fresh and (count >= _TERMS or (count and total[at] > floor + (floor >> 2) + 8)):
                flush()
            if not count:
                floor = int(total[at])
            # as far as the cell and the bounds of a block reach
            end = at + 1
            stop = floor + (floor >> 2) + 8
            begins = [fresh]
            count += fresh
            while end < len(keys) and keys[end] == cell.key and total[end] <= stop:
                new = coded[end] != coded[end - 1]
                if new and count >= _TERMS:
                    break
                begins.append(new)
                count += new
                end += 1
            held.append((np.array(begins, np.int64), np.array([slots[s] for s in source[at:end]], np.int64), n[at:end], p[at:end]))
            last, at = term[end - 1], end
    if cell is not None:
        if cell.sums is None:
            cell.close()
        flush()
        yield cell.rows()


def pair_values(kept: DataFrame, groups: DataFrame, width: int = _GROUPS) -> DataFrame:
    """lang, a, b (sources, a before b in their cell), value: the prices of all kept terms summed, for every pair of
    sources of a language.

    A term has a one for the column (source, its count there), also for a count of zero. The columns of a block of
    terms, multiplied by their transpose, give how often two levels of two sources meet, and each meeting is priced
    once. Terms are dealt in ranges of their total, so that a block holds few levels; more than `width` sources are
    cut into blocks whose pairs are cells of their own.
    """
    spark = kept.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rare = groups.select("lang", "source", F.floor(F.col("place") / width).cast("int").alias("block"), F.ceil(F.col("members") / width).cast("int").alias("blocks"),
                         "terms", "own", _share(F.lit(0).cast("long"), "own", "terms").alias("rare"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sent = lambda df: df.select("*", other).withColumns({"gi": F.least("block", "other"), "gj": F.greatest("block", "other")}).drop("other")
    rows = kept.filter("term IS NOT NULL").join(rare, ["lang", "source"]).withColumn("p", _share("n", "own", "terms"))
    columns = ["lang", "gi", "gj", "total", "term", "source", "block", "n", "p"]
    ranged = sent(rows).select(*columns).repartitionByRange(parts, "lang", "gi", "gj", "total", "term").withColumn("part", F.spark_partition_id())
    stored = written(ranged, "levels")
    named = sent(rare).select("lang", "gi", "gj", F.lit(-1).cast("long").alias("total"), F.lit(None).cast("string").alias("term"), "source", "block", F.col("terms").alias("n"), F.col("rare").alias("p"))
    cells = stored.select("part", "lang", "gi", "gj").distinct().unionByName(named.select(F.lit(0).alias("part"), "lang", "gi", "gj").distinct()).distinct()
    heads = named.join(cells, ["lang", "gi", "gj"]).withColumn("n", F.when(F.col("part") == 0, F.col("n")).otherwise(0))
    stream = stored.unionByName(heads)
    ordered = stream.repartitionById(parts, F.pmod("part", F.lit(parts)).cast("int")).sortWithinPartitions("part", "lang", "gi", "gj", "total", "term", "source")
    found = ordered.mapInArrow(_products, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 10, top: int = 10, width: int = _GROUPS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from every other (part `pair`) and
    which of its terms stand out most against the language (part `term`, to rank `top`).

    Only terms in at least `least` documents of a language count. Every group that occurs has its pairs, also one
    without terms; a language with one source has none. Repeated rows count as often as they come; an empty table gives
    no rows, other columns stay behind.
    """
    kept = written(kept_terms(docs, least), "terms")
    each = kept.groupBy("lang", "source").agg(F.sum(F.when(F.col("term").isNotNull(), F.col("n")).otherwise(0)).alias("own"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("new"))
    of_lang = Window.partitionBy("lang")
    groups = each.withColumns({"terms": F.sum("new").over(of_lang), "all": F.sum("own").over(of_lang), "members": F.count(F.lit(1)).over(of_lang),
                               "place": F.row_number().over(of_lang.orderBy("source")) - 1}).drop("new")
    groups = written(groups, "groups")
    pairs = pair_values(kept, groups, width)
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = both.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    rows = kept.filter("term IS NOT NULL").join(groups, ["lang", "source"]).withColumns({"p": _share("n", "own", "terms"), "q": _share("total", "all", "terms")})
    terms = rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    best = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return ranked.unionByName(best).select("lang", "source", "part", "item", "value", "rank")

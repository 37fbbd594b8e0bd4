"""Exact n-gram Jaccard join by grouped prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lodgewise.llm.common import plain_docs, released, slices, written
from lodgewise.llm.graph import components
from lodgewise.llm.words import mix, shingles, words

_BITS, _PIECES = 21, 1024  # frequency sketches: 2 ** _BITS counters each, added up in _PIECES parts
_MORE = 64
_LIST, _ROWS = 64, 1024  # longer lists of a shingle are compared in blocks of so many rows
_EACH = (2 << _BITS) // _PIECES
SLICE = 1 << 20  # bytes of text at once: each takes about 50 bytes of memory
BROADCAST_ROWS = 500_000


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text."""
    prints, _, _, first = words(column)
    found, at = shingles(prints, first, size)
    for i in range(len(at) - 1):
        yield np.unique(found[at[i] : at[i + 1]])


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - _BITS)).astype(np.int64)


class _Rarity:
    """A number for each shingle by which all prefixes are sorted: about four times the logarithm of how often it is to
    be expected, from the counts of its words and from the count of its own counter where that stands out.

    It depends on nothing but the shingle, and is made of whole numbers, so every text sorts alike.
    """

    def __init__(self, word_counts: np.ndarray, shingle_counts: np.ndarray):
        total = max(int(word_counts.sum(dtype=np.int64)), 1)
        self.whole = int(4 * np.log2(total))
        self.scarce = np.rint(-4 * np.log2(np.maximum(word_counts, 1) / total)).astype(np.uint8)
        usual = shingle_counts.mean()
        hot = shingle_counts > usual + 6 * np.sqrt(usual) + 8
        self.hot = np.where(hot, 4 * np.log2(np.maximum(shingle_counts, 1)), 0).astype(np.uint8)

    def sets(self, column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The sorted distinct shingles of each text, and the number of each."""
        prints, _, _, first = words(column)
        found, at = shingles(prints, first, size)
        sums = np.concatenate([[0], np.cumsum(self.scarce[_bucket(prints)].astype(np.int64))])
        n = np.diff(at)
        place = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
        scarce = sums[np.minimum(place + size, np.repeat(first[1:], n))] - sums[place]
        expected = np.maximum(self.whole - scarce, self.hot[_bucket(found)])
        for i in range(len(at) - 1):
            own, where = np.unique(found[at[i] : at[i + 1]], return_index=True)
            yield own, expected[at[i] : at[i + 1]][where]


def _class(values: np.ndarray) -> int:
    """One number for a set: sums of two independent mixes of its members and its size."""
    twice = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    whole = np.array([values.sum(dtype=np.uint64), twice.sum(dtype=np.uint64), len(values)], np.uint64)
    return int((mix(whole) * np.array([3, 5, 7], np.uint64)).sum(dtype=np.uint64).view(np.int64))


def _bitmap(values: np.ndarray) -> bytes:
    """One bit for each member of a set, by its first bits, in the least power of two of places that is twice its size."""
    places = max(6, (2 * len(values) - 1).bit_length())
    bits = np.zeros(1 << places, np.uint8)
    bits[(values >> np.uint64(64 - places)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _absent(x: bytes, y: bytes) -> tuple[int, int]:
    """At least so many members of x that are not in y, and of y that are not in x."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    a, b = (np.unpackbits(v).reshape(8 * min(len(a), len(b)), -1).max(axis=1) for v in (a, b))  # the larger one folded
    return int(np.count_nonzero(a > b)), int(np.count_nonzero(b > a))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece: the sums of its counters over all rows, which are looked at one by one and never held."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts"), strict=True):
            if piece not in total:
                total[piece] = np.zeros(_EACH, np.int64)
            total[piece] += np.frombuffer(counts.as_buffer(), "<u2")
    if total:
        sums = [np.minimum(t, 2**32 - 1).astype("<u4").tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(sums, pa.binary())], ["piece", "counts"])
    released()


def _rarity(docs: DataFrame, size: int) -> _Rarity:
    """Counts of words and shingles over all rows, in sketches of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << _BITS), np.int32)
        for batch in slices(batches, limit=SLICE):
            prints, _, _, first = words(batch.column("text"))
            for total, values in zip(counts, (prints, shingles(prints, first, size)[0]), strict=True):
                place, n = np.unique(_bucket(values), return_counts=True)
                total[place] += n.astype(np.int32)
        released()
        if counts.any():
            pieces = [np.minimum(p, 65535).astype("<u2").tobytes() for p in np.split(counts.ravel(), _PIECES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_PIECES), pa.int32()), pa.array(pieces, pa.binary())], ["piece", "counts"])

    schema = "piece int, counts binary"
    parts = docs.mapInArrow(run, schema).repartition("piece")
    counts = np.zeros((_PIECES, _EACH), np.uint32)
    for row in written(parts.mapInArrow(_added, schema), "counts").toLocalIterator():  # _PIECES rows
        counts[row["piece"]] = np.frombuffer(row["counts"], "<u4")
    return _Rarity(*counts.reshape(2, -1))


def _profiles(docs: DataFrame, size: int, percent: int, rarity: _Rarity) -> DataFrame:
    """doc_id (and what else stands beside the text), n_shingles, class, the prefix, a number for it, and a bitmap of the set.

    The prefix holds the rarest shingles: as many as linked sets may differ by, and 1 + n // _MORE further ones, of
    which linked sets share as many as the smaller of them has.
    """

    beside = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            columns = [[] for _ in range(5)]
            for s, expected in rarity.sets(batch.column("text"), size):
                keep = len(s) - -(-percent * len(s) // 100) + 1 + len(s) // _MORE
                order = np.argsort(expected, kind="stable")[:keep]
                prefix = np.sort(s[order])
                row = (len(s), _class(s), _class(prefix), prefix.tobytes(), _bitmap(s)) if len(s) else (0, None, None, None, None)
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in beside), *arrays], [*beside, "n_shingles", "class", "print", "prefix", "bits"])
        released()

    return docs.mapInArrow(run, "".join(f"{c} long, " for c in beside) + "n_shingles long, class long, print long, prefix binary, bits binary")


def _postings(groups: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = [np.frombuffer(x, np.int64) for x in batch.column("prefix").to_pylist()]
            sizes = [len(p) for p in prefixes]
            if sum(sizes):
                grp, doc = (np.repeat(np.asarray(batch.column(c)), sizes) for c in ("grp", "doc"))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(prefixes)), pa.array(grp), pa.array(doc)], ["shingle", "grp", "doc"])
        released()

    return groups.select("grp", "doc", "prefix").mapInArrow(run, "shingle long, grp long, doc long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _bits_of(rows: pd.DataFrame, length: int) -> np.ndarray:
    """Bitmaps as a matrix of 0 and 1, folded to `length` places."""
    bits = np.unpackbits(np.stack([np.frombuffer(b, np.uint8) for b in rows["bits"]]), axis=1)
    return bits.reshape(len(rows), length, -1).max(axis=2).astype(np.float32)


def _near_in_blocks(x: pd.DataFrame, y: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in x, in y) of the pairs of two roots that sizes and bitmaps allow to be linked; products of matrices."""
    x_length, y_length = (z["bits"].map(len).to_numpy() * 8 for z in (x, y))
    for p in np.unique(x_length).tolist():
        for q in np.unique(y_length).tolist():
            if max(p, q) > 2 * min(p, q):
                continue  # linked sizes differ by a third at most
            length, step = min(p, q), max(16, (1 << 24) // max(p, q))
            left, right = np.flatnonzero(x_length == p), np.flatnonzero(y_length == q)
            for i in range(0, len(left), step):
                a, own = x.iloc[left[i : i + step]], left[i : i + step]
                bits_a = _bits_of(a, length)
                for j in range(0, len(right), step):
                    b, other = y.iloc[right[j : j + step]], right[j : j + step]
                    bits_b = _bits_of(b, length)
                    common = bits_a @ bits_b.T
                    na, nb = a["n"].to_numpy()[:, None], b["n"].to_numpy()[None, :]
                    both = np.minimum(na - bits_a.sum(axis=1)[:, None] + common, nb - bits_b.sum(axis=1)[None, :] + common)
                    good = (100 * both >= percent * (na + nb - both)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
                    good &= a["root"].to_numpy()[:, None] != b["root"].to_numpy()[None, :]
                    u, v = np.nonzero(good)
                    yield own[u], other[v]


def _crowded(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots in long lists: every block of a list meets every other once, and a pair comes out
    where the first shingle stands that both have in long lists. Columns: shingle, size (of the list), class, root,
    n, bits, opens (shingles of the class in long lists)."""
    blocks = F.ceil(F.col("size") / F.lit(_ROWS)).cast("int")
    own = rows.withColumn("own", F.pmod(F.xxhash64("class"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    keyed = own.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "size")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        shingle, i, j = (int(group[c].iloc[0]) for c in ("shingle", "i", "j"))
        x, y = (group[group["own"] == k].reset_index(drop=True) for k in (i, j))
        found = []
        if len(x) and len(y):
            opens = [[frozenset(o) for o in z["opens"]] for z in (x, y)]
            names = [z["class"].to_numpy() for z in (x, y)]
            for u, v in _near_in_blocks(x, y, percent):
                found += [
                    (names[0][r], names[1][c]) for r, c in zip(u.tolist(), v.tolist(), strict=True)
                    if (i != j or names[0][r] < names[1][c]) and min(opens[0][r] & opens[1][c]) == shingle
                ]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return keyed.groupBy("shingle", "i", "j").applyInPandas(compare, "a long, b long")


def _small(keys: DataFrame) -> DataFrame:
    """A list of keys, to be broadcast where its rows were counted to be few."""
    return keys if keys.offset(BROADCAST_ROWS).head(1) else F.broadcast(keys)


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may still reach the threshold by size and bitmap; no linked pair is lost."""
    sides = [reps.select(F.col("class").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits{s}")) for s in ("a", "b")]
    sized = pairs.join(sides[0].select("a", "na"), "a").join(sides[1].select("b", "nb"), "b")
    near = sized.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = [batch.column(c).to_pylist() for c in ("na", "nb", "bitsa", "bitsb")]
            for n, m, x, y in zip(*columns, strict=True):
                without, other = _absent(x, y)
                both = min(n - without, m - other)
                good.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
        released()

    met = near.join(sides[0], "a").join(sides[1], "b").select("a", "b", "na", "nb", "bitsa", "bitsb")
    return met.mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold. Sets are read again from the texts of the classes named."""
    near = written(_likely(pairs, reps, percent), "pairs")
    named = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class"))).distinct()
    wanted = written(reps.select("class", "doc").join(named, "class"), "wanted")
    ids = _small(wanted.select(F.col("doc").alias("_doc")).distinct())
    rows = docs.withColumn("_doc", F.coalesce("doc_id", F.lit(_LAST))).join(ids, "_doc", "left_semi").select("doc_id", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            found = [(_class(s), s.tobytes()) for s in _sets(batch.column("text"), size) if len(s)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], ["class", "members"])
        released()

    held = rows.mapInArrow(sets, "class long, members binary").join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])
    held = written(held, "sets")
    met = near.join(held.select(F.col("class").alias("a"), F.col("members").alias("ma")), "a").join(held.select(F.col("class").alias("b"), F.col("members").alias("mb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("ma"), batch.column("mb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
        released()

    return met.select("a", "b", "ma", "mb").mapInArrow(check, "a long, b long")


_LAST = 2**63 - 1  # a null doc_id sorts behind all others


def _linked(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The profiles of all rows, and class, doc, root (one class of the component) of all classes.

    Equal sets form a class; classes with the same size and prefix form a group, and only groups are posted under
    the shingles of their prefix. A first round of candidates holds, for each shingle, each group with the group of
    the smallest doc_id and with its neighbour in the order of ids, and each class with the first of its group;
    verified links give components. The second round takes every pair of classes in different components whose
    prefixes share enough (or that form one group), so no link between components is missed, and pairs inside a
    large group of copies are never formed. Sizes and bitmaps leave few pairs, whose whole sets are compared;
    of long lists, only these pairs are ever written out.
    """
    profiles = written(_profiles(rows, size, percent, _rarity(rows, size)), "profiles")
    doc = F.coalesce("doc_id", F.lit(_LAST))
    first_of = F.row_number().over(Window.partitionBy("class").orderBy("doc"))
    reps = profiles.filter("n_shingles > 0").select("class", doc.alias("doc"), F.col("n_shingles").alias("n"), "print", "prefix", "bits")
    reps = written(reps.withColumn("_first", first_of).filter("_first = 1").drop("_first"), "classes")
    groups = reps.groupBy("n", "print").agg(F.min(F.struct("doc", "class")).alias("best"))
    member = written(reps.select("class", "doc", "n", "print").join(groups, ["n", "print"]).select("class", "doc", "n", F.col("best.class").alias("grp")), "members")
    heads = _small(member.filter("class = grp").select("class"))
    leaders = reps.join(heads, "class", "left_semi").select(F.col("class").alias("grp"), "doc", "prefix")
    line = Window.partitionBy("shingle").orderBy("doc", "grp")
    placed = _postings(leaders).select(
        "shingle", "grp", F.lag("grp").over(line).alias("previous"), F.first("grp").over(line).alias("top"), F.lead("grp").over(line).alias("next")
    )
    shared = written(placed.filter("previous IS NOT NULL OR next IS NOT NULL").select("shingle", "grp", "previous", "top"), "shared")
    first = shared.select(F.col("grp").alias("a"), F.col("top").alias("b"))
    first = first.unionByName(shared.filter("previous IS NOT NULL").select(F.col("grp").alias("a"), F.col("previous").alias("b")))
    first = written(_ordered(first.unionByName(member.select(F.col("class").alias("a"), F.col("grp").alias("b")))), "first")
    links = written(_verified(first, reps, rows, size, percent), "links")
    known = components(links)

    at = member.join(known, F.col("class") == F.col("node"), "left").select("class", "grp", F.coalesce("root", F.col("class")).alias("root"))
    at = written(at, "at")
    sizes = member.filter("class = grp").select("grp", "n")
    inner = at.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high")).join(sizes, "grp")
    posted = shared.select("shingle", "grp").join(inner, "grp")
    mixed = posted.groupBy("shingle").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l <> h").select("shingle")
    near = F.floor(F.log("n") / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("int")  # linked sizes differ by one step at most
    open_ = written(posted.join(mixed, "shingle").select("shingle", "grp", "low", "high", "n", near.alias("step")), "open")
    long_ = open_.groupBy("shingle").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > _LIST)
    crowd = open_.join(long_, "shingle").select("shingle", "size", "grp")
    opens = crowd.groupBy("grp").agg(F.collect_list("shingle").alias("opens"))
    named_ = at.join(opens, "grp").join(reps.select("class", "n", "bits"), "class")
    dense = _crowded(crowd.join(named_, "grp").select("shingle", "size", "class", "root", "n", "bits", "opens"), percent)
    open_ = open_.join(long_, "shingle", "left_anti")
    left, right = (open_.withColumnsRenamed({c: f"{s}_{c}" for c in ("grp", "low", "high", "n")}) for s in ("x", "y"))
    right = right.withColumn("step", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)))
    apart = "x_grp < y_grp AND NOT (x_low = y_low AND x_low = x_high AND y_low = y_high)"
    sized = F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent
    crossing = left.join(right, ["shingle", "step"]).filter(F.expr(apart) & sized)
    enough = F.col("shared") > F.floor(F.least("x_n", "y_n") / _MORE)
    crossing = crossing.groupBy("x_grp", "y_grp", "x_n", "y_n").agg(F.count(F.lit(1)).alias("shared")).filter(enough).select("x_grp", "y_grp")
    crossing = crossing.unionByName(inner.filter("low <> high").select(F.col("grp").alias("x_grp"), F.col("grp").alias("y_grp")))
    one, two = at.withColumnsRenamed({"class": "a", "grp": "x_grp", "root": "ra"}), at.withColumnsRenamed({"class": "b", "grp": "y_grp", "root": "rb"})
    second = crossing.join(one, "x_grp").join(two, "y_grp").filter("ra <> rb").select("a", "b")
    second = _ordered(second.unionByName(dense)).join(first, ["a", "b"], "left_anti")
    more = _verified(written(second, "second"), reps, rows, size, percent)
    roots = components(links.unionByName(more))

    named = member.join(roots, F.col("class") == F.col("node"), "left").select("class", "doc", F.coalesce("root", F.col("class")).alias("root"))
    return profiles, named


def link(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A null or empty text has no shingles and its own doc_id as component; a null doc_id counts as the largest and
    its component is null if it is alone; repeated rows get a row each. Fingerprints have 64 bits.
    """
    profiles, named = _linked(plain_docs(docs), size, percent)
    least = named.groupBy("root").agg(F.min("doc").alias("least"))
    ids = named.join(least, "root").select(F.col("class").alias("_class"), F.nullif("least", F.lit(_LAST)).alias("least"))
    out = profiles.select("doc_id", "n_shingles", "class").join(ids, F.col("class") == F.col("_class"), "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def surplus(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """What is left over when one row of each component stays: doc_id, text_hash (64 bits), stays.

    The row with the smallest doc_id (null: the largest) and then the smallest hash of its text stays. It is listed
    too, with `stays`, if equal rows (same id and text) follow it. A row without shingles is no copy of any other.
    """
    profiles, named = _linked(plain_docs(docs, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")), size, percent)
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    keyed = profiles.filter("n_shingles > 0").groupBy("class", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    keyed = written(keyed.join(named.select("class", "root"), "class"), "keyed")
    best = keyed.groupBy("root").agg(F.min("key").alias("best"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows")
    told = keyed.join(best, "root").withColumn("stays", F.expr("key <=> best")).filter("NOT stays OR n > 1")
    return told.select("key.doc_id", "key.text_hash", "stays")

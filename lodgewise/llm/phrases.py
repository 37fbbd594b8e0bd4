"""Phrases of words that keep company: count streams in prefix and in suffix order, walked in lockstep."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodgewise.llm.common import raw_bytes, slices, written
from lodgewise.llm.words import mix

_BREAKERS = b".,;:!?\n\x0b\x0c\r"
_SLICE = 2 << 20
_HELD, _KEYS = 1_000_000, 4_000_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _short(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of rows (lang, text) of about `limit` bytes. A longer text is cut behind a mark that ends a piece."""
    for batch in slices(batches, "text", limit):
        text = batch.column(1)
        if batch.num_rows > 1 or not batch.num_rows or len(raw := (text[0].as_py() or "").encode()) <= 2 * limit:
            yield batch
            continue
        marks = np.flatnonzero(np.isin(np.frombuffer(raw, np.uint8), np.frombuffer(_BREAKERS, np.uint8))) + 1
        at = 0
        while at < len(raw):
            later = marks[np.searchsorted(marks, at + limit) :]
            end = int(later[0]) if len(later) else len(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[at:end].decode()])], batch.schema.names)
            at = end


class Pieces:
    """The words of a slice: a code each, its language, and whether the next word belongs to the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        langs = batch.column(0).dictionary_encode()
        self.langs = langs.dictionary
        data, offsets = raw_bytes(batch.column(1))
        breaker = np.isin(data, np.frombuffer(_BREAKERS, np.uint8))
        inside = ~(breaker | (data == 32) | (data == 9))
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        piece = np.cumsum(breaker)[start] if len(start) else start
        text = np.searchsorted(offsets, start, side="right")
        self.joined = np.append((np.diff(piece) == 0) & (np.diff(text) == 0), False)[: len(start)]
        small = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
        bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(small[inside]))])
        coded = words.dictionary_encode()
        self.words = coded.dictionary.cast(pa.large_string())
        self.code = np.asarray(coded.indices, dtype=np.int32)
        self.lang = np.asarray(langs.indices, dtype=np.int32)[text - 1]
        self._bytes = coded.dictionary

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit key of each word with its language, and of the word alone."""
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self._bytes.to_pylist()), np.uint64, len(self._bytes))
        lang = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in self.langs.to_pylist()), np.uint64, len(self.langs))
        word = own[self.code]
        return mix(word * _A + lang[self.lang]), word


def _possible(pieces: Pieces, marks: list[Marks]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Per place and number of words k = 1, 2, ...: whether k words may start a frequent phrase there, as far as the marks
    and the pieces tell; and the key of one word more, where the shorter ones allow it (`ready`)."""
    keys, word = pieces.keys()
    alive = [np.ones(len(word), bool)]
    for k, mark in enumerate(marks, 1):
        alive.append(ready(alive, pieces.joined, k) & mark.has(keys))
        keys = mix(keys * _B + np.append(word[k:], np.zeros(min(k, len(word)), np.uint64)) * _A)
    return keys, alive[1:], ready(alive, pieces.joined, len(marks) + 1)


def ready(alive: list[np.ndarray], joined: np.ndarray, k: int) -> np.ndarray:
    """Whether k words starting at a place lie in one piece and their first and last k - 1 words may be frequent."""
    if k == 1:
        return alive[0]
    later = lambda x, by: np.append(x[by:], np.zeros(min(by, len(x)), bool))
    return alive[-1] & later(alive[-1], 1) & joined & later(joined, k - 2)


class Marks:
    """A bitmap of fixed size over keys that may be frequent: a key it lacks is not."""

    def __init__(self, blocks: dict[int, bytes], bits: int):
        self.shift = np.uint64(64 - bits)
        self.bytes = np.zeros(1 << (bits - 3), np.uint8)
        for number, block in blocks.items():
            self.bytes[number * 4096 : (number + 1) * 4096] = np.frombuffer(block, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = (keys >> self.shift).astype(np.int64)
        return (self.bytes[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _counted(keys: np.ndarray, least: int, bits: int) -> pa.RecordBatch:
    """Keys with their counts, a row per block of the bitmap: of each key 24 bits behind the block's (9 more than the bitmap
    tells apart), and its count up to `least`, in a byte where that is enough."""
    distinct, n = np.unique(keys >> np.uint64(64 - bits - 9), return_counts=True)
    block = (distinct >> np.uint64(24)).astype(np.int32)
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    bounds = np.append(first, len(block))

    def cut(values: np.ndarray, width: int) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])

    kind = _count_kind(least)
    rests = distinct.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    return pa.RecordBatch.from_arrays([pa.array(block[first]), cut(rests, 3), cut(np.minimum(n, least).astype(kind), kind.itemsize)], ["block", "rests", "counts"])


def _count_kind(least: int) -> np.dtype:
    return np.dtype("<u1" if least < 256 else "<u4")


def _marks(counted: DataFrame, least: int, bits: int) -> Marks:
    """Marks of all keys whose counts (rows of `_counted`) reach `least`; 2^bits bits reach the driver at most."""
    kind = _count_kind(least)

    def summed(rests: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rest, n = np.concatenate(rests), np.concatenate(counts)
        order = np.argsort(rest, kind="stable")
        rest, n = rest[order], n[order]
        first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
        return rest[first], np.add.reduceat(n, first)

    def bitmap(rests: list[np.ndarray], counts: list[np.ndarray]) -> bytes | None:
        rest, n = summed(rests, counts)
        flags = np.zeros(32768, bool)
        flags[rest[n >= least] >> 9] = True
        return np.packbits(flags, bitorder="little").tobytes() if flags.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rests, counts, held = None, [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if at is not None and (own := bitmap(rests, counts)):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([own], pa.binary())], ["block", "bits"])

        for batch in batches:
            for block, rest, n in zip(*(batch.column(c).to_pylist() for c in ("block", "rests", "counts")), strict=True):
                if block != at:
                    yield from out()
                    at, rests, counts, held = block, [], [], 0
                wide = np.zeros((len(rest) // 3, 4), np.uint8)
                wide[:, :3] = np.frombuffer(rest, np.uint8).reshape(-1, 3)
                rests.append(wide.view("<u4")[:, 0])
                counts.append(np.frombuffer(n, kind).astype(np.int64))
                held += len(wide)
                if held > _KEYS:
                    rests, counts = ([x] for x in summed(rests, counts))
                    held = 0
        yield from out()

    rows = counted.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, bits binary")
    return Marks({r.block: bytes(r.bits) for r in rows.toLocalIterator()}, bits)


def _words_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def windows(docs: DataFrame, least: int, longest: int = 5, bits: int = 27, slice_bytes: int = _SLICE, levels: int = 2) -> DataFrame:
    """One row per language and distinct window with its count: w1, w2, ... hold the words from a place on, as many as
    stand in one piece, `longest` at most. A row without words counts all words of the language.

    A window ends where bitmaps of the phrases of 1 to `levels` words show that a rare one would stand in it: no phrase
    of `least` occurrences holds a rarer one. Bitmaps have 2^bits bits; where keys collide, more is counted, never less.
    """
    spark, texts = docs.sparkSession, _words_of(docs)
    names = [f"w{i + 1}" for i in range(longest)]
    known: list = []

    def counted(before: list):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []
            for batch in _short(batches, slice_bytes):
                keys, _, some = _possible(Pieces(batch), [b.value for b in before])
                held.append(keys[some])
                if sum(map(len, held)) > _KEYS:
                    yield _counted(np.concatenate(held), least, bits)
                    held = []
            if held:
                yield _counted(np.concatenate(held), least, bits)

        return run

    for _ in range(min(levels, longest - 1)):
        keys = texts.mapInArrow(counted(list(known)), "block int, rests binary, counts binary")
        known.append(spark.sparkContext.broadcast(_marks(keys, least, bits)))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            whole = pa.concat_tables(held).group_by(["lang", *names], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", *names, "n"])
            return whole.sort_by([(c, "ascending") for c in ["lang", *names]])  # neighbours share beginnings: packs well

        for batch in _short(batches, slice_bytes):
            pieces = Pieces(batch)
            _, alive, _ = _possible(pieces, [b.value for b in known])
            for k in range(len(alive) + 1, longest + 1):
                alive.append(ready(alive, pieces.joined, k))
            at = np.flatnonzero(alive[0])
            columns = {"lang": pieces.lang[at], "w1": pieces.code[at]}
            for i in range(1, longest):
                columns[f"w{i + 1}"] = np.where(alive[i][at], pieces.code[np.minimum(at + i, max(0, len(pieces.code) - 1))], -1).astype(np.int32)
            counted = pa.table(columns).group_by(["lang", *names], use_threads=False).aggregate([([], "count_all")])
            total = np.bincount(pieces.lang, minlength=len(pieces.langs))
            code = lambda c: np.asarray(counted.column(c).combine_chunks(), dtype=np.int64)  # noqa: B023, E731
            none = pa.nulls(len(total), pa.string())
            sides = [pieces.langs.take(pa.array(code("lang"))).cast(pa.string())]
            sides += [pieces.words.take(pa.array(code(c), mask=code(c) < 0)).cast(pa.string()) for c in names]
            held.append(pa.table([*sides, counted.column("count_all").combine_chunks().cast(pa.int64())], names=["lang", *names, "n"]))
            held.append(pa.table([pieces.langs.cast(pa.string()), *[none] * longest, pa.array(total.astype(np.int64))], names=["lang", *names, "n"]))
            if sum(t.num_rows for t in held) > _HELD:
                held = [summed()]
                if held[0].num_rows > _HELD // 2:
                    yield from held.pop().to_batches(65536)
        if held:
            yield from summed().to_batches(65536)

    return texts.mapInArrow(found, f"lang string, {', '.join(f'{c} string' for c in names)}, n long")


def _same(columns: list[pa.Array]) -> np.ndarray:
    """For each row but the first, how many leading columns equal those of the row before."""
    n = len(columns[0])
    same, count = np.ones(max(0, n - 1), bool), np.zeros(max(0, n - 1), np.int64)
    for column in columns:
        coded = np.asarray(column.dictionary_encode().indices.fill_null(-1), dtype=np.int64)
        same = same & (coded[1:] == coded[:-1])
        count += same
    return count


def _size(names: list[str]):
    return sum((F.col(c).isNotNull().cast("int") for c in names[1:]), F.col(names[0]).isNotNull().cast("int"))


def frequent(counted: DataFrame, least: int) -> DataFrame:
    """All phrases of up to as many words as the windows have, with at least `least` occurrences: lang, w1, w2, ..., n.
    The row without words, kept always, counts all words of its language.

    Windows stand in prefix order, so that those which share their first words stand together: one walk over the
    stream adds up every beginning. A sum at the edge of a batch may be a part and is added to the others' parts.
    """
    names = [c for c in counted.columns if c.startswith("w")]
    keys = ["lang", *names]
    stored = written(counted, "windows")
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in keys]
            n, shared = np.asarray(batch.column("n"), dtype=np.int64), np.append(-1, _same(columns))
            size = sum(np.asarray(c.is_valid()).astype(np.int64) for c in columns[1:])
            for k in range(len(names) + 1):
                rows = np.flatnonzero(size == 0) if k == 0 else np.flatnonzero(size >= k)
                if not len(rows):
                    continue
                # a row begins a group unless it shares k words (and the language) with the row before
                begin = np.flatnonzero(np.minimum.reduceat(shared[: rows[-1] + 1], np.append(0, rows[:-1] + 1)) < k + 1) if k else np.arange(len(rows))
                begin = np.union1d([0], begin).astype(np.int64)
                total = np.add.reduceat(n[rows], begin)
                keep = (total >= least) | (k == 0)
                keep[[0, -1]] = True
                at = pa.array(rows[begin[keep]])
                cut = [c.take(at) for c in columns[: k + 1]] + [pa.nulls(len(at), pa.string())] * (len(names) - k)
                yield pa.RecordBatch.from_arrays([*cut, pa.array(total[keep])], [*keys, "n"])

    streamed = stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(walk, stored.schema)
    summed = streamed.groupBy(*keys).agg(F.sum("n").alias("n"))
    return summed.filter((F.col("n") >= least) | F.col("w1").isNull())


def _heads(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The beginnings of the first row of each part, the empty one included, with their rows: at most a few per part."""
    heads = stored.groupBy("part").agg(F.min(F.struct(*keys)).alias("h")).select("part", "h.*")
    depth = F.explode(F.sequence(F.lit(0), F.lit(len(keys) - 2))).alias("depth")
    wanted = heads.withColumn("size", _size(keys[1:])).select("*", depth).filter("depth < size")
    wanted = wanted.select("part", "lang", *[F.when(F.col("depth") > i, F.col(c)).alias(c) for i, c in enumerate(keys[1:])])
    wanted = wanted.withColumnsRenamed({c: f"h_{c}" for c in ["part", *keys]})
    equal = [F.col(f"h_{c}").eqNullSafe(F.col(c)) for c in keys]
    return stored.drop("part").join(F.broadcast(wanted), equal).select(*[c for c in stored.columns if c != "part"], F.col("h_part").alias("part"))


def walked(counts: DataFrame, keys: list[str], chain: str, extra: list[str]) -> DataFrame:
    """Each row of a count stream (keys in order, n, extra columns) with the counts of its own beginnings of 1, 2, ...
    words as `chain`1, ..., that of no words as `total`, and the largest count of the rows one word longer as `more`.

    The stream is dealt in ranges of its order, sorted, and read once: the latest row of a length is the beginning
    of all that follow. Every range starts with the beginnings of its first row. A row whose extensions fall into
    several ranges or batches comes once for each; the caller takes the largest `more`.
    """
    spark, depth = counts.sparkSession, len(keys) - 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.select(*keys, "n", *extra).repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id())
    stored = written(ranged, "stream")
    stream = stored.unionByName(_heads(stored, keys)).repartitionById(parts, F.pmod("part", F.lit(parts)).cast("int")).sortWithinPartitions("part", *keys)
    made = [f"{chain}{k}" for k in range(1, depth)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.RecordBatch | None = None  # the latest row of each length
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ is not None:
                batch = pa.Table.from_batches([open_, batch]).combine_chunks().to_batches()[0]
            n = np.asarray(batch.column("n"), dtype=np.int64)
            size = sum(np.asarray(batch.column(c).is_valid()).astype(np.int64) for c in keys[1:])
            last = np.empty((depth + 1, len(n)), np.int64)
            for k in range(depth + 1):
                last[k] = np.maximum.accumulate(np.where(size == k, np.arange(len(n)), -1))
            more = np.zeros(len(n), np.int64)
            rows = np.flatnonzero(size > 0)
            np.maximum.at(more, last[size[rows] - 1, rows], n[rows])
            chains = [np.where(size > k, n[last[k]], 0) for k in range(1, depth)]
            out = [batch.column(c) for c in [*keys, "n", *extra]] + [pa.array(n[last[0]]), *map(pa.array, chains), pa.array(more)]
            yield pa.RecordBatch.from_arrays(out, [*keys, "n", *extra, "total", *made, "more"])
            final = last[: size[-1] + 1, -1]
            open_ = batch.take(pa.array(final))

    kinds = {f.name: f.dataType.simpleString() for f in stored.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in [*keys, "n", *extra]] + [f"{c} long" for c in ["total", *made, "more"]])
    return stream.mapInArrow(walk, schema)


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000, slice_bytes: int = _SLICE) -> DataFrame:
    """The phrases of 2 to `longest` words of each language that keep company the most: lang, rank, phrase, a, l, r, n, score.

    a counts the phrase (at least `least`), l and r the two sides of its weakest cut, n all words; score is
    floor(1000 a n / (l r)), exact. A phrase inside a longer one with share % of its count goes: it is enough to look
    at phrases one word longer, whose count is the largest. Texts without a language count as `und`, null texts as empty;
    a table without words gives no rows, repeated rows count as often as they come, and other columns stay behind.
    """
    words = [f"w{i + 1}" for i in range(longest)]
    back = [f"v{i + 1}" for i in range(longest)]
    before, after = [f"p{k}" for k in range(1, longest)], [f"s{k}" for k in range(1, longest)]
    counts = frequent(windows(docs, least, longest, slice_bytes=slice_bytes), least)
    whole = lambda df, keys, extra: df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in extra])
    prefix = whole(walked(counts, ["lang", *words], "p", []), ["lang", *words], ["n", *before, "more"])
    turned = F.reverse(F.array_compact(F.array(*words)))
    prefix = prefix.select("lang", turned.alias("v"), "n", *before, F.col("more").alias("right"))
    prefix = prefix.select("lang", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(back)], "n", *before, "right")
    suffix = whole(walked(prefix, ["lang", *back], "s", [*before, "right"]), ["lang", *back], ["n", *before, "right", "total", *after, "more"])
    kept = suffix.filter("v2 IS NOT NULL").filter(100 * F.greatest("more", "right") < share * F.col("n"))
    wide = lambda c: F.col(c).cast("decimal(17,0)")
    size, cuts = _size(back), []
    for k in range(1, longest):
        right = F.coalesce(*[F.when(size - k == j, F.col(f"s{j}")) for j in range(1, longest)])
        cuts.append(F.when(size > k, F.struct(F.lit(k).alias("k"), F.col(f"p{k}").alias("l"), right.alias("r"))))
    score = F.expr("cast(1000 as decimal(4,0)) * cast(n as decimal(17,0)) * cast(total as decimal(17,0)) div (cast(c.l as decimal(17,0)) * cast(c.r as decimal(17,0)))")
    phrase = F.array_join(F.reverse(F.array_compact(F.array(*back))), " ")
    each = kept.select("lang", phrase.alias("phrase"), "n", "total", F.array_compact(F.array(*cuts)).alias("cuts"))
    each = each.select("lang", "phrase", "n", "total", F.explode("cuts").alias("c")).withColumn("score", score)
    least_cut = each.groupBy("lang", "phrase", "n", "total").agg(F.min(F.struct("score", "c.k", "c.l", "c.r")).alias("c"))
    rows = least_cut.select("lang", "phrase", F.col("n").alias("a"), "c.l", "c.r", F.col("total").alias("n"), "c.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = rows.withColumn("rank", place).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

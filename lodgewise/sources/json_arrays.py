"""JSON files that hold one large array, read by many tasks.

A brace is one byte that no other character holds, so Spark can cut a file behind any of them. Whether it stands inside
a text, and how deep, depends on all that came before: each part of a file is scanned for both possible beginnings,
running sums over the parts tell which one holds, and a second scan cuts out the records.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from lodgewise.operators.records import with_content_id
from lodgewise.schema import CORRUPT, raw_schema
from lodgewise.sources.feeds import read_feed, without_junk

_QUOTE, _SLASH, _OPEN, _CLOSE = b'"\\{}'
_FILLER = b" \t\r\n[],\xef\xbb\xbf"  # what may stand between records


def _segments(spark: SparkSession, path, pattern: str) -> DataFrame:
    """Text up to each closing brace, in the order of the file within a part (`part`: its first byte)."""
    text = spark.read.option("lineSep", "}").option("pathGlobFilter", pattern).text(path)
    meta = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("part")]
    return without_junk(text.select("value", *meta)).select("value", F.xxhash64("source_file").alias("file"), "part")


def _files(spark: SparkSession, path, pattern: str) -> DataFrame:
    """The files as Spark lists them, with their sizes; their content is not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    rows = listed.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("source_bytes"))
    return without_junk(rows).select(F.xxhash64("source_file").alias("file"), "source_file", "source_bytes").distinct()


def _bytes_of(values: pa.Array) -> np.ndarray:
    """All segments one after the other, each with its brace again."""
    binary = values.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if binary.buffers()[2] else np.zeros(0, np.uint8)
    return np.insert(data, offsets[1:] - offsets[0], _CLOSE)


class _Scan:
    """Braces of the bytes of a part, piece by piece: place, +1 or -1, and whether an odd number of quotes precedes."""

    def __init__(self):
        self.odd = self.slashes = 0

    def braces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slash = np.flatnonzero(data == _SLASH)
        order = np.arange(len(slash))
        begins = np.maximum.accumulate(np.where(np.diff(slash, prepend=-2) != 1, order, 0))  # of each run of them
        run = order - begins + 1 + np.where(slash[begins] == 0, self.slashes, 0)

        def slashes_before(at: np.ndarray) -> np.ndarray:
            place = np.searchsorted(slash, at) - 1
            there = (place >= 0) & (slash[place] == at - 1) if len(slash) else np.zeros(len(at), bool)
            return np.where(there, run[place] if len(slash) else 0, np.where(at == 0, self.slashes, 0))

        quotes = np.flatnonzero(data == _QUOTE)
        quotes = quotes[slashes_before(quotes) % 2 == 0]
        place = np.flatnonzero((data == _OPEN) | (data == _CLOSE))
        inside = (np.searchsorted(quotes, place) + self.odd) % 2
        self.slashes = int(slashes_before(np.array([len(data)]))[0])
        self.odd = (self.odd + len(quotes)) % 2
        return place, np.where(data[place] == _OPEN, 1, -1), inside


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of one part each, and whether the part ends with the slice."""
    waiting = None
    for batch in batches:
        keys = np.asarray(batch.column("file")), np.asarray(batch.column("part"))
        edges = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1 if batch.num_rows else np.zeros(0, int)
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if a == b:
                continue
            piece = batch.slice(a, b - a)
            if waiting is not None:
                yield waiting, _key(waiting) != _key(piece)
            waiting = piece
    if waiting is not None:
        yield waiting, True


def _key(batch: pa.RecordBatch) -> tuple:
    return batch.column("file")[0].as_py(), batch.column("part")[0].as_py()


_SUMMARY = "file long, part long, n_bytes long, odd int, depth0 long, depth1 long, low0 long, low1 long, least0 long, least1 long"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part, for a beginning outside (0) and inside (1) a text: how the depth changes, its minimum, and the minimum
    without the last brace (which a file may not have)."""
    scan, n, depth, low, least = _Scan(), 0, [0, 0], [0, 0], [0, 0]
    for batch, ends in _parts(batches):
        data = _bytes_of(batch.column("value"))
        place, step, inside = scan.braces(data)
        n += len(data)
        for s in (0, 1):
            levels = depth[s] + np.cumsum(np.where(inside == s, step, 0))
            low[s] = min(least[s], int(levels[:-1].min(initial=0)))
            least[s] = min(low[s], int(levels[-1]))
            depth[s] = int(levels[-1])
        if ends:
            row = [*_key(batch), n, scan.odd, *depth, *low, *least]
            kinds = [pa.int32() if i == 3 else pa.int64() for i in range(10)]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [c.split()[0] for c in _SUMMARY.split(", ")])
            scan, n, depth, low, least = _Scan(), 0, [0, 0], [0, 0], [0, 0]


def _states(summaries: DataFrame, files: DataFrame) -> DataFrame:
    """Per part: inside a text at its beginning or not, depth there, the part where the record begun last began, whether
    the file's last brace is not really there, and whether the braces of the file pair."""
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    rows = summaries.withColumn("text", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    pick = lambda name: F.when(F.col("text") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    rows = rows.select("file", "part", "n_bytes", "odd", "text", pick("depth").alias("change"), pick("low").alias("low"), pick("least").alias("least"))
    rows = rows.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    rows = rows.withColumn("closes", (F.col("depth") == 0) | (F.col("depth") + F.col("least") <= 0))
    rows = rows.withColumn("opener", F.max(F.when(F.col("closes"), F.col("part"))).over(before))
    rows = rows.join(files.select("file", "source_bytes"), "file")
    rows = rows.withColumn("surplus", F.sum("n_bytes").over(whole) - F.col("source_bytes"))
    last = F.col("part") == F.max("part").over(whole)
    end = F.col("depth") + F.col("change")
    ends_in_text = F.sum("odd").over(whole) % 2 == 1
    bad = (F.col("depth") + F.col("low") < 0) | F.when(last, end != -F.col("surplus")).otherwise(end < 0) | ends_in_text | ~F.col("surplus").isin(0, 1)
    rows = rows.withColumn("damaged", F.max(bad).over(whole))
    return rows.select("file", "part", F.col("text").cast("int").alias("text"), "depth", "opener", (last & (F.col("surplus") == 1)).alias("cut"), "damaged")


def _records(batches: Iterator[pa.RecordBatch], crossing: bool) -> Iterator[pa.RecordBatch]:
    """Records that lie in one part (`opener` null), or with `crossing` the pieces of the others under the part where
    they begin."""
    scan, depth, opener, held = None, 0, None, []
    for batch, ends in _parts(batches):
        file, part = _key(batch)
        if scan is None:
            scan, held = _Scan(), []
            scan.odd, depth, opener = (batch.column(c)[0].as_py() for c in ("text", "depth", "opener"))
            opener = opener if depth else None  # a record that begins here is named after this part
        data = _bytes_of(batch.column("value"))
        if ends and batch.column("cut")[0].as_py():
            data = data[:-1]
        place, step, inside = scan.braces(data) if len(data) else (np.zeros(0, np.int64),) * 3
        place, step = place[inside == 0], step[inside == 0]
        after = depth + np.cumsum(step)
        stops = (place[after == 0] + 1).tolist()
        begins = place[(after == 1) & (step == 1)].tolist()
        raw, at, out = data.tobytes(), 0, []
        if depth > 0:
            begins = [0, *begins]
        spans = list(zip(begins, [*stops, None] if len(stops) < len(begins) else stops, strict=True))
        if crossing and len(spans) > 2:  # what lies between the first and the last one ends where it begins
            spans = [spans[0], spans[-1]]
        for begin, stop in spans:
            if not crossing and depth == 0 and (other := raw[at:begin].strip(_FILLER)):
                out.append((None, other))
            held.append(raw[begin:stop])
            if stop is None:
                break
            out.append((opener, b"".join(held)))
            at, depth, opener, held = stop, 0, None, []
        else:
            if not crossing and (other := raw[at:].strip(_FILLER)):
                out.append((None, other))
        depth = int(after[-1]) if len(after) else depth
        if ends:
            if depth > 0:
                out.append((part if opener is None else opener, b"".join(held)))
            scan = None
        if out := [x for x in out if (x[0] is not None) == crossing]:
            columns = [pa.array([file] * len(out)), pa.array([part] * len(out)), pa.array([o for o, _ in out], pa.int64()), pa.array([t.decode("utf-8", "replace") for _, t in out])]
            yield pa.RecordBatch.from_arrays(columns, ["file", "part", "opener", "value"])


def record_texts(spark: SparkSession, path, pattern: str = "*.json") -> tuple[DataFrame, list[str]]:
    """(value, source_file, source_bytes), one row per object of the files, and the files whose braces don't pair.

    Objects may stand in one array, in several, or one after the other; other values between them come as they are. A
    record over several parts is put together from their pieces, so a task holds one record more than it reads.
    """
    segments, files = _segments(spark, path, pattern), _files(spark, path, pattern)
    known = segments.mapInArrow(_summaries, _SUMMARY)
    states = _states(known, files)
    damaged = [r.source_file for r in states.filter("damaged").select("file").distinct().join(files, "file").collect()]  # files, as Spark lists them
    placed = segments.join(F.broadcast(states.filter("NOT damaged").drop("damaged")), ["file", "part"])  # a row per task's share
    found = "file long, part long, opener long, value string"
    pieces = placed.mapInArrow(functools.partial(_records, crossing=True), found).groupBy("file", "opener").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("p"))
    joined = pieces.select("file", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    whole = placed.mapInArrow(functools.partial(_records, crossing=False), found).select("file", "value").unionByName(joined)
    return whole.join(F.broadcast(files), "file").select("value", "source_file", "source_bytes"), damaged


def read_arrays(spark: SparkSession, path, schema: T.StructType | None = None, pattern: str = "*.json") -> DataFrame:
    """The rows of `read_feed`, from files of any size: how many tasks read a file follows from its bytes.

    What is no object is kept in the corrupt column, if the schema has one. Files whose braces don't pair go to one task
    each, as in `read_feed`.
    """
    schema = schema or raw_schema()
    texts, damaged = record_texts(spark, path, pattern)
    options = {"columnNameOfCorruptRecord": CORRUPT} if CORRUPT in schema.names else {}
    rows = texts.select(F.from_json("value", schema, options).alias("r"), "source_file", "source_bytes").select("r.*", "source_file", "source_bytes")
    out = with_content_id(rows, "source_file")
    return out.unionByName(read_feed(spark, damaged, schema, pattern=pattern)) if damaged else out

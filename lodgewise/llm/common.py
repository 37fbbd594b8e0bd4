"""What the operators of this package share: bounded text slices, chunks of text, shared scratch tables."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgewise.session import shared_folder

SLICE_BYTES = 4 << 20
KEEP_BYTES = 192 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, name: str, batch: str = "8m") -> DataFrame:
    """Write a table once in the shared folder and read it back: cuts the lineage and survives lost executors.

    While it is written, Python tasks get batches of at most `batch` bytes.
    """
    spark = df.sparkSession
    path, before = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, batch)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before) if before else spark.conf.unset(_BATCH)
    return spark.read.schema(df.schema).parquet(path)


def plain_docs(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id`, `text` (null: empty) and the named columns; whatever else the table holds stays behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have at most `limit` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and the offset of each text (one more at the end)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets at which texts may be cut without a change to the tokens of the public vocabularies.

    A cut lies before a space or line feed that follows a visible ASCII character or a letter of two bytes:
    no token of those vocabularies holds white space behind another character. Fewer cuts are always right.
    """
    blank = (data == 32) | (data == 10)
    cut = np.zeros(len(data), bool)
    if len(data) > 2:
        ascii_before = (data[:-1] >= 33) & (data[:-1] <= 126)
        two_before = np.zeros(len(data) - 1, bool)
        two_before[1:] = (data[1:-1] >= 0x80) & (data[1:-1] <= 0xBF) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
        cut[1:] = blank[1:] & (ascii_before | two_before)
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


class Chunks:
    """The distinct chunks of a slice of texts and the place of each in the texts."""

    def __init__(self, column: pa.Array):
        data, offsets = raw_bytes(column)
        starts = chunk_starts(data, offsets)
        bounds = np.append(starts, len(data)).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = array.dictionary_encode()
        self.distinct: list[bytes] = coded.dictionary.to_pylist()
        self.codes = np.asarray(coded.indices, dtype=np.int64)
        self.first = np.searchsorted(starts, offsets)  # index of the first chunk of each text, one more at the end
        self.n_bytes = np.diff(offsets)


class Kept(dict):
    """What a worker remembers of chunks: at most `limit` bytes, counted with what Python adds to each entry."""

    def __init__(self, limit: int):
        self.limit, self.bytes = limit, 0

    def take_in(self, chunks: list[bytes], each: int = 200) -> None:
        """Count chunks about to be added; if they leave no room, everything older goes."""
        more = sum(map(len, chunks)) + each * len(chunks)
        if self.bytes + more > self.limit:
            self.clear()
            self.bytes = 0
        self.bytes += more


def released() -> None:
    """Give freed memory back to the system: a worker that Spark uses again would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


class TokenStore:
    """Ids of distinct chunks, kept by a worker over its tasks, in at most `keep` bytes.

    When these are used up, the chunks of the slice at hand stay and all others go. Chunks of one slice that need more
    are held until the next slice comes.
    """

    _kept: dict[str, TokenStore] = {}

    def __init__(self, path: str, keep: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self._fill({}, np.zeros(0, np.uint32), np.zeros(0, np.int64))

    @classmethod
    def of(cls, path: str, keep: int = KEEP_BYTES) -> TokenStore:
        store = cls._kept[path] = cls._kept.get(path) or cls(path, keep)
        store.keep = keep
        return store

    def _fill(self, place: dict[bytes, int], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place, self.pool, self.sizes = place, ids, sizes
        self.bytes = sum(map(len, place)) + 200 * len(place) + 4 * len(ids)

    def _pick(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at these places, one after the other, and how many each has."""
        ends, each = np.cumsum(self.sizes), self.sizes[places]
        stops = np.cumsum(each)
        return self.pool[np.repeat(ends[places] - stops, each) + np.arange(stops[-1] if len(stops) else 0)], each

    def _learn(self, new: list[bytes]) -> None:
        pools, sizes = [self.pool], [self.sizes]
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            got = [x.ids for x in self.tokenizer.encode_batch_fast([c.decode() for c in some], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            pools.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.pool, self.sizes = np.concatenate(pools), np.concatenate(sizes)
        self.bytes += sum(map(len, new)) + 200 * len(new) + 4 * int(sum(map(len, pools[1:])))

    def ids(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with `end_id` behind it, and the offset of each text."""
        chunks = Chunks(column)
        if self.bytes > self.keep:
            held = [(c, p) for c in chunks.distinct if (p := self.place.get(c)) is not None]
            ids, sizes = self._pick(np.array([p for _, p in held], np.int64))
            self._fill({c: i for i, (c, _) in enumerate(held)}, ids, sizes)
        self._learn([c for c, p in zip(chunks.distinct, map(self.place.get, chunks.distinct), strict=True) if p is None])
        places = np.fromiter(map(self.place.__getitem__, chunks.distinct), np.int64, len(chunks.distinct))
        last = chunks.first[1:] + np.arange(len(chunks.first) - 1)  # where the end ids go
        codes = np.empty(len(chunks.codes) + len(last), np.int64)
        own = np.ones(len(codes), bool)
        own[last] = False
        codes[own], codes[last] = places[chunks.codes] if len(places) else 0, len(self.sizes)
        self.pool, self.sizes = np.append(self.pool, np.uint32(end_id)), np.append(self.sizes, 1)
        flat, each = self._pick(codes)
        self.pool, self.sizes = self.pool[:-1], self.sizes[:-1]
        return flat, np.concatenate([[0], np.cumsum(each)[last]]).astype(np.int64)

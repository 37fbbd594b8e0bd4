"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lodgewise.llm.common import KEEP_BYTES, SLICE_BYTES, TokenStore, plain_docs, released, slices, written

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PART_BITS = 33  # low bits of a sequence id: the number of the sequence in its partition


class Windows:
    """Open windows of one partition: best fit first, the fullest leaves when a piece fits nowhere."""

    def __init__(self, size: int, keep: int, least_cut: int):
        self.size, self.keep, self.least_cut = size, keep, least_cut
        self.free: list[tuple[int, int]] = []  # (free places, window), sorted
        self.made = 0

    def place(self, length: int) -> Iterator[tuple[int, int, int, int | None]]:
        """Yield (window, offset in it, tokens taken, window that closes now)."""
        while length > 0:
            at = bisect_left(self.free, (length, -1))
            if length >= self.size:
                at = len(self.free)
            if at < len(self.free):
                room, window = self.free.pop(at)
                closed = window if room == length else None
                if closed is None:
                    insort(self.free, (room - length, window))
                yield window, self.size - room, length, closed
                return
            if length < self.size and len(self.free) >= self.keep:
                room, window = self.free.pop(0)
                taken = room if room >= self.least_cut and length - room >= self.least_cut else 0
                yield window, self.size - room, taken, window
                length -= taken
                continue
            taken = min(length, self.size)
            window, self.made = self.made, self.made + 1
            if taken < self.size:
                insort(self.free, (self.size - taken, window))
            yield window, 0, taken, window if taken == self.size else None
            length -= taken


def _pack_partitions(docs: DataFrame, tokenizer_path: str, end_id: int, size: int, keep: int, least_cut: int, with_ids: bool, keep_bytes: int, slice_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, windows = TokenStore.of(tokenizer_path, keep_bytes), Windows(size, keep, least_cut)
        waiting: dict[int, list[tuple]] = {}
        done: list[tuple] = []

        def rows(pieces: list[tuple], is_open: bool) -> pa.RecordBatch:
            columns = [list(x) for x in zip(*pieces, strict=True)] or [[]] * 8
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            arrays += [pa.array([is_open] * len(pieces), pa.bool_()), pa.array([part] * len(pieces), pa.int64())]
            names += ["open", "lane"]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in slices(batches, limit=slice_bytes):
            flat, offsets = store.ids(batch.column("text"), end_id)
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                start = 0
                for window, offset, taken, closed in windows.place(b - a):
                    if taken:
                        ids = flat[a + start : a + start + taken].astype("<u4").tobytes()
                        piece = (doc_id, start, taken, zlib.crc32(ids), b - a, part << _PART_BITS | window, offset, ids if with_ids else None)
                        waiting.setdefault(window, []).append(piece)
                        start += taken
                    if closed is not None:
                        done += waiting.pop(closed)
            if done:
                yield rows(done, False)
                done = []
        left = [p for pieces in waiting.values() for p in pieces]
        if left:
            yield rows(left, True)
        released()

    schema = f"{_PIECE}, open boolean, lane long" + (", ids binary" if with_ids else "")
    return plain_docs(docs).mapInArrow(run, schema)


def _merge(pieces: pd.DataFrame, size: int, keep: int, last: bool) -> pd.DataFrame:
    """Put open windows into one another, the fullest first, each where least room is left."""
    fill = pieces.groupby("sequence_id")["length"].sum()
    order = sorted(fill.items(), key=lambda x: (-x[1], x[0]))
    free: list[tuple[int, int]] = []
    target: dict[int, tuple[int, int]] = {}
    for window, used in order:
        at = bisect_left(free, (used, -1))
        if at < len(free):
            room, host = free.pop(at)
            target[window] = (host, size - room)
            insort(free, (room - used, host))
        else:
            target[window] = (window, 0)
            insort(free, (size - used, window))
    stays = set() if last else {w for room, w in free[-keep:] if room > 0}
    moved = pieces["sequence_id"].map(target)
    pieces = pieces.copy()
    pieces["offset"] += moved.str[1].astype("int64")
    pieces["sequence_id"] = moved.str[0].astype("int64")
    pieces["open"] = pieces["sequence_id"].isin(stays)
    return pieces


def _merger(size: int, keep: int, last: bool):
    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        out = _merge(pieces, size, keep, last)
        if out["doc_id"].dtype.kind == "f":  # pandas reads ids as floats where one is null
            out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return merge


def pack(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, keep: int = 64, least_cut: int = 32,
    fan: int = 16, with_ids: bool = False, keep_bytes: int = KEEP_BYTES, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Pack documents into sequences of at most `size` tokens; one row per piece.

    Each partition keeps at most `keep` open windows. A piece goes where the least room remains; when it fits
    nowhere the fullest window leaves, filled up with the head of the piece if both parts have `least_cut` tokens.
    The windows still open at the end are merged over `fan` partitions at a time until one group is left, so a
    task never holds more than `fan * keep` of them. `with_ids` adds the ids of each piece (little-endian, 4 bytes). A worker
    remembers chunks of text with their ids in at most `keep_bytes`, and takes `slice_bytes` of text at once.

    A null text is empty and packs its end id; a null doc_id stays null; repeated rows are packed each; an empty
    table gives no rows; other columns of `docs` are not read.
    """
    first = written(_pack_partitions(docs, tokenizer_path, end_id, size, keep, least_cut, with_ids, keep_bytes, slice_bytes), "packed")
    names = [c for c in first.columns if c not in ("open", "lane")]
    parts = [first.filter(~F.col("open")).select(*names)]
    left, lanes = first.filter("open"), max(1, docs.rdd.getNumPartitions())
    while True:
        lanes = -(-lanes // fan)
        last = lanes == 1
        grouped = left.withColumn("lane", F.floor(F.col("lane") / fan).cast("long")).groupBy("lane")
        merged = grouped.applyInPandas(_merger(size, keep, last), first.schema)
        if last:
            parts.append(merged.select(*names))
            break
        merged = written(merged, "leftovers")
        parts.append(merged.filter(~F.col("open")).select(*names))
        left = merged.filter("open")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

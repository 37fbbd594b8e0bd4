"""Token ids in compressed files: blocks of an adaptive context-mixing range coder, in the order of doc_id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodgewise.llm import codec
from lodgewise.llm.common import TokenStore, plain_docs, released, slices

#: A row of a file: a run of whole documents. Number of the partition and of the row in it, ids before it in the
#: partition, ids in it; doc_ids (8 bytes each, little-endian, like all that follow) with a bit per null, ids per
#: document (8 bytes), and of each block words (4 bytes), crc32 (4 bytes) and the words one after the other.
_FILE = "part long, row long, before long, n_ids long, doc_ids binary, nulls binary, lengths binary, sizes binary, crcs binary, payload binary"


class _Rows:
    """Documents waiting to be coded: rows of at least `row_ids` ids, coded when there are enough blocks for two full runs."""

    def __init__(self, block: int, row_ids: int, bits: int):
        self.block, self.row_ids, self.bits = block, row_ids, bits
        self.part, self.made, self.before = TaskContext.get().partitionId(), 0, 0
        self.closed: list[tuple] = []
        self.open: list[tuple] = []  # (doc_id, ids)
        self.n_open = self.n_blocks = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.open.append((doc_id, ids))
        self.n_open += len(ids)
        if self.n_open >= self.row_ids:
            self.close()

    def close(self) -> None:
        if self.open:
            flat = np.concatenate([x for _, x in self.open]).astype(np.uint32)
            docs = [d for d, _ in self.open]
            lengths = np.array([len(x) for _, x in self.open], "<i8")
            self.closed.append((self.made, self.before, flat, docs, lengths))
            self.made, self.before = self.made + 1, self.before + len(flat)
            self.n_blocks += -(-len(flat) // self.block)
            self.open, self.n_open = [], 0

    def coded(self) -> pa.RecordBatch:
        blocks = [flat[i : i + self.block] for _, _, flat, _, _ in self.closed for i in range(0, len(flat), self.block)]
        payloads, at, columns = codec.encode(blocks, self.bits), 0, [[] for _ in range(10)]
        for row, before, flat, docs, lengths in self.closed:
            own = payloads[at : at + -(-len(flat) // self.block)]
            at += len(own)
            nulls = np.packbits([d is None for d in docs]).tobytes()
            ids = np.array([d or 0 for d in docs], "<i8").tobytes()
            sizes = np.array([len(x) // 2 for x in own], "<u4").tobytes()
            crcs = np.array([zlib.crc32(x) for x in own], "<u4").tobytes()
            for c, v in zip(columns, (self.part, row, before, len(flat), ids, nulls, lengths.tobytes(), sizes, crcs, b"".join(own)), strict=True):
                c.append(v)
        self.closed, self.n_blocks = [], 0
        kinds = [pa.int64()] * 4 + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _FILE.split(", ")])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, block: int = 2048, row_ids: int = 1 << 16) -> None:
    """Write the ids of whole texts, each with `end_id` behind it, to new files below `path`, in ascending doc_id order.

    Null texts are empty, null doc_ids come first, equal doc_ids stand in the order of their texts. Spark's writer
    commits the files, so a lost executor leaves no half-written one. Blocks of `block` ids can be read alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = TokenStore.of(tokenizer_path)
        rows = _Rows(block, row_ids, (max(store.tokenizer.get_vocab_size(), end_id) + 1).bit_length())
        for batch in slices(batches):
            flat, offsets = store.ids(batch.column("text"), end_id)
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                rows.add(doc_id, flat[a:b])
                if rows.n_blocks >= 2 * codec.LANES:
                    yield rows.coded()
        rows.close()
        if rows.closed:
            yield rows.coded()
        released()

    ordered = plain_docs(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, _FILE).write.parquet(path)


def _decoded(batch: pa.RecordBatch, block: int, bits: int) -> Iterator[tuple[dict, np.ndarray]]:
    rows = [{c: batch.column(c)[i].as_py() for c in batch.schema.names} for i in range(batch.num_rows)]
    payloads, sizes = [], []
    for r in rows:
        at, left = 0, r["n_ids"]
        for n, crc in zip(np.frombuffer(r["sizes"], "<u4").tolist(), np.frombuffer(r["crcs"], "<u4").tolist(), strict=True):
            own = r["payload"][at : at + 2 * n]
            if zlib.crc32(own) != crc:
                raise ValueError(f"a block of row {r['row']} of part {r['part']} is damaged")
            payloads.append(own)
            sizes.append(min(block, left))
            at, left = at + 2 * n, left - min(block, left)
    ids, at = codec.decode(payloads, sizes, bits), 0
    for r in rows:
        n = len(r["sizes"]) // 4
        yield r, np.concatenate(ids[at : at + n]) if n else np.zeros(0, np.int64)
        at += n


def read_token_files(spark: SparkSession, path: str, bits: int, block: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (and the ids, 4 bytes each).

    Every block is checked. `start` counts the ids of all documents before: those of the partition stand in the
    files, and of the partitions before only one sum each is added up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, blocks = [], 0

        def out(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r, ids in _decoded(pa.concat_batches(some), block, bits):
                lengths = np.frombuffer(r["lengths"], "<i8")
                ends = np.cumsum(lengths)
                null = np.unpackbits(np.frombuffer(r["nulls"], np.uint8))[: len(lengths)].astype(bool)
                raw = ids.astype("<u4")
                own = [raw[b - n : b].tobytes() for n, b in zip(lengths.tolist(), ends.tolist(), strict=True)]
                arrays = [
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=null), pa.array([r["part"]] * len(lengths), pa.int64()), pa.array(ends - lengths + r["before"]),
                    pa.array(lengths), pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                names = ["doc_id", "part", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(own, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for i in range(batch.num_rows):
                waiting.append(batch.slice(i, 1))
                blocks += len(waiting[-1].column("sizes")[0].as_py()) // 4
                if blocks >= 2 * codec.LANES:
                    yield from out(waiting)
                    waiting, blocks = [], 0
        if waiting:
            yield from out(waiting)

    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before: Column = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(F.col("part").alias("_part"), before.alias("before"))  # a row per partition written
    schema = "doc_id long, part long, inside long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    found = files.mapInArrow(run, schema).join(F.broadcast(offsets), F.col("part") == F.col("_part"))
    return found.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def vocabulary_bits(tokenizer_path: str, end_id: int = 1) -> int:
    from tokenizers import Tokenizer

    return (max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id) + 1).bit_length()

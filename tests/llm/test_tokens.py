"""Counts, packing and token files against the libraries."""

import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import CLASH, EMPTY, docs_frame, texts
from tokenizers import Tokenizer

from lodgewise.llm import codec, packing, token_files
from lodgewise.llm.token_counts import count_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, text, end_id=1):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")


def test_counts_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in count_tokens(docs_frame(spark, rows), PIECES, limit=20).collect()}
    for i, t in rows:
        want = len(model.encode(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len((t or "").encode()), want > 20), t


@pytest.mark.parametrize("size,keep,cut", [(16, 1, 4), (64, 3, 8), (2048, 64, 32)])
def test_packing_places_every_id_once(spark, size, keep, cut):
    rows = [(i, t) for i, t in enumerate(texts() * 3)]
    docs = docs_frame(spark, rows).repartition(7)
    pieces = packing.pack(docs, BYTES, size=size, keep=keep, least_cut=cut, fan=2, with_ids=True).toPandas()
    for i, t in rows:
        own, ids = pieces[pieces.doc_id == i].sort_values("start"), ids_of(BYTES, t)
        assert b"".join(own.ids) == ids.tobytes() and set(own.doc_tokens) == {len(ids)}
        assert list(own.start) == [0, *np.cumsum(own.length)[:-1]]
        assert [zlib.crc32(x) for x in own.ids] == list(own.ids_crc32)
    for _, window in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(window.offset) == [0, *np.cumsum(window.length)[:-1]] and window.length.sum() <= size
    if size == 64:
        used = pieces.groupby("sequence_id").length.sum()
        assert used.sum() / (size * len(used)) > 0.9


def test_windows_take_the_best_fit_and_let_the_fullest_go():
    windows = packing.Windows(10, 2, 10)
    assert list(windows.place(4)) == [(0, 0, 4, None)]
    assert list(windows.place(7)) == [(1, 0, 7, None)]
    assert list(windows.place(3)) == [(1, 7, 3, 1)]  # fills window 1 although window 0 has room
    assert list(windows.place(8)) == [(2, 0, 8, None)]
    assert list(windows.place(7)) == [(2, 8, 0, 2), (3, 0, 7, None)]  # nothing fits: the fullest leaves


def test_files_hold_whole_texts_in_order(spark, tmp_path):
    rows = [(i * 7 % 101 - 5, t) for i, t in enumerate(texts() * 2)]
    docs = docs_frame(spark, rows).repartition(5)
    token_files.write_token_files(docs, f"{tmp_path}/ids", WORDS, block=16, row_ids=100)
    got = token_files.read_token_files(spark, f"{tmp_path}/ids", token_files.vocabulary_bits(WORDS), block=16, with_ids=True).toPandas().sort_values("start")
    start = 0
    for r in got.itertuples():
        ids = ids_of(WORDS, dict(rows)[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        start += len(ids)
    assert list(got.doc_id) == sorted(got.doc_id) and len(got) == len(rows)


def test_damaged_blocks_are_found(spark, tmp_path):
    from pyspark.sql import functions as F

    token_files.write_token_files(docs_frame(spark, [(1, "one two three")]), f"{tmp_path}/ids", WORDS)
    damaged = spark.read.parquet(f"{tmp_path}/ids").withColumn("payload", F.concat(F.lit(b"\x01\x02"), F.substring("payload", 3, 1000)))
    damaged.write.parquet(f"{tmp_path}/damaged")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_token_files(spark, f"{tmp_path}/damaged", 16).collect()


@pytest.mark.parametrize("bits,top", [(16, 65534), (18, 200_000), (4, 12)])
def test_codec_round_trip(bits, top):
    rng = np.random.default_rng(bits)
    blocks = [rng.integers(0, top + 1, n) for n in (0, 1, 2, 700, 33)] + [np.full(500, top), np.zeros(500, int), np.tile(np.arange(min(top, 9)), 60)]
    coded = codec.encode(blocks, bits)
    for got, want in zip(codec.decode(coded, [len(b) for b in blocks], bits), blocks, strict=True):
        assert np.array_equal(got, want)
    assert len(coded[-1]) < len(blocks[-1]) * bits / 8 / 3  # repetition is learnt


def test_codec_models_ids_better_than_a_general_compressor():
    """Ids without any context: only their frequencies can be learnt. Each block is coded from nothing."""
    rng = np.random.default_rng(5)
    blocks = [np.minimum(rng.zipf(1.3, 2048), 49_000) for _ in range(12)]
    coded = codec.encode(blocks, 16)
    for block, own in zip(blocks, coded, strict=True):
        share = np.unique(block, return_counts=True)[1] / len(block)
        entropy = -(share * np.log2(share)).sum()
        assert len(own) * 8 / len(block) < entropy + 1.8
        assert len(own) < 0.95 * len(zlib.compress(block.astype("<u2").tobytes(), 9))
    alone = codec.encode(blocks[3:4], 16)
    assert alone == coded[3:4]


@pytest.mark.parametrize("bits", [1, 2, 3, 5, 9, 17, 21])
def test_codec_of_every_width(bits):
    rng = np.random.default_rng(bits)
    top = (1 << bits) - 2
    blocks = [rng.integers(0, top + 1, n) for n in rng.integers(1, 90, 40)] + [np.array([top]), np.repeat([0, top], 300)]
    coded = codec.encode(blocks, bits)
    for got, want in zip(codec.decode(coded, [len(b) for b in blocks], bits), blocks, strict=True):
        assert np.array_equal(got, want)


@pytest.mark.parametrize("name", ["count", "pack", "files"])
def test_odd_tables(spark, tmp_path, name):
    def run(docs):
        if name == "count":
            return count_tokens(docs, PIECES)
        if name == "pack":
            return packing.pack(docs, BYTES)
        path = f"{tmp_path}/{uuid.uuid4().hex}"
        token_files.write_token_files(docs, path, WORDS)
        return token_files.read_token_files(spark, path, 16)

    assert run(docs_frame(spark, EMPTY)).count() == 0
    odd = docs_frame(spark, [(None, "a b"), (None, None), (3, "same"), (3, "same"), (4, "")], CLASH)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in run(odd).collect()) == [(False, 3), (False, 3), (False, 4), (True, 0), (True, 0)]


def test_codec_takes_few_steps_an_id(monkeypatch):
    """Time goes with the steps of the range coder: one for the guess and one for four bits of an id."""
    steps, shift = [], codec._Coder.shift
    monkeypatch.setattr(codec._Coder, "shift", lambda self, *a: (steps.append(1), shift(self, *a))[1])
    block = np.random.default_rng(1).integers(0, 49_000, 300)
    coded = codec.encode([block], 16)
    assert len(steps) <= 5 * 300
    steps.clear()
    assert np.array_equal(codec.decode(coded, [300], 16)[0], block) and len(steps) <= 5 * 300


def test_codec_counts_are_halved_in_long_blocks():
    rng = np.random.default_rng(2)
    block = np.where(rng.random(20_000) < 0.5, 7, rng.integers(0, 40, 20_000))
    coded = codec.encode([block, block[:100]], 16)
    assert np.array_equal(codec.decode(coded, [20_000, 100], 16)[0], block)


def test_codec_runs_are_even(monkeypatch):
    monkeypatch.setattr(codec, "LANES", 8)
    assert [len(x) for x in codec._runs([3] * 9)] == [9] and [len(x) for x in codec._runs([3] * 14)] == [7, 7]
    assert codec._runs([0, 0]) == [] and codec._runs([1, 0, 5]) == [[2, 0]]
    blocks = [np.arange(n) for n in range(30)]
    coded = codec.encode(blocks, 16)
    for got, want in zip(codec.decode(coded, [len(b) for b in blocks], 16), blocks, strict=True):
        assert np.array_equal(got, want)

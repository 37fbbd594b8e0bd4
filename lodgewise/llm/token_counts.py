"""Token counts without ids: byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lodgewise.llm.common import KEEP_BYTES, Chunks, Kept, plain_docs, released, slices


_KNOWN: dict[str, tuple[PieceModel, Kept]] = {}  # of a worker, over its tasks


class PieceModel:
    """The merge ranks of a piece model, read through its library.

    Works for models that merge pieces by score, put a space in front of each text and change nothing else in it.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        space = "▁"
        if any(space in p.lstrip(space) or "\n" in p for p in self.score):
            raise ValueError("a piece holds white space behind another character: texts can't be counted in chunks")

    def count(self, chunk: str) -> int:
        """Symbols left when no adjacent pair is a piece: initial symbols minus merges, bytes for unknown symbols."""
        symbols = list(chunk.replace(" ", "▁"))
        score, n = self.score, len(symbols)
        whole = symbols[0] if n == 1 else None
        if whole is not None:
            return 1 if whole in score else len(whole.encode())
        extra = sum(len(s.encode()) - 1 for s in symbols if s not in score)  # such a symbol never merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-score[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in score]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != pair:
                continue  # one side has been merged since
            symbols[i], symbols[j] = pair, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in score:
                    heapq.heappush(heap, (-score[p], i, p))
            if (h := before[i]) >= 0 and (p := symbols[h] + pair) in score:
                heapq.heappush(heap, (-score[p], h, p))
        return n - merges + extra


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, keep_bytes: int = KEEP_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Whole texts are counted; a null text is empty and has no tokens, a null doc_id stays null, repeated rows
    are counted each. Distinct chunks of a slice are merged once; a worker holds counts in at most `keep_bytes`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _KNOWN:
            _KNOWN[model_path] = PieceModel(model_path), Kept(keep_bytes)
        model, known = _KNOWN[model_path]
        for batch in slices(batches):
            text = batch.column("text")
            led = pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise("", text, " "))
            chunks = Chunks(led)
            known.take_in([c for c in chunks.distinct if c not in known])
            for c in chunks.distinct:
                if c not in known:
                    known[c] = model.count(c.decode())
            counts = np.array([known[c] for c in chunks.distinct] + [0], np.int64)[chunks.codes]
            sums = np.concatenate([[0], np.cumsum(counts)])
            tokens = sums[chunks.first[1:]] - sums[chunks.first[:-1]]
            n_bytes = np.maximum(chunks.n_bytes - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )
        released()

    return plain_docs(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

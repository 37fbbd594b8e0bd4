"""Chat formatting: final messages from an event log, rendered with a template that can be read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodgewise.llm.common import written

#: Strings that models read as control; none of them is left whole inside a rendered role or text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
EVENTS = ("message", "edit", "regenerate", "delta")
_REGENERATE, _DELTA = 3, 4  # places of these among EVENTS
_OUT_CHARS = 1 << 20  # of messages handed on at once
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)


def escape(text: Column) -> Column:
    """Put a backslash behind the first character of each control string (one more where some stand there already)."""
    return F.regexp_replace(text, f"([<\\[])(?=\\\\*(?:{_REST}))", "$1\\\\")


def unescape(text: str) -> str:
    return re.sub(rf"([<\[])\\(?=\\*(?:{_REST}))", r"\1", text)


def fold(events: DataFrame) -> DataFrame:
    """Final messages of a log: conv_id, message, place, role, text.

    Columns of the log: conv_id, seq (order of the events, null before all others), message (key of the message meant), kind, role, text
    and, where several events share a seq, step (their order in it; null or no such column: 0). `message` and `edit` set the
    text, `regenerate` empties it and `delta` appends to it; of one step the kinds count in the order of EVENTS, those of one kind in the order
    of their texts. The place of a message is the seq of its first event and its role the first one given. A null text is
    empty; a kind not listed is ignored; a message without a role has an empty one.

    The log is dealt by conversation and message, so that a conversation of any length is folded by many tasks, and sorted by
    sequence; a task walks it once and holds what was appended to one message since its last reset.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in EVENTS]), F.col("kind"))
    step = F.coalesce(F.col("step").cast("int"), F.lit(0)) if "step" in events.columns else F.lit(0)
    log = events.select(
        "conv_id", "message", "seq", step.alias("step"), rank.alias("rank"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("rank > 0")
    sorted_ = log.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", F.col("seq").asc_nulls_first(), "step", "rank", "text", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, done, size = ["conv_id", "message", "place", "role", "text"], [], 0
        key, place, role, parts, schema = None, None, None, None, None

        def out() -> pa.RecordBatch:
            kinds = [schema.field(c).type for c in ("conv_id", "message", "seq", "role", "text")]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

        for batch in batches:
            schema = batch.schema
            for conv, message, seq, _, kind, own_role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if parts is None or (conv, message) != key:
                    if parts is not None:
                        done.append((*key, place, role or "", "".join(parts)))
                        size += len(done[-1][-1])
                    key, place, role, parts = (conv, message), seq, None, []
                    if size > _OUT_CHARS:
                        yield out()
                        done, size = [], 0
                if role is None:
                    role = own_role
                if kind != _DELTA:
                    parts = []
                if kind != _REGENERATE:
                    parts.append(text)
        if parts is not None:
            done.append((*key, place, role or "", "".join(parts)))
            yield out()

    kinds = {c: log.schema[c].dataType for c in ("conv_id", "message", "seq")}
    schema = T.StructType([T.StructField("place" if c == "seq" else c, k) for c, k in kinds.items()])
    return sorted_.mapInArrow(run, schema.add("role", "string").add("text", "string")).select("conv_id", "message", "place", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, place, message, formatted, mask_start, mask_length (code points of `formatted` to learn)."""
    role = escape(F.replace(F.replace(F.col("role"), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    learned = F.col("role") == LEARNED
    body = escape(F.col("text"))
    return messages.select(
        "conv_id", "place", "message", F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(learned, F.length(head)).otherwise(0).cast("long").alias("mask_start"),
        F.when(learned, F.length(body)).otherwise(0).cast("long").alias("mask_length"),
    )


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    role, text = formatted[len(OPEN) : -len(CLOSE)].split("\n", 1)
    role = re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))
    return role, unescape(text)


def digest(rendered: DataFrame) -> DataFrame:
    """Read rendered turns back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are sorted by conversation, place and message key and streamed through the digests, so that a
    conversation of any length takes no memory; its bytes have to pass one digest, and so one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        rows, state, current = [], None, None

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        def close() -> None:
            if state is not None:
                rows.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_length")]
            for conv, formatted, start, length in zip(*columns, strict=True):
                if state is None or conv != current:
                    close()
                    state, current = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                role, text = read_turn(formatted)
                learned = unescape(formatted[start : start + length])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(formatted)
            if rows:
                yield out()
                rows = []
        close()
        if rows:
            yield out()

    lined = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "place", "message")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return lined.select("conv_id", "formatted", "mask_start", "mask_length").mapInArrow(run, schema)


def log_of(conversations: DataFrame) -> DataFrame:
    """The event log of a table of turns (conv_id, turn, role, text): conv_id, seq, step, message, kind, role, text.

    By the hash of its text a turn was streamed (a message with the first half, a delta with the rest), edited (first written
    backwards, streamed on, then an edit to the first half and the rest streamed again) or regenerated (streamed backwards, emptied,
    streamed anew in two parts). Equal rows stay apart by their number, rows of one turn follow each other by role and text.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    key = F.struct("turn", "role", F.sha2("text", 256).alias("text"), "copy").alias("message")
    half = F.floor(F.length("text") / 2).cast("int")
    first, rest, draft = F.substr("text", F.lit(1), half), F.substr("text", half + 1, F.length("text")), F.reverse("text")

    def steps(*some: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), text.alias("text")) for i, (kind, text) in enumerate(some)])

    history = F.pmod(F.xxhash64("text"), F.lit(3))
    log = F.when(history == 0, steps(("message", first), ("delta", rest))).when(
        history == 1, steps(("message", draft), ("delta", F.lit("?")), ("edit", first), ("delta", rest))
    ).otherwise(steps(("message", F.lit("")), ("delta", draft), ("regenerate", F.lit("again")), ("delta", first), ("delta", rest)))
    return rows.select("conv_id", F.col("turn").alias("seq"), key, "role", F.explode(log).alias("e")).select("conv_id", "seq", "e.step", "message", "e.kind", "role", "e.text")


def format_chats(conversations: DataFrame) -> DataFrame:
    """Rebuild, render, write and read back whole conversations; a null conv_id makes one conversation of its own."""
    return digest(written(render(fold(log_of(conversations))), "chats"))

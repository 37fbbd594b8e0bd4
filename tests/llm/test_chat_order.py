"""Turns and events without an order."""

import hashlib
import random

from lodgewise.llm import chat


def test_rows_without_a_turn_keep_text_and_role(spark):
    rows = [(1, None, "assistant", "whole text"), (1, 0, "user", "hi"), (1, None, "tool", "odd"), (2, -3, "user", "early"), (2, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.format_chats(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {
        1: (3, sha("assistant\nwhole text\ntool\nodd\nuser\nhi\n"), 10, sha("whole text")),
        2: (2, sha("assistant\nfirst\nuser\nearly\n"), 5, sha("first")),
    }


def test_events_without_an_order_come_first(spark):
    events = [(1, None, 0, "message", "user", "a"), (1, None, 0, "delta", None, "b"), (1, 2, 0, "delta", "tool", "c"), (1, None, 1, "message", None, "x"), (1, -1, 1, "edit", "user", "y"), (1, 3, 1, "delta", None, "z")]
    got = chat.fold(spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")).orderBy("message").collect()
    assert [(r.place, r.role, r.text) for r in got] == [(None, "user", "abc"), (None, "user", "yz")]


def test_log_holds_every_kind_and_folds_back(spark):
    """The log of a table has drafts, edits and regenerations; none of what they rewrote is left."""
    rows = [(i % 3, i, "assistant" if i % 2 else "user", "".join(random.Random(i).choice("ab é🙂\n") for _ in range(i % 41))) for i in range(90)]
    log = chat.log_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.select("kind").distinct().collect()} == set(chat.EVENTS)
    got = chat.fold(log.orderBy("text", "step")).orderBy("place").collect()
    assert [(r.conv_id, r.place, r.role, r.text) for r in got] == rows


def test_fold_equals_a_plain_replay(spark):
    rng = random.Random(8)
    kinds = [*chat.EVENTS, "noise", None]
    events = [(rng.choice([None, 1, 2]), rng.choice([None, *range(12)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1, 2]), rng.choice(kinds), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "x", "yé", "z" * 40])) for _ in range(600)]
    order = {k: i for i, k in enumerate(chat.EVENTS)}
    want = {}
    low = lambda v: (v is not None, v)
    for conv, seq, step, message, kind, role, text in sorted((e for e in events if e[4] in order), key=lambda e: (low(e[1])[0], e[1] or 0, e[2] or 0, order[e[4]], e[6] or "", low(e[5])[0], e[5] or "")):
        one = want.setdefault((conv, message), [seq, None, ""])
        one[1] = one[1] or role
        one[2] = (one[2] if kind == "delta" else "") + ("" if kind == "regenerate" else text or "")
    log = spark.createDataFrame(events, "conv_id long, seq long, step int, message long, kind string, role string, text string")
    got = {(r.conv_id, r.message): [r.place, r.role, r.text] for r in chat.fold(log).collect()}
    assert got == {k: [place, role or "", text] for k, (place, role, text) in want.items()}


def test_long_message_of_many_deltas(spark):
    """A message of a million characters in a conversation that holds a third of all events."""
    events = [(1, i, 0, "delta", "assistant", "0123456789" * 50) for i in range(2000)] + [(1, i, i, "message", "user", "u") for i in range(1, 1000)] + [(2, i, i, "message", "user", "v") for i in range(3000)]
    got = chat.fold(spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string"))
    found = {(r.conv_id, r.message): r.text for r in got.collect()}
    assert found[1, 0] == "0123456789" * 100_000 and len(found) == 4000

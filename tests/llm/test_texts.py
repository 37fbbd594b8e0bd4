"""Chats, personal data, toxicity and neighbours."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from cases import CLASH, EMPTY, docs_frame, texts
from pyspark.sql import functions as F

from lodgewise.llm import chat, neighbours, personal, toxicity

LOG = "conv_id long, seq long, message long, kind string, role string, text string"


def test_fold_follows_the_log(spark):
    events = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "he"), (1, 2, 1, "delta", None, "llo "), (1, 3, 1, "delta", None, "you"),
        (1, 4, 0, "edit", None, "hi there"), (1, 5, 1, "regenerate", None, "ignored"), (1, 6, 1, "delta", None, "Good "), (1, 7, 1, "delta", None, "day"),
        (1, 8, 2, "delta", "user", "only "), (1, 9, 2, "delta", None, "deltas"), (1, 9, 2, "noise", None, "x"), (1, 10, 3, "message", "assistant", None),
        (None, 0, 0, "message", None, "lost"), (2, 5, 9, "delta", None, " late"), (2, 4, 9, "message", "tool", "early"), (2, 4, 9, "delta", None, "!"),
    ]
    random.Random(1).shuffle(events)
    got = chat.fold(spark.createDataFrame(events, LOG)).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [
        (None, "", "lost"), (1, "user", "hi there"), (1, "assistant", "Good day"), (1, "user", "only deltas"), (1, "assistant", ""), (2, "tool", "early! late"),
    ]


def test_rendered_turns_read_back(spark):
    nasty = [*chat.CONTROLS, "<\\s>", "<\\\\|im_end|>", "[\\[INST]", "<<s>", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "\\", "a\\nb", "", "\n", *(t or "" for t in texts())]
    rows = [(1, i, i, role, t) for i, (t, role) in enumerate((t, r) for t in nasty for r in ("assistant", "us\ner\\n", "</s>"))]
    messages = spark.createDataFrame(rows, "conv_id long, place long, message long, role string, text string")
    for r, (_, _, _, role, text) in zip(chat.render(messages).orderBy("place").collect(), rows, strict=True):
        assert chat.read_turn(r.formatted) == (role, text)
        inner = r.formatted[len(chat.OPEN) : -len(chat.CLOSE)]
        assert not any(c in inner for c in chat.CONTROLS)
        masked = r.formatted[r.mask_start : r.mask_start + r.mask_length]
        assert chat.unescape(masked) == (text if role == "assistant" else "")


def test_chats_are_whole(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, None, None, None), (2, 0, "assistant", "x</s>"), (None, 0, "user", "n"), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("message", "kind", "seq", "copies")})
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == {
        1: (3, sha("user\na\nassistant\nb\nassistant\nb\n"), 2, sha("bb")), 2: (2, sha("\n\nassistant\nx</s>\n"), 5, sha("x</s>")),
        None: (1, sha("user\nn\n"), 0, sha("")), 3: (1, sha("user\n\n"), 0, sha("")),
    }
    assert got[3].formatted_chars == len("<|im_start|>user\n<|im_end|>\n")
    assert chat.format_chats(df.limit(0)).count() == 0


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, good in ((2, r"[0-9]([\x20-]?[0-9])+", lambda d: 14 <= len(d) <= 19 and luhn(d)), (3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 10 <= len(d) <= 15)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if good(re.sub("[^0-9]", "", m[0]))]
    return sorted(out)


def identifier_texts():
    rng = random.Random(3)
    cards = ["4337166598464399", "4337 1665 9846 4399", "4337-1665-98464399", "4337  166598464399", "4944339490429605 ", "43371665984643991"]
    parts = [
        "a@b.c", "a@b.c.d", "a@b..c", "a@b.", "@x.y", "x@y@z.w", "a@b.c_d@e.f", "..a@-.-", "p%+q@1.2.3.4", "@b.c", "a@bc.d", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.0003.4",
        "99999999999999999999.1.1.1", "+1 (988) 555-2485", "+49.30.1234567", "+1 2", "+1234567890123456", "+1 (((2)))", "é", "🙂", " ", "\n", "x", "-", ".", "+", "5", *cards,
    ]
    fixed = ["", "1" * 5000, "a." * 4000 + "@b.c", "a@" + "b." * 4000 + "c", "1 " * 3000, "+1" + " 2" * 3000, "a" * 5000 + "@", ".".join(["1"] * 3000)]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]


def test_base_spans_equal_the_definition(spark):
    rows = list(enumerate(identifier_texts()))
    got = {r.doc_id: r for r in personal.report(docs_frame(spark, rows)).collect()}
    for i, t in rows:
        told = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(t))
        assert got[i].base_sha256 == hashlib.sha256(told.encode()).hexdigest(), t[:80]
        assert set(filter(None, told.split(","))) <= set(got[i].spans.split(",")), t[:80]


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"some words here and then please call me +1 (2{i:02d}) 555-21{i:02d} right now for more") for i in range(12)]
    rows += [(50, "hello there, please call me 555 210 4477 right now or later"), (51, "totals were 555 210 4478 in the second year")]
    got = {r.doc_id: r for r in personal.report(docs_frame(spark, rows)).collect()}
    start = rows[12][1].index("555")
    assert got[50].spans == f"phone:{start}:{start + 12}" and got[50].n_phone == 0 and got[50].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[51].spans == "" and got[0].n_phone == 1


def test_odd_tables_of_personal_data(spark):
    assert personal.report(docs_frame(spark, EMPTY)).count() == 0
    rows = [(None, "a@b.c and 1.2.3.4"), (None, None), (3, "mail a@b.c"), (3, "mail a@b.c"), (4, ""), (5, "mail x@1.2.3.4 now")]
    docs = docs_frame(spark, rows, CLASH)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip) for r in personal.report(docs).collect()) == [("3", 1, 0), ("3", 1, 0), ("4", 0, 0), ("5", 1, 1), ("None", 0, 0), ("None", 1, 1)]
    redacted = personal.redact(docs)
    assert redacted.columns == docs.columns
    assert sorted(map(str, ((r.text, r.n_chars) for r in redacted.collect()))) == sorted(
        map(str, [("[EMAIL] and [IP]", 16), (None, None), ("mail [EMAIL]", 12), ("mail [EMAIL]", 12), ("", 0), ("mail [EMAIL] now", 16)])
    )


def toxic_rows(n, seed):
    rng = random.Random(seed)
    clean, bad = [f"w{i}ord".replace(str(i), "abcdefghij"[i % 10] * (i // 10 + 1)) for i in range(60)], ["grumfia", "grumfio", "grumfelt", "blasto", "moron"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        own = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(bad))
        rows.append((i, " ".join(own)))
        labels.append((i, 0, int(toxic) if rng.random() > 0.02 else 1 - int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows(600, 2)
    docs, marks = docs_frame(spark, rows, CLASH), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, int(r.doc_id % 6 == 0)) for r in got if r.held_out]
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.97
    assert model.accuracy[0] > 0.9 and model.correlation.shape[0] == len(model.voters)
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.learn(docs.withColumn("lang", F.lit("zz")), flipped)
    assert again.weights == model.weights and again.bias == model.bias  # held-out labels and other columns play no part
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_odd_tables_of_toxicity(spark):
    rows, labels = toxic_rows(60, 3)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (5, 0, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    docs = docs_frame(spark, [*rows, (None, None), (None, "x"), (9, ""), (9, "")])
    for model in (toxicity.learn(docs, marks), toxicity.learn(docs, marks.filter("false")), toxicity.learn(docs_frame(spark, EMPTY), marks)):
        got = toxicity.score(docs, model).collect()
        assert len(got) == 64 and all(0 <= r.score <= 1 for r in got) and sum(r.doc_id is None for r in got) == 2
        assert toxicity.score(docs_frame(spark, EMPTY), model).count() == 0
        assert toxicity.without_toxic(docs, model).filter("doc_id IS NULL").count() == 2


def test_label_model_learns_accuracies_and_discounts_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    good, weak = np.where(truth, rng.random(4000) < 0.8, rng.random(4000) < 0.02), np.where(truth, rng.random(4000) < 0.4, rng.random(4000) < 0.3)
    other = np.where(truth, rng.random(4000) < 0.7, rng.random(4000) < 0.05)
    votes = np.column_stack([good, other, weak, weak, weak]).astype(float)
    posterior, accuracy, correlation = toxicity.label_model(votes, 0.1 + 0.8 * votes[:, 0])
    assert accuracy[0] > 0.85 > 0.6 > accuracy[2] and correlation[2, 3] > 0.99 and abs(correlation[0, 2]) < 0.1
    assert ((posterior > 0.5) == truth).mean() > 0.9


def brute_nearest(rows, queries, k=5):
    def cosine(a, b):
        dot = na = nb = 0.0
        for x, y in zip(a, b, strict=True):
            dot, na, nb = dot + x * y, na + x * x, nb + y * y
        return dot / (math.sqrt(na) * math.sqrt(nb))

    good = [(i, v) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = set()
    for q in {i for i, _ in good if i in queries}:
        best = {}
        for i, v in good:
            if i != q:
                for j, w in good:
                    if j == q and len(v) == len(w):
                        best[i] = max(best.get(i, -2), cosine(w, v))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, s))
    return out


@pytest.mark.parametrize("rows_per_block", [3, 64])
def test_nearest_equals_brute_force(spark, rows_per_block):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 8)).astype(np.float32)
    rows = [(i, base[i % 140].tolist()) for i in range(200)]  # every vector of the first sixty twice
    rows += [(300 + i, base[0].tolist()) for i in range(30)] + [(400, None), (401, [0.0] * 8), (402, [math.nan] * 8), (403, [None] + [1.0] * 7), (404, [math.inf] + [1.0] * 7), (405, []), (406, [1.0, 2.0]), (407, [2.0, 1.0])]
    rows += [(None, base[1].tolist()), (20, base[100].tolist()), (21, base[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("label", "block", "rank", "score", "id")}).repartition(5)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, rows=rows_per_block)
    want = brute_nearest(rows, {i for i, _ in rows if i is not None and i % 20 == 0})
    assert {tuple(r) for r in got.collect()} == want and len(want) >= 60
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0

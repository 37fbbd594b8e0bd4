"""Phrases against all windows counted one by one."""

import random
import re
from collections import Counter

import pytest
from cases import CLASH, docs_frame

from lodgewise.llm import phrases


def brute(rows, least, longest=5, share=100, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n, found = totals[lang], []
        many = {g: f for g, f in own.items() if len(g) > 1 and f >= least}
        for g, a in many.items():
            if any(len(h) > len(g) and 100 * f >= share * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, f in many.items()):
                continue
            score, k = min((1000 * a * n // (own[g[:k]] * own[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        out += [(lang, rank + 1, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def texts(n, seed=3):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "it's", "a\u0001", "a", "straße", "Émile", "日本", "🙂", "x y", "z" * 30]
    passage = "one two the cat\tthree  four five six"
    out = []
    for _ in range(n):
        own = [rng.choice(words[: rng.randint(1, len(words))]) + rng.choice(["", "", "", "", ".", ", ", "\n", ";"]) for _ in range(rng.randint(0, 40))]
        out.append((rng.choice(["en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(own) + rng.choice(["", "", " " + passage])))
    return [*out, ("en", None), ("fr", ""), ("de", " . ,"), ("en", "the " * 300)]


def frame(spark, rows, clashing=()):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")
    return df.withColumns({c: F.lit("x") for c in clashing})


@pytest.mark.parametrize("least, share, batch", [(2, 100, 10_000), (5, 80, 3), (3, 100, 7)])
def test_equals_brute_force(spark, least, share, batch):
    rows = texts(150, seed=least)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = phrases.collocations(frame(spark, rows, (*CLASH, "w1", "lang_", "n", "part", "p1", "total")).repartition(3), least=least, share=share).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == brute(rows, least, share=share)


def test_colliding_marks_change_nothing(spark):
    rows = texts(60, seed=9)
    got = phrases.frequent(phrases.windows(frame(spark, rows), 4, bits=15), 4).filter("w2 IS NOT NULL").count()
    want = phrases.frequent(phrases.windows(frame(spark, rows), 4), 4).filter("w2 IS NOT NULL").count()
    assert got == want > 0


def test_very_long_text_is_cut_between_pieces(spark):
    rows = [("en", "alpha beta gamma, alpha beta; delta\n" * 400), ("en", "alpha beta")]
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows), least=50, slice_bytes=64).collect())) == brute(rows, 50)


def test_top_and_ties(spark):
    rows = [("en", "a b. c d. e f. g h")] * 4
    got = phrases.collocations(frame(spark, rows), least=2, top=2).collect()
    assert [(r.rank, r.phrase) for r in got] == [(1, "a b"), (2, "c d")]


def test_empty_tables(spark):
    for df in (docs_frame(spark, []), docs_frame(spark, [(1, None), (2, "")]), docs_frame(spark, [(None, "one two")])):
        assert phrases.collocations(df).count() == 0


@pytest.mark.parametrize("least, bits", [(1, 27), (3, 27), (3, 15), (300, 20)])
def test_marks_of_packed_keys(spark, least, bits):
    """Keys are counted over all tasks; each takes four bytes or so on its way, not two long numbers."""
    import numpy as np

    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    times = rng.integers(1, 2 * least + 1, len(keys))
    tasks = [np.repeat(keys, times // 2), np.repeat(keys, times - times // 2)]
    batches = [phrases._counted(t, least, bits) for t in tasks]
    assert sum(b.nbytes for b in batches[:1] if least < 256 and bits == 15) < 5 * len(keys)
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    marks = phrases._marks(spark.createDataFrame(rows, "block int, rests binary, counts binary"), least, bits)
    assert marks.has(keys[times >= least]).all()
    if bits > 15:
        assert marks.has(keys[times < least]).mean() < 0.05 if (times < least).any() else True
    assert phrases._counted(keys[:0], least, bits).num_rows == 0

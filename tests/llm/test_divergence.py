"""Sources against each other, term by term."""

import random
import re
from collections import Counter, defaultdict

import pytest
from cases import CLASH
from pyspark.sql import functions as F

from lodgewise.llm import divergence


def brute(rows, least, top=10):
    groups, df, counts = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)
        groups[lang].add(source)
        df[lang].update(set(words))
        counts[lang, source].update(words)
    price = lambda p, q: (p - q) * (p - q) // (p + q)
    out = []
    for lang, sources in groups.items():
        terms = [t for t, n in df[lang].items() if n >= least]
        share = {}
        everything = Counter({t: sum(counts[lang, s][t] for s in sources) for t in terms})
        for s, c in [*((s, counts[lang, s]) for s in sources), (None, everything)]:
            n = sum(c[t] for t in terms)
            share[s] = {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(terms)) for t in terms}
        for s in sources:
            pairs = sorted((-sum(price(share[s][t], share[o][t]) for t in terms), o.encode()) for o in sources if o != s)
            own = sorted((-price(share[s][t], share[None][t]), t.encode()) for t in terms if counts[lang, s][t] and share[s][t] > share[None][t])
            for part, found in (("pair", pairs), ("term", own[:top])):
                out += [(lang, s, part, item.decode(), -v, rank + 1) for rank, (v, item) in enumerate(found)]
    return sorted(out)


def rows_of(n, seed, sources=6):
    rng = random.Random(seed)
    words = ["The", "the", "cat's", "it", "straße", "Émile", "日本", "🙂", "x9y", "dog", "Dog", "zebra", "a-b"] + [f"w{c}" for c in "abcdefghij"]
    out = []
    for _ in range(n):
        source = rng.choice([None, "", *(f"s{i}é" for i in range(sources))])
        own = words[: rng.randint(1, len(words))]
        out.append((" ".join(rng.choice(own) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None]), source))
    return [*out, (None, "en", "quiet"), ("", "fr", "a"), ("1 2 3", "fr", "b"), ("once", "it", "only"), ("the " * 5000, "en", "s0é")]


def frame(spark, rows, clashing=()):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in clashing})


@pytest.mark.parametrize("least, width, batch", [(10, 128, 10_000), (3, 2, 5), (2, 3, 1)])
def test_equals_brute_force(spark, least, width, batch):
    rows = rows_of(120, least)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = frame(spark, rows, (*(c for c in CLASH if c not in ("doc_id",)), "term", "n", "total", "p", "gi", "item", "value", "rank"))
        got = divergence.audit(df.repartition(3), least=least, width=width).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == brute(rows, least)


def test_blocks_are_cut_when_columns_are_many(monkeypatch):
    """One block at once and in small blocks give the same sums."""
    import numpy as np

    rng = np.random.default_rng(2)
    cell = lambda: divergence._Cell((0, "en", 0, 0))
    terms, groups = 300, 5
    term, slot = np.nonzero(rng.random((terms, groups)) < 0.6)
    _, term = np.unique(term, return_inverse=True)
    n, p = rng.integers(1, 500, len(term)), rng.integers(1, 10**9, len(term))
    p = n * 1000  # the share follows from the count
    sums = []
    for columns, tile in ((4096, 1024), (40, 16)):
        monkeypatch.setattr(divergence, "_COLUMNS", columns)
        monkeypatch.setattr(divergence, "_TILE", tile)
        one = cell()
        one.sources, one.block, one.rare, one.terms = list("abcde"), [0] * groups, [500 + i for i in range(groups)], int(term.max()) + 8
        one.close()
        one.add(term, slot, n, p)
        sums.append(one.sums)
    dense = np.array([[500 + i for i in range(groups)]] * (int(term.max()) + 8), dtype=object)
    dense[term, slot] = p.tolist()
    for a in range(groups):
        for b in range(a + 1, groups):
            want = sum((x - y) * (x - y) // (x + y) for x, y in dense[:, [a, b]])
            assert sums[0][a, b] == sums[1][a, b] == want


def test_long_texts_are_cut_between_terms(spark):
    rows = [("alpha Beta gamma " * 300, "en", "a"), ("beta delta", "en", "b"), ("é" * 500, "en", "a")]
    sums = lambda size: sorted(map(tuple, divergence.term_counts(frame(spark, rows), size).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()), key=str)
    assert sums(64) == sums(1 << 20)


def test_large_counts_stay_exact(spark):
    one = spark.range(1).select(F.lit(9 * 10**12).alias("n"), F.lit(10**13).alias("own"), F.lit(10**6).alias("terms"))
    got = one.select(divergence._share("n", "own", "terms")).first()[0]
    assert got == 1 + 10**9 * (9 * 10**12 + 2) // (10**13 + 2 * 10**6)


def test_empty_and_wordless(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    got = divergence.audit(frame(spark, [(None, None, None), ("", "x", "a"), ("!", "x", "b")])).collect()
    assert sorted(map(tuple, got)) == [("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)]

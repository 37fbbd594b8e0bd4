"""Repeated strings, near copies and leaks against brute force."""

import hashlib
import re

import numpy as np
import pytest
from cases import CLASH, EMPTY, docs_frame, random_texts, texts

from lodgewise.llm import jaccard, leaks, repeats
from lodgewise.llm.graph import components

LAST = 2**63 - 1


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def bag(words, size=5):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [tuple(words)] * bool(words)


def brute_links(rows, percent=75):
    sets = [set(bag(words_of(t))) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [
        (d, len(s), min(LAST if rows[j][0] is None else rows[j][0] for j in range(len(rows)) if group[j] == group[i]) if s else d)
        for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


@pytest.mark.parametrize("seed,vocabulary", [(1, 40), (2, 3), (3, 400)])
def test_components_equal_brute_force(spark, seed, vocabulary):
    rows = [(i * 37 % 1009, t) for i, t in enumerate(random_texts(120, seed, vocabulary))]
    got = sorted(map(tuple, jaccard.link(docs_frame(spark, rows).repartition(6)).collect()))
    assert got == sorted(brute_links(rows))


@pytest.mark.parametrize("seed,vocabulary", [(1, 40), (7, 12)])
def test_long_lists_in_blocks(spark, monkeypatch, seed, vocabulary):
    monkeypatch.setattr(jaccard, "_LIST", 2)
    monkeypatch.setattr(jaccard, "_ROWS", 4)
    rows = [(i * 37 % 1009, t) for i, t in enumerate(random_texts(120, seed, vocabulary))]
    base = [f"v{i}" for i in range(50)]
    rows += [(2000 + i, " ".join(w if (j + i) % 9 else f"x{i}" for j, w in enumerate(base))) for i in range(25)]  # many alike, few linked
    rows += [(3000 + i, " ".join(base[:40] + [f"y{i}"] + base[41:])) for i in range(15)]
    got = sorted(map(tuple, jaccard.link(docs_frame(spark, rows).repartition(6)).collect()))
    assert got == sorted(brute_links(rows))


def test_chains_of_one_group_are_followed(spark):
    """Neighbours link, the ends don't, and all share a passage: more rounds than the first star."""
    base = [f"v{i}" for i in range(60)]
    rows = [(1000 - i, " ".join(base[i : i + 40])) for i in range(20)]
    got = sorted(map(tuple, jaccard.link(docs_frame(spark, rows)).collect()))
    assert got == sorted(brute_links(rows)) and len({r[2] for r in got}) == 1


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(51)} | {(100, 100), (101, 100)}


def test_odd_tables_linked(spark):
    assert jaccard.link(docs_frame(spark, EMPTY)).count() == 0
    rows = [(None, "a b c d e f"), (5, "A B C D e f"), (None, None), (7, ""), (7, "x"), (8, " X\n"), (8, "x"), (9, "a b"), (None, "lone words")]
    got = sorted(map(str, jaccard.link(docs_frame(spark, rows, CLASH)).collect()))
    want = [(None, 2, 5), (5, 2, 5), (None, 0, None), (7, 0, 7), (7, 1, 7), (8, 1, 7), (8, 1, 7), (9, 1, 9), (None, 1, None)]
    assert got == sorted(f"Row(doc_id={d}, n_shingles={n}, component_id={c})" for d, n, c in want)


def brute_repeats(rows, depth):
    seen = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - depth + 1):
            w = b[i : i + depth]
            seen[w] = min(seen.get(w, LAST), LAST if d is None else d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if seen[b[i : i + depth]] < (LAST if d is None else d):
                gone[i : i + depth] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1))
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed,vocabulary", [(4, 40), (5, 4), (6, 300)])
def test_removal_equals_brute_force(spark, seed, vocabulary):
    rows = [(i * 37 % 1009, t) for i, t in enumerate(random_texts(150, seed, vocabulary))]
    rows += [(2000 + i, t) for i, t in enumerate(["z" * 400, "y" * 60 + "z" * 70, "zx" * 90, "x" + "z" * 49, "é" * 60 + "z" * 50, "z" * 50])]
    got = sorted(map(tuple, repeats.remove_repeats(docs_frame(spark, rows).repartition(6)).collect()))
    assert got == sorted(brute_repeats(rows, 50))


def test_odd_tables_removed(spark):
    assert repeats.remove_repeats(docs_frame(spark, EMPTY)).count() == 0
    long = "the same long passage that repeats in several of the documents here"
    rows = [(None, long), (5, f"x {long}"), (5, f"{long} y"), (6, long), (None, None), (7, ""), (7, long), (7, long), (8, "short"), *((20 + i, t) for i, t in enumerate(texts()))]
    got = sorted(map(str, (tuple(r) for r in repeats.remove_repeats(docs_frame(spark, rows, CLASH)).collect())))
    assert got == sorted(map(str, brute_repeats(rows, 50)))


def brute_leaks(rows, items, least=0.75):
    """The best window of each document and item, every window compared (all items differ: all weights by frequency)."""
    import math
    from collections import Counter

    bags = {i: Counter(bag(words_of(t))) for i, t in items if words_of(t)}
    frequency = Counter(s for b in bags.values() for s in b)
    weight = lambda s: math.log(1 + len(bags) / frequency.get(s, 1))
    found = {}
    for d, t in rows:
        words = words_of(t)
        for i, u in items:
            n = len(words_of(u))
            for start in range(max(len(words) - n, 0) + 1 if n and words else 0):
                window = Counter(bag(words[start : start + n]))
                both = sum(weight(s) * min(c, bags[i][s]) for s, c in window.items())
                every = sum(weight(s) * max(window[s], bags[i][s]) for s in window | bags[i])
                if both / every >= least - 1e-12 and both / every > found.get((d, i), (0,))[0] + 1e-12:
                    found[d, i] = both / every, start
    return found


def test_leaks_equal_brute_force(spark):
    texts_ = random_texts(40, 9, 60)
    items = [(i, t) for i, t in enumerate(random_texts(12, 10, 60))] + [(50, "three word item"), (51, None), (52, "")]
    items = [(i, t) for i, t in items if i >= 50 or len(words_of(t)) > 8]
    rows = []
    for i, t in enumerate(texts_):
        inside = items[i % 9 % len(items)][1] or "three WORD\nitem"
        words = inside.split(" ")
        if i % 3 == 1 and len(words) > 25:
            words[len(words) // 2] = "changed"
        rows.append((i, f"{t} {' '.join(words)} {t}" if i % 4 else t))
    rows += [(100, "three word item"), (101, "word item"), (102, None), (103, "x y three word item z")]
    want = brute_leaks(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (16 << 20, 200):  # one pass, several passes
        got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in leaks.find_leaks(docs_frame(spark, rows, CLASH), bench, item_bytes=limit).collect()}
        if limit > 200:
            assert got.keys() == want.keys() and len(want) > 20
            assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
        else:
            assert {k for k, v in want.items() if v[0] == 1} <= got.keys()
    assert leaks.find_leaks(docs_frame(spark, EMPTY), bench).count() == 0
    assert leaks.find_leaks(docs_frame(spark, rows), bench.filter("false")).count() == 0
    kept = leaks.without_leaks(docs_frame(spark, rows, CLASH), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want} and "score" in kept.columns


def test_equal_items_and_rows(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, passage), (1, passage), (None, passage)], "item_id long, text string")
    got = leaks.find_leaks(docs_frame(spark, [(None, passage), (3, passage), (3, passage)]), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.similarity) for r in got) == sorted([(d, i, 1.0) for d in ("None", "3", "3") for i in ("1", "None")])


def test_sketches_are_added_up_one_row_at_a_time(spark, monkeypatch):
    plans, longest = [], []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        longest.append(df.selectExpr("max(length(counts))").first()[0])
        return df

    monkeypatch.setattr(jaccard, "written", kept)
    rows = [(i, f"common words here number{i % 7} and more") for i in range(90)]
    rarity = jaccard._rarity(docs_frame(spark, rows).repartition(9), 5)
    assert "Pandas" not in plans[0] and plans[0].count("Exchange") == 2 and longest[0] <= 1 << 14  # one deals out the rows above
    prints = jaccard.words(jaccard.pa.array([t for _, t in rows]))[0]
    counts = np.bincount(jaccard._bucket(prints), minlength=1 << jaccard._BITS)
    assert rarity.whole == int(4 * np.log2(len(prints)))
    assert (rarity.scarce == np.rint(-4 * np.log2(np.maximum(counts, 1) / len(prints))).astype(np.uint8)).all()

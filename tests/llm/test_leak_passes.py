"""Leaks of a benchmark that takes several passes."""

import numpy as np
import pyarrow as pa
import pytest
from cases import docs_frame, random_texts
from test_copies import brute_leaks, words_of

from lodgewise.llm import leaks


@pytest.mark.parametrize("item_bytes", [200, 900])
def test_leaks_do_not_depend_on_passes(spark, item_bytes):
    """Items share shingles across passes, so weights of one pass alone would differ."""
    items = [(i, t) for i, t in enumerate(random_texts(14, 10, 60)) if len(words_of(t)) > 8]
    changed = [(100 + i, " ".join("changed" if j == len(t.split()) // 2 else w for j, w in enumerate(t.split()))) for i, t in items if i % 2]
    items += changed
    rows = []
    for i, t in enumerate(random_texts(40, 9, 60)):
        words = items[i % len(items)][1].split(" ")
        if i % 3 and len(words) > 25:
            words[len(words) // 3] = "other"
        rows.append((i, f"{t} {' '.join(words)} {t}"))
    want = brute_leaks(rows, items)
    assert len(want) > 25 and sum(v[0] < 1 for v in want.values()) > 5
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in leaks.find_leaks(docs_frame(spark, rows), bench, item_bytes=item_bytes).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
    one = leaks.find_leaks(docs_frame(spark, rows), bench)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, leaks.find_leaks(docs_frame(spark, rows), bench, item_bytes=item_bytes).collect()))
    kept = leaks.without_leaks(docs_frame(spark, rows), bench, item_bytes=item_bytes)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_a_long_text_is_searched_in_short_runs(spark, monkeypatch):
    """Fingerprints of a run take 2 KB a place: places far apart are no reason for one run."""
    passage = " ".join(f"item{i}" for i in range(30))
    filler = " ".join(f"word{i}" for i in range(20_000))
    runs, plain = [], leaks.simhash
    weights = leaks.Weights(1, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    items = leaks.Items([7], [passage], 5, 28, weights)
    monkeypatch.setattr(leaks, "simhash", lambda run, *rest: runs.append(len(run)) or plain(run, *rest))
    found = list(leaks._search(items, weights, pa.array([f"{passage} {filler} {passage}"]), 0.75))
    assert [(f[1], f[2], f[3], f[5]) for f in found] == [(0, 0, 30, 1.0)] and max(runs) < 5000

"""Toxic variants of long texts that share nearly all words."""

import random
import tracemalloc

import numpy as np

from lodgewise.llm import toxicity


def word(i):
    return "".join(chr(97 + int(c)) for c in f"{i:05d}")


def test_variants_of_one_text_are_all_evidence(spark):
    """Clean and toxic texts over one large vocabulary teach the word that tells them apart."""
    rng = random.Random(4)
    common = [word(i) for i in range(400)]
    rows = [(i, " ".join([*rng.sample(common, len(common)), word(1000 + i), *(["zorgle"] if i % 3 == 0 else [])])) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    learnt = {t: w for t, w in model.weights.items() if t not in toxicity.SEEDS}
    assert max(learnt, key=learnt.get) in toxicity.terms_of("zorgle")
    assert {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()} == {i: int(i % 3 == 0) for i, _ in rows}


def test_copies_count_once(spark):
    """A text copied often marks none of its words."""
    rows = [(i, "the same clean words in every copy") for i in range(100)] + [(200 + i, f"other {word(i)} text") for i in range(60)] + [(400 + i, f"idiot {word(500 + i)}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i < 100 or i >= 400)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    assert not set(model.weights) & {"same", "clean", "words", "copy"}


def test_the_classifier_is_fitted_without_a_wide_copy():
    r = np.random.default_rng(5)
    x = (r.random((5000, 400)) < 0.05).astype(np.float32)
    target, start = r.random(5000), r.random(400)
    w, b, mw, mb = start, 0.0, np.zeros(400), 0.0
    weigh = target / target.sum() + (1 - target) / (1 - target).sum()
    for _ in range(3):
        error = weigh * (1 / (1 + np.exp(-(x.astype(float) @ w + b).clip(-30, 30))) - target) / 2
        mw, mb = 0.9 * mw + error.astype(np.float32) @ x + 2e-4 * (w - start), 0.9 * mb + error.sum()
        w, b = w - 2.0 * mw, b - 2.0 * mb
    tracemalloc.start()
    got, bias = toxicity.linear(x, target, start, steps=3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, w, rtol=1e-9) and np.isclose(bias, b) and most < x.nbytes

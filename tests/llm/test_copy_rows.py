"""Near copies among rows that share an id or have none."""

import corpus_pipeline
from cases import docs_frame


def test_only_linked_rows_go(spark, sf_dir):
    """Distinct texts under one id, null ids, and copies of both: linked rows go, whatever shares their id."""
    a, b, c, d, e, f = (" ".join(f"{k}{i}" for i in range(30)) for k in "abcdef")
    near = a.replace("a29", "other")
    rows = [
        (1, a), (1, b), (1, b), (2, near), (2, c), (None, near), (None, d), (None, e), (None, e), (None, e.replace("e0 ", "x ")),
        (7, f), (7, f.replace("f29", "y")), (None, None), (None, ""), (8, ""), (8, ""), (None, "x y"), (9, "x y"),
    ]
    for parts in (1, 5):
        kept = sorted((str(r.doc_id), str(r.text)) for r in corpus_pipeline.near_copies(spark, docs_frame(spark, rows).repartition(parts), sf_dir).collect())
        for one in (e, f):  # of the links inside one id any text may stay, but one only
            assert sum(one[6:90] in t for _, t in kept) == 1
        rest = [x for x in kept if e[6:90] not in x[1] and f[6:90] not in x[1]]
        assert rest == sorted([("1", a), ("1", b), ("2", c), ("None", d), ("None", "None"), ("None", ""), ("8", ""), ("8", ""), ("9", "x y")])

"""Neighbours among repeated rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_texts import brute_nearest

from lodgewise.llm import neighbours


@pytest.mark.parametrize("rows_per_block", [4, 64])
def test_nearest_with_repeated_rows(spark, rows_per_block):
    """Nearest ids that come several times, with one vector or with several, crowd no other id out."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=8)
    rows = [(0, base.tolist()), (1000, rng.normal(size=8).tolist())]
    for i in range(1, 9):
        near = base + 0.15 * i * rng.normal(size=8)
        rows += [(i, near.tolist())] * (2 + i % 3) + [(i, (near + 0.01 * j).tolist()) for j in range(3)]
    same = rng.normal(size=8).tolist()
    rows += [(20, same)] + [(21, same)] * 9 + [(i, same) for i in range(22, 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(1)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, rows=rows_per_block)
    want = brute_nearest(rows, {i for i, _ in rows if i % 20 == 0})
    assert {tuple(r) for r in got.collect()} == want and len(want) == 15

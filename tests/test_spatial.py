import math
import random

import pytest
from pyspark.sql import functions as F

from lodgewise.operators import spatial
from lodgewise.operators.skew import split_hot_keys


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def points(spark, rows, names=("id", "latitude", "longitude")):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rows)], f"{names[0]} int, {names[1]} double, {names[2]} double")


RIGHT = ("rid", "attr_latitude", "attr_longitude")


def scattered(kind, n, seed):
    r = random.Random(seed)
    if kind == "town":
        return [(r.uniform(-7.9, -7.7), r.uniform(110.3, 110.5)) for _ in range(n)]
    if kind == "date line":
        return [(r.uniform(-1, 1), (179.5 + r.uniform(0, 1) + 180) % 360 - 180) for _ in range(n)]
    if kind == "pole":
        return [(r.uniform(89.0, 90.0), r.uniform(-180, 180)) for _ in range(n)]
    if kind == "south pole":
        return [(r.uniform(-90.0, -89.5), r.uniform(-180, 180)) for _ in range(n)]
    if kind == "globe":
        return [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(n)]
    # Crowded: most points at one spot, copies among them.
    return [(-7.8, 110.37)] * (n // 3) + [(-7.8 + r.gauss(0, 1e-3), 110.37 + r.gauss(0, 1e-3)) for _ in range(n // 3)] + scattered("town", n // 3, seed)


KINDS = [("town", 3.0), ("date line", 25.0), ("pole", 40.0), ("south pole", 20.0), ("globe", 3000.0), ("globe", 15000.0), ("crowd", 0.5)]


@pytest.mark.parametrize("kind, radius", KINDS)
def test_radius_join_equals_brute_force(spark, kind, radius):
    left, right = scattered(kind, 120, 1), scattered(kind, 150, 2)
    want = {(i, j) for i, p in enumerate(left) for j, q in enumerate(right) if km(*p, *q) <= radius}
    pairs = spatial.radius_join(points(spark, left), points(spark, right, RIGHT), radius)
    got = [(r.id, r.rid) for r in pairs.select("id", "rid").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_longitudes_beyond_180_and_latitudes_beyond_90(spark):
    left, right = [(0.0, 190.0), (91.0, 0.0)], [(0.0, -170.0), (88.995, 180.0), (0.0, 550.0)]
    pairs = spatial.radius_join(points(spark, left), points(spark, right, RIGHT), 1.0)
    assert {(r.id, r.rid) for r in pairs.collect()} == {(0, 0), (0, 2), (1, 1)}


def test_radius_edges(spark):
    left, right = [(0.0, 0.0), (0.0, 179.0)], [(0.0, 0.0), (0.0, 1.0), (0.0, -1.0)]
    r = km(0, 0, 0, 1.0)
    inclusive = spatial.radius_join(points(spark, left), points(spark, right, RIGHT), r)
    assert {(x.id, x.rid) for x in inclusive.collect()} == {(0, 0), (0, 1), (0, 2)}
    strict = spatial.radius_join(points(spark, left), points(spark, right, RIGHT), r, inclusive=False)
    assert {(x.id, x.rid) for x in strict.collect()} == {(0, 0)}
    antipodes = spatial.radius_join(points(spark, [(10.0, 20.0)]), points(spark, [(-10.0, -160.0)], RIGHT), 20_100.0)
    assert antipodes.first().distance_km == pytest.approx(math.pi * 6371, abs=1e-3)


def test_missing_coordinates_are_dropped(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0)], "id int, latitude double, longitude double")
    right = points(spark, [(1.0, 1.0)], RIGHT)
    assert [r.id for r in spatial.radius_join(left, right, 5.0).collect()] == [3]


def test_shared_column_names_are_refused(spark):
    with pytest.raises(ValueError):
        spatial.radius_join(points(spark, [(0, 0)]), points(spark, [(0, 0)]), 1.0)


def test_copies_give_as_many_pairs(spark):
    left, right = points(spark, [(0, 0)] * 7).drop("id"), points(spark, [(0, 0)] * 5, RIGHT).drop("rid")
    assert spatial.radius_join(left, right, 1.0).count() == 35


def test_hot_keys_are_split_and_pairs_kept(spark):
    left = spark.range(900).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(600).select(F.col("id").alias("b"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"))
    l, r, keys = split_hot_keys(left, right, "k", block_rows=20)
    got = l.join(r, keys).select("a", "b")
    want = left.join(right, "k").select("a", "b")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    largest = l.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert largest < left.groupBy("k").count().agg(F.max("count")).first()[0] / 4


def test_no_hot_key_stays_whole(spark):
    """More crowded keys than any list would hold, their rows all equal."""
    left = spark.range(60_000).select((F.col("id") % 1500).alias("k"), F.lit(1).alias("a"))
    right = spark.range(3000).select((F.col("id") % 1500).alias("k"), F.lit(2).alias("b"))
    l, r, keys = split_hot_keys(left, right, "k", block_rows=10)
    assert l.groupBy(*keys).count().agg(F.max("count")).first()[0] < 30 and l.join(r, keys).count() == 120_000


def test_blocks_of_pairs_hold_few_copies(spark):
    left = spark.range(900).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(600).select(F.col("id").alias("b"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"))
    want = left.join(right, "k").select("a", "b")
    for rows, pairs, most in ((40, 1000, 40), (1000, 30_000, 1000)):
        l, r, keys = split_hot_keys(left, right, "k", block_rows=rows, block_pairs=pairs)
        got = l.join(r, keys).select("a", "b")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        assert r.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 2 * most  # salts come from a hash
    assert l.count() + r.count() < 3000


def test_a_full_cell_is_not_copied_without_need(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(spatial, "meet", lambda a, b, keys: sent.append((a.count(), b.count())) or a.join(b, keys))
    left = spark.range(12_000).select("id", F.lit(0.01).alias("latitude"), F.lit(0.01).alias("longitude"))
    right = points(spark, [(0.01, 0.01)] * 30, RIGHT)
    assert spatial.radius_join(left, right, 10.0).count() == 360_000
    spatial.radius_join(left.limit(10), right, 10.0)
    assert sent[0] == (sent[1][0] * 1200, 30)


@pytest.mark.parametrize("crowd", [5_000, 0])
@pytest.mark.parametrize("kind, radius", KINDS)
def test_counts_equal_brute_force(spark, kind, radius, crowd):
    left, right = scattered(kind, 90, 3), scattered(kind, 150, 4)
    radii = {"near": radius / 3, "far": radius}
    out = spatial.count_within(points(spark, left), points(spark, right), radii, crowd=crowd)
    got = {r.id: (r.near, r.far) for r in out.collect()}
    assert got == {i: tuple(sum(km(*p, *q) <= x for q in right) for x in radii.values()) for i, p in enumerate(left)}


def test_counts_of_points_among_themselves(spark):
    rows = points(spark, [(0.0, 0.0), (0.0, 0.0), (0.0, 0.001), (5.0, 5.0)])
    out = spatial.count_within(rows, rows, {"others": 0.5}, minus=1)
    assert [r.others for r in out.orderBy("id").collect()] == [2, 2, 2, 0]


def test_counts_without_position_or_targets(spark):
    rows = spark.createDataFrame([(1, None, None), (2, 0.0, 0.0)], "id int, latitude double, longitude double")
    empty = rows.filter("id > 9")
    assert [r.n for r in spatial.count_within(rows, empty, {"n": 1.0}).orderBy("id").collect()] == [None, 0]
    assert [r.n for r in spatial.count_within(rows, rows, {"n": 1.0}).orderBy("id").collect()] == [None, 1]
    assert [r.nearest_km for r in spatial.nearest(rows, empty).collect()] == [None, None]


@pytest.mark.parametrize("kind", ["town", "date line", "pole", "globe", "crowd"])
def test_nearest_equals_brute_force(spark, kind):
    left = scattered(kind, 60, 5) + [(45.0, -100.0)]
    right = scattered(kind, 200, 6)
    out = spatial.nearest(points(spark, left), points(spark, right), label="id")
    for r in out.collect():
        want = min(km(*left[r.id], *q) for q in right)
        assert r.nearest_km == pytest.approx(want, abs=1e-6)
        assert km(*left[r.id], *right[r.nearest]) == pytest.approx(want, abs=1e-6)


def test_landmarks(spark):
    marks = {"distance_to_centre": (-7.8, 110.37)}
    row = spatial.landmark_distances(points(spark, [(-7.8, 110.37)]), marks).first()
    assert row.distance_to_centre == 0.0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_no_python(spark):
    left, right = points(spark, scattered("town", 50, 7)), points(spark, scattered("town", 50, 8), RIGHT)
    targets = points(spark, scattered("town", 50, 8))
    frames = [
        spatial.radius_join(left, right, 2.0),
        spatial.count_within(left, targets, {"n": 2.0}),
        spatial.count_within(left, targets, {"n": 2.0}, crowd=0),
        spatial.nearest(left, targets),
    ]
    for df in frames:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan_of(df)


def test_sites_meet_their_spots_in_leaves_not_in_broadcasts_or_wide_joins(spark):
    """Sites are too many to be sent to every task, whatever the size of the files they come from."""
    spots, targets = points(spark, scattered("town", 300, 9)), points(spark, scattered("town", 3000, 10))
    for df in (spatial.count_within(spots, targets, {"n": 2.0}, crowd=0), spatial.nearest(spots, targets)):
        assert not [line for line in plan_of(df).splitlines() if "Join" in line and "parent" in line and "site_" in line]
        assert "FlatMapCoGroupsInArrow" in plan_of(df)


def test_leaves_count_and_compare_as_brute_force_does():
    import pyarrow as pa

    from lodgewise.operators.leaves import count_leaf, nearest_leaf

    for kind in ("town", "pole", "date line", "crowd", "globe"):
        spots, sites = scattered(kind, 60, 11), list(dict.fromkeys(scattered(kind, 900, 12)))
        r = {"pole": 30.0, "date line": 30.0, "globe": 2500.0}.get(kind, 4.0)
        c = 2 * math.sin(r / 2 / 6371)
        table = pa.table({"site_lat": [p[0] for p in sites], "site_lon": [p[1] for p in sites], "n": [1 + i % 3 for i in range(len(sites))]})
        asked = {"lat": [float(p[0]) for p in spots], "lon": [float(p[1]) for p in spots]}
        n = len(spots)
        got = count_leaf(pa.table({**asked, "i": pa.array([0] * n, pa.int32()), "km": [r] * n, "c": [c] * n}), table).column("n").to_pylist()
        assert got == [sum(1 + i % 3 for i, q in enumerate(sites) if km(*p, *q) <= r) for p in spots]
        near = nearest_leaf(pa.table({**asked, "bound": [2.0] * n}), table.drop_columns(["n"])).to_pylist()
        best = {}
        for row in near:
            p = row["lat"], row["lon"]
            best[p] = min(best.get(p, 1e9), km(*p, row["site_lat"], row["site_lon"]))
        assert best == {tuple(p): min(km(*p, *q) for q in sites) for p in spots}


def test_few_rows_of_many_pairs_are_joined_over_all_cores(spark):
    """Sides of few bytes are neither broadcast nor left to one task."""
    left, right = points(spark, scattered("town", 50, 13)).coalesce(1), points(spark, scattered("town", 50, 14), RIGHT).coalesce(1)
    pairs = spatial.radius_join(left, right, 2.0)
    assert "BroadcastHashJoin" not in plan_of(pairs)
    assert pairs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("crowd", [0, 1e9])
@pytest.mark.parametrize("inclusive", [True, False])
def test_totals_equal_those_of_the_pairs(spark, monkeypatch, crowd, inclusive):
    """Crowded cells and others, over the date line and the pole, with null labels, equal positions and pairs at the radius."""
    monkeypatch.setattr(spatial, "_CROWD_PAIRS", crowd)
    monkeypatch.setattr(spatial, "_CROWD_ROWS", 60)
    rng = random.Random(9)
    spots = [(-7.8, 110.4), (89.95, 0.0), (0.0, 179.99)]
    some = lambda: [(la + rng.uniform(-0.2, 0.2) * (la < 80), (lo + rng.uniform(-0.2, 0.2) * (1 if la < 80 else 900)) % 360) for la, lo in spots for _ in range(60)]
    own, other = some(), some()
    own += other[:5] + [(0.0, 10.0)] * 300
    other += [(0.0, 10.0), (0.0, 10.1), (None, 1.0)]
    a = spark.createDataFrame([(rng.choice(["x", "y", None]), i % 2, la, lo) for i, (la, lo) in enumerate(own)], "kind string, odd int, latitude double, longitude double")
    b = spark.createDataFrame([(rng.choice(["p", None]), la, lo) for la, lo in other], "what string, attr_latitude double, attr_longitude double")
    km = spatial.radius_join(a, b, 30.0).filter("latitude = 0 and longitude = 10").agg(F.max("distance_km")).first()[0]
    for radius in (30.0, km):  # the second is a distance that occurs
        pairs = spatial.radius_join(a, b, radius, inclusive=inclusive).groupBy("kind", "odd", "what").agg(F.count("*").alias("pairs"), F.sum("distance_km").alias("s")).collect()
        got = spatial.radius_join(a, b, radius, inclusive=inclusive, totals=(("kind", "odd"), ("what",))).collect()
        want = {(r.kind, r.odd, r.what): (r.pairs, pytest.approx(r.s, rel=1e-9, abs=1e-6)) for r in pairs}
        assert {(r.kind, r.odd, r.what): (r.pairs, r.distance_km) for r in got} == want and len(got) == len(want) == 12

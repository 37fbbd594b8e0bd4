import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from lodgewise.functions import scores, text
from lodgewise.operators import clean, market, match, quality, ranking, reviews, stats, temporal
from lodgewise.operators.spatial import radius_join


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_latest_per_key_is_idempotent(spark):
    rows = [(1, "2025-01-01", 5, "a"), (1, "2025-02-01", 7, "b"), (1, "2025-02-01", 6, "c"), (2, None, 8, "d")]
    df = frame(spark, rows, "k int, day string, row_id int, v string")
    once = clean.latest_per_key(df, ["k"], "day", "row_id")
    assert {(r.k, r.v) for r in once.collect()} == {(1, "c"), (2, "d")}
    assert clean.latest_per_key(once, ["k"], "day", "row_id").exceptAll(once).count() == 0


def test_latest_per_key_drops_losers_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.col("id").alias("row_id"))
    plan = clean.latest_per_key(df, ["k"], "t", "row_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def quantile(values, p):
    values = sorted(values)
    h = (len(values) - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return values[lo] + (values[hi] - values[lo]) * (h - lo)


def quantile_rows():
    r = random.Random(1)
    rows = [("big", r.choice([0.0, 5.0, r.gauss(0, 9)])) for _ in range(700)] + [("small", 3.0), ("pair", 1.0), ("pair", 2.0), ("null", None), ("nan", math.nan)]
    rows += [(None, float(i)) for i in range(5)] + [("wide", r.choice([-1, 1]) * 10 ** r.uniform(-300, 300)) for _ in range(300)] + [("big", math.nan)]
    return rows


def test_quantiles_and_ranks_are_exact(spark):
    rows = quantile_rows()
    df = frame(spark, [(i, g, v) for i, (g, v) in enumerate(rows)], "i int, g string, v double").repartition(5)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    groups = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    got = {x.g: x for x in ranking.quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == set(groups)
    built_in = df.filter("v IS NOT NULL AND NOT isnan(v)").groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in probs.items()])
    assert {r.g: tuple(r) for r in built_in.collect()} == {g: tuple(r) for g, r in got.items()}  # to the last bit
    overall = ranking.quantiles(df, "v", {"m": 0.5, "n": 1 / 3})
    assert overall.collect() == df.filter("v IS NOT NULL AND NOT isnan(v)").agg(F.percentile("v", 0.5).alias("m"), F.percentile("v", 1 / 3).alias("n")).collect()
    assert ranking.quantiles(df.filter("g = 'null'"), "v", {"m": 0.5}, ["g"]).count() == 0
    ranked = {x.i: x.rank for x in ranking.percent_rank(df, "v", "rank", ["g"]).collect()}
    assert len(ranked) == len(rows)
    for i, (g, v) in enumerate(rows):
        if v is None or g is None or math.isnan(v):
            assert ranked[i] is None
        else:
            values = groups[g]
            want = sum(x < v for x in values) / (len(values) - 1) if len(values) > 1 else 0.0
            assert ranked[i] == pytest.approx(want)


def test_coarse_sketches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_ACCURACY", 3)
    monkeypatch.setattr(ranking, "_CUTS", 4)
    df = frame(spark, [(i % 3, float(i * 7919 % 1009)) for i in range(900)], "g int, v double").repartition(6)
    probs = {"a": 0.01, "b": 0.5, "c": 0.9}
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in probs.items()])
    assert sorted(ranking.quantiles(df, "v", probs, ["g"]).collect()) == sorted(want.collect())


def test_quantiles_shuffle_sums_and_a_few_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    from contextlib import redirect_stdout
    from io import StringIO

    for group in ([], ["g"]):
        said = StringIO()
        with redirect_stdout(said):
            ranking.quantiles(df, "v", {"m": 0.5}, group).explain("formatted")
        assert "NestedLoop" not in said.getvalue() and "Cartesian" not in said.getvalue() and "_range" not in said.getvalue()


def test_outliers_keep_nulls(spark):
    df = frame(spark, [("a", float(i)) for i in range(20)] + [("a", 1e6), ("a", None), ("b", 7.0)], "g string, v double")
    kept = clean.remove_outliers(df, "v", ["g"])
    assert kept.count() == 22 and kept.filter("v = 1e6").count() == 0 and kept.filter("v IS NULL").count() == 1
    assert clean.remove_outliers(df, "v").filter("v = 1e6").count() == 0


PRICES = [
    ("Rp 240.000 - Rp 460.000", 240000, 460000, "IDR"), ("$ 120", 120, 120, "USD"), ("£ 90", 90, 90, "GBP"), ("SGD 200", 200, 200, "SGD"), ("S$ 20", 20, 20, "SGD"), ("150 USD", 150, 150, "USD"), ("₿ 2", 2, 2, None), ("Rp 1.250.000", 1250000, 1250000, "IDR"), ("US$1,234.50", 1234.5, 1234.5, "USD"),
    ("350000", 350000, 350000, "IDR"), ("€99", 99, 99, "EUR"), ("no price", None, None, "IDR"), (None, None, None, None), ("12,5", 12.5, 12.5, "IDR"),
]


@pytest.mark.parametrize("label, low, high, currency", PRICES)
def test_prices(spark, label, low, high, currency):
    row = clean.price_columns(frame(spark, [(label,)], "t string"), "t").first()
    found = [None if x is None else float(x) for x in (row.price_min, row.price_max)]
    assert found == [low, high] and row.price_currency == currency


def test_to_idr_leaves_unknown_currencies_null(spark):
    df = frame(spark, [(10.0, "USD"), (10.0, "XXX"), (None, "USD")], "p double, c string")
    rates = frame(spark, [("USD", 16000.0)], "currency string, to_idr double")
    assert [r.price_idr for r in clean.to_idr(df, "p", "c", rates.unionByName(rates)).collect()] == [160000.0, None, None]
    with pytest.raises(Exception, match="two rates for USD"):
        clean.to_idr(df, "p", "c", rates.unionByName(rates.withColumn("to_idr", F.lit(2.0)))).collect()


def test_text(spark):
    df = frame(spark, [("  Héllo,\n WORLD!! 😀 42  a-b ",)], "t string")
    assert df.select(text.clean_text("t")).first()[0] == "héllo world 42 ab"
    assert df.select(text.tokens("t")).first()[0] == ["héllo", "world", "42", "ab"]
    names = frame(spark, [("Hotel Melati",), ("Melati  HOTEL",), ("The Inn",)], "t string")
    assert [r[0] for r in names.select(text.name_key("t")).collect()] == ["melati", "melati", "the"]


def test_similarity_floor_agrees(spark):
    words = ["", "a", "abc", "abcd", "melati", "melatti", "kenanga", "hotel melati jaya"]
    df = frame(spark, [(a, b) for a in words for b in words], "a string, b string")
    out = df.select(text.name_similarity("a", "b").alias("s"), text.name_similarity("a", "b", 0.6).alias("f")).collect()
    for r in out:
        assert (r.f is None) == (r.s < 0.6) and (r.f is None or r.f == pytest.approx(r.s))


def hotels(spark, rows):
    return frame(spark, rows, "id string, name string, latitude double, longitude double")


def test_matches_are_mutual_and_unique(spark):
    a = hotels(spark, [("a1", "melati", -7.8, 110.37), ("a2", "melati", -7.8, 110.37), ("a3", "melatix", -7.8001, 110.37), ("a4", None, -7.8, 110.37), ("a5", "far", 0.0, 0.0)])
    b = hotels(spark, [("b1", "melati", -7.8003, 110.3701), ("b2", "melatixx", -7.8002, 110.37), ("b3", "zzz", -7.8, 110.37), ("b4", "far", 0.0, 1.0)])
    got = {(r.a_id, r.b_id) for r in match.match_entities(a, b).collect()}
    assert got == {("a1", "b1"), ("a3", "b2")}


def test_matching_distance_is_strict(spark):
    a = hotels(spark, [("a", "x", 0.0, 0.0)])
    b = hotels(spark, [("b", "x", 0.0, 0.001)])
    d = match.match_entities(a, b, 1.0).first().distance_km
    assert match.match_entities(a, b, d).count() == 0 and match.match_entities(a, b, d * 1.000001).count() == 1


def test_the_side_of_fewer_rows_goes_to_all_its_cells(spark, monkeypatch):
    met = []
    monkeypatch.setattr(match, "radius_join", lambda left, right, *given, **named: met.append((left, right)) or radius_join(left, right, *given, **named))
    few = hotels(spark, [("f", "grand hotel", 0.0, 0.0)])
    many = hotels(spark, [(f"m{i}", "grand hotel", 0.0, i / 20000) for i in range(1, 6)])
    one, two = match.match_entities(many, few, 1.0).collect(), match.match_entities(few, many, 1.0).collect()
    assert [(r.a_id, r.b_id, r.similarity) for r in one] == [("m1", "f", 1.0)] and [(r.a_id, r.b_id) for r in two] == [("f", "m1")]
    assert one[0].distance_km == two[0].distance_km and [(x.count(), y.count()) for x, y in met] == [(1, 5), (1, 5)]


def test_merge_keeps_everyone_once(spark):
    a = frame(spark, [("a1", "n", None), ("a2", "m", 2.0)], "id string, name string, price double")
    b = frame(spark, [("b1", "x", 1.0), ("b2", "y", 4.0)], "id string, name string, price double")
    links = frame(spark, [("a1", "b1")], "a_id string, b_id string")
    rows = {r.id: r for r in match.merge_matched(a, b, links, keep_both=["price"]).collect()}
    assert set(rows) == {"a1", "a2", "b2"}
    assert (rows["a1"].price, rows["a1"].a_price, rows["a1"].b_price, rows["a1"].platform_source) == (1.0, None, 1.0, "merged")
    assert rows["a2"].platform_source == "booking" and rows["b2"].platform_source == "tripadvisor"


def test_price_comparison_and_variance(spark):
    df = frame(spark, [(1, 10.0, 5.0), (2, None, 5.0), (3, 1.0, 0.0)], "k int, a double, b double")
    rows = match.price_comparison(df, "a", "b").collect()
    assert [(r.price_difference, r.price_ratio) for r in rows] == [(5.0, 2.0), (None, None), (1.0, None)]
    assert [r[0] for r in df.select(market.row_variance(["a", "b"])).collect()] == [6.25, 0.0, 0.25]


LEXICON = [("bagus", 1), ("kotor", -1)]


def test_sentiment(spark):
    lexicon = frame(spark, LEXICON, "token string, weight int")
    rows = [("h1", "r1", "Bagus, bagus!", None), ("h1", "r2", None, "kotor"), ("h2", "r3", "sekali", None), ("h3", "r4", None, None), ("h2", "r5", "sekali", "ya")]
    df = frame(spark, rows, "h string, r string, good string, bad string")
    out = {x.h: x.sentiment for x in reviews.sentiment(df, ["h"], "r", {"good": 1, "bad": -1}, lexicon).collect()}
    assert out == {"h1": pytest.approx(1 / 3), "h2": pytest.approx(1 / 3)}
    free = {x.h: x.sentiment for x in reviews.sentiment(df, ["h"], "r", {"good": 0}, lexicon).collect()}
    assert free == {"h1": 1.0, "h2": None}


def test_recent_reviews(spark):
    df = frame(spark, [(1, "2025-06-01"), (1, "2024-12-02"), (1, "2024-12-01"), (1, "2025-06-02"), (1, None)], "h int, d string")
    row = reviews.review_counts(df, ["h"], "d", "2025-06-01").first()
    assert (row.total_reviews, row.recent_reviews) == (5, 2)


def test_categories(spark):
    df = frame(spark, [(1, "hotel_staff", 8.0), (1, "hotel_staff", 6.0), (1, "hotel_value", 5.0), (2, "other", 1.0)], "h int, code string, score double")
    wide = reviews.category_columns(df, ["h"])
    row = {r.h: r for r in reviews.category_mean(wide, reviews.CATEGORY_COLUMNS.values()).collect()}
    assert row[1].rating_staff == 7.0 and row[1].rating_comfort is None and row[1].category_rating == 6.0 and row[2].category_rating is None


def test_most_common_breaks_ties_by_alphabet(spark):
    df = frame(spark, [(1, "b"), (1, "a"), (2, "c"), (2, "c"), (2, "a"), (3, None)], "h int, v string")
    assert {r.h: r.m for r in reviews.most_common(df, ["h"], "v", "m").collect()} == {1: "a", 2: "c"}


@pytest.mark.parametrize("label, kind", [("Solo traveler", "solo"), ("FAMILY", "family"), ("Business", "business"), ("COUPLES", "couple"), ("x", None), (None, None)])
def test_traveler_type(spark, label, kind):
    assert frame(spark, [(label,)], "t string").select(reviews.traveler_type("t")).first()[0] == kind


def test_scores(spark):
    df = frame(spark, [(4.0, "tripadvisor.com", 10, 0.0), (9.0, "booking.com", 0, 100000.0), (9.0, "?", 0, None)], "r double, p string, n int, price double")
    out = df.select(scores.rating10("r", "p").alias("r10"), scores.log_price("price").alias("lp"), scores.price_per_facility("price", "n").alias("pf")).collect()
    assert [(x.r10, x.lp, x.pf) for x in out] == [(8.0, None, 0.0), (9.0, pytest.approx(math.log(1e5)), None), (None, None, None)]


def test_segments(spark):
    df = frame(spark, [(float(i),) for i in range(1, 10)] + [(None,)], "p double")
    rows = {r.p: r.market_segment for r in market.with_segment(df, "p").collect()}
    assert [rows[float(i)] for i in range(1, 10)] == ["budget"] * 3 + ["mid-range"] * 3 + ["luxury"] * 3 and rows[None] is None


def test_availability_and_preference(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (1, "a"), (2, "a")], "h int, p string")
    rows = {r.h: r for r in market.availability(df, "h", "p", 2).collect()}
    assert (rows[1].availability_score, rows[1].cross_platform_availability, rows[2].booking_platform_count) == (1.0, True, 1)
    shares = {(r.h, r.p): r.platform_preference_score for r in market.platform_preference(df, "h", "p").collect()}
    assert shares[1, "a"] == pytest.approx(2 / 3) and shares[2, "a"] == 1.0


def test_calendar(spark):
    day = datetime.date(2025, 7, 5)
    df = frame(spark, [(day,), (None,)], "d date")
    holidays = [datetime.date(2025, 7, 1), datetime.date(2025, 8, 17)]
    row, empty = temporal.with_calendar(df, "d", [7], holidays).collect()
    assert (row.is_weekend, row.month, row.quarter, row.is_peak_season, row.days_to_holiday) == (True, 7, 3, True, 4)
    assert empty.month is None and empty.days_to_holiday is None


def test_rollup_marks_subtotals(spark):
    df = frame(spark, [("hotel", 3, 10.0), ("hotel", 4, 20.0), (None, 3, 30.0)], "t string, s int, p double")
    rows = {(r.level, r.t, r.s): r.places for r in market.grouped_summary(df, ["t", "s"], "p", "p").collect()}
    assert rows[3, None, None] == 3 and rows[1, "hotel", None] == 2 and rows[1, None, None] == 1 and rows[0, None, 3] == 1


def test_stats_count_empty_and_all_null(spark):
    full = frame(spark, [(1.0,), (None,), (3.0,)], "rating double")
    out = {r.dataset: r for r in stats.dataset_stats({"full": full, "empty": full.filter("rating > 9"), "null": full.filter("rating IS NULL"), "none": full.select(F.lit(1).alias("x"))}).collect()}
    assert (out["full"].record_count, out["full"].avg_rating, out["full"].min_rating, out["full"].max_rating) == (3, 2.0, 1.0, 3.0)
    assert (out["empty"].record_count, out["empty"].avg_rating) == (0, None)
    assert (out["null"].record_count, out["null"].max_rating) == (1, None) and out["none"].columns == 1


def test_quality(spark):
    df = frame(spark, [(1, 11.0, None), (2, None, "x"), (2, 5.0, "y")], "k int, rating double, s string")
    full = {r.column: (r.present, r.completeness) for r in quality.completeness(df).collect()}
    assert full["k"] == (3, 1.0) and full["s"] == (2, pytest.approx(2 / 3))
    rules = {"rating": quality.RULES["rating_range"], "named": "s IS NOT NULL"}
    valid = {r.rule: r.valid for r in quality.accuracy(df, rules).collect()}
    assert valid == {"rating": 2, "named": 2}
    assert [(r.k, r.broken_rules) for r in quality.violations(df, rules).collect()] == [(1, ["rating", "named"])]
    assert quality.uniqueness(df, ["k"]).first().asDict() == {"duplicate_keys": 1, "rows_in_duplicates": 2}
    assert quality.uniqueness(df, ["s"], digest=True).first().duplicate_keys == 0
    assert quality.uniqueness(df.filter("k > 9"), ["k"]).first().asDict() == {"duplicate_keys": 0, "rows_in_duplicates": 0}


def test_conformance_and_timeliness(spark):
    df = frame(spark, [("a", 1, None, "2025-05-01"), ("a", None, None, "2025-05-31"), ("b", 1, 2, None), ("c", 1, 1, None)], "src string, x int, y int, d string")
    rows = {(r.source, r.field): r.null_ratio for r in quality.conformance(df, "src", {"a": ["x", "y"], "b": ["y"]}).collect()}
    assert rows == {("a", "x"): 0.5, ("a", "y"): 1.0, ("b", "y"): 0.0}
    ages = {r.src: (r.max_age_days, r.mean_age_days) for r in quality.timeliness(df, "src", "d", "2025-06-01").collect()}
    assert ages["a"] == (31, 16.0) and ages["b"] == (None, None)


def test_inconsistencies(spark):
    df = frame(spark, [(1, 9.0, 5.0, 0.9, 0.01), (2, 9.0, 8.5, 0.7, 0.09), (3, 9.0, 9.0, 0.9, 0.0)], "k int, a_rating double, b_rating double, similarity double, distance_km double")
    assert {r.k: r.disagreements for r in match.inconsistencies(df).collect()} == {1: ["rating"], 2: ["name", "position"]}


@pytest.mark.parametrize("table", [0, 1 << 24])
def test_crowded_cells_match_as_all_pairs_do(spark, monkeypatch, table):
    """All names alike, many as near and as alike as others, copies, cells in blocks: the mutual best as from all pairs."""
    import random

    from lodgewise.functions.text import name_similarity
    from lodgewise.operators import crowds, spatial

    monkeypatch.setattr(spatial, "_CROWD_PAIRS", 10)
    monkeypatch.setattr(spatial, "_CROWD_ROWS", 40)
    monkeypatch.setattr(match, "best_pairs", lambda *given: _with(crowds.best_pairs(*given), table))
    rng = random.Random(4)
    made = lambda s, n: hotels(spark, [(f"{s}{i}", f"{s}otel {rng.randint(1, 30):06d}" + "long" * 20 * (i % 9 == 0), rng.choice([0.0, rng.randint(0, 9) / 100]), rng.randint(0, 9) / 100) for i in range(n)])
    a, b = made("h", 150), made("m", 60)
    pairs = spatial.radius_join(
        a.toDF("a_id", "a_name", "a_lat", "a_lon"), b.toDF("b_id", "b_name", "b_lat", "b_lon"), 5.0, ("a_lat", "a_lon"), ("b_lat", "b_lon"), inclusive=False,
    ).withColumn("s", name_similarity("a_name", "b_name")).filter("s >= 0.5").collect()
    best = {}
    for r in pairs:
        for own, other in ((r.a_id, r.b_id), (r.b_id, r.a_id)):
            best[own] = min(best.get(own, (9.0,)), (-r.s, r.distance_km, other))
    want = {(r.a_id, r.b_id, r.s, r.distance_km) for r in pairs if best[r.a_id][2] == r.b_id and best[r.b_id][2] == r.a_id}
    got = [tuple(r) for r in match.match_entities(a, b, 5.0, 0.5).collect()]
    assert len(got) == len(want) > 10 and set(got) == want


def _with(keep, table):
    def limited(left, right):
        from lodgewise.operators import crowds

        crowds._TABLE = table
        return keep(left, right)

    return limited


def test_few_pairs_of_a_crowded_cell_go_on():
    import pyarrow as pa

    from lodgewise.operators.crowds import best_pairs

    side = lambda s, n: pa.table({f"{s}_id": list(range(n)), f"{s}_name": [f"hotel {i % 100:04d}" for i in range(n)], f"{s}_lat": [0.0] * n, f"{s}_lon": [i / 1e5 for i in range(n)]})
    a, b = side("a", 400), side("b", 300)
    i, j = best_pairs(5.0, 0.5, *[tuple(f"{s}_{c}" for c in ("id", "name", "lat", "lon")) for s in "ab"])(a, b)
    assert len(i) <= 800 and {(x, x) for x in range(300)} <= set(zip(i.tolist(), j.tolist()))

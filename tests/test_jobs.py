import json

import pytest
from pyspark.sql import functions as F

from conftest import CASES, HOTEL, OTHER_HOTEL, OTHER_REVIEW, PLACE, REVIEW
from lodgewise.operators.classify import classify
from lodgewise.plans import batch
from lodgewise.schema import FEATURE_COLUMNS, raw_schema
from lodgewise.session import cut, shared_folder
from lodgewise.sources import tables
from lodgewise.streaming.incremental import run_available, stream_feed

ROWS = len(CASES)


@pytest.fixture()
def settings(spark):
    return batch.Settings(
        as_of="2025-06-01",
        rates=spark.createDataFrame([("IDR", 1.0)], "currency string, to_idr double"),
        lexicon=spark.createDataFrame([("bagus", 1)], "token string, weight int"),
        landmarks={
            "distance_to_city_center": (-7.8, 110.37), "distance_to_malioboro": (-7.79, 110.366), "distance_to_airport": (-7.9, 110.06),
        },
        peak_months=(6, 7),
    )


def test_distances(classified):
    typed = batch.typed_tables(classified, "2025-06-01")
    pairs = batch.hotel_attraction_distances([typed["booking_hotels"], typed["tripadvisor_hotels"]], typed["geospatial_attractions"])
    assert pairs.columns == [
        "hotel_name", "latitude", "longitude", "platform", "attraction_name", "attr_latitude", "attr_longitude", "category_name", "distance_km",
    ]
    # Hotel 1 twice (it was scraped twice) and the other platform's hotel, each near two places.
    assert pairs.count() == 6
    assert all(1.8 < r.distance_km < 2.0 for r in pairs.collect())
    single = batch.hotel_attraction_distances(typed["booking_hotels"], typed["geospatial_attractions"])
    assert single.count() == 4


def test_model_tables(classified, settings):
    made = batch.model_tables(classified, settings)
    wide = made["prediction_dataset"]
    assert [(f.name, f.dataType.simpleString()) for f in wide.schema.fields] == FEATURE_COLUMNS and len(FEATURE_COLUMNS) == 63
    rows = wide.collect()
    assert len(rows) == 3 and len({r.hotel_id for r in rows}) == 3
    merged = next(r for r in rows if r.platform_source == "merged")
    assert merged.price_idr == 300000.0 and merged.stars == 4.0 and merged.overall_rating == 8.0
    assert merged.has_wifi and merged.has_ac and merged.has_pool and merged.cross_platform_availability
    assert merged.price_variance_platforms == pytest.approx(((350000 - 300000) / 2) ** 2)
    assert merged.total_reviews == 3 and merged.review_sentiment_score == 1.0 and merged.rating_staff == 6.5
    assert merged.attraction_density_1km == 0 and merged.attraction_density_2km == 2 and merged.restaurant_density_1km == 0
    assert merged.distance_to_nearest_attraction == pytest.approx(1.876, abs=1e-2) and merged.competitors_within_500m == 0
    assert merged.target_traveler_type == "solo" and merged.month == 5 and merged.is_peak_season is False
    lost = next(r for r in rows if r.latitude is None)
    assert lost.attraction_density_1km is None and lost.price_rank_in_area is None and lost.platform_source == "booking"
    assert {c for t in ("hotel_features", "review_features", "geospatial_features") for c in made[t].columns} <= {c for c, _ in FEATURE_COLUMNS}
    assert made["review_features"].count() == made["geospatial_features"].count() == made["hotel_features"].count() == 3


def test_run_writes_all_and_reruns_the_same(spark, raw, settings, tmp_path):
    out = str(tmp_path / "out")
    first = batch.run(spark, raw, out, settings, features=False)
    stats = {r.dataset: r.record_count for r in first.collect()}
    assert stats == {
        "booking_hotels": 3, "booking_reviews": 2, "tripadvisor_hotels": 2, "tripadvisor_reviews": 1, "geospatial_attractions": 2,
        "hotel_attraction_distances": 6,
    }
    names = [*stats, "classified", "quarantine", *(f"dq_{n}" for n in ("conformance", "completeness", "accuracy", "timeliness", "uniqueness", "violations"))]
    before = {n: spark.read.parquet(f"{out}/{n}").count() for n in names}
    batch.run(spark, raw, out, settings, features=False)
    assert {n: spark.read.parquet(f"{out}/{n}").count() for n in names} == before and before["classified"] == ROWS
    assert (tmp_path / "out" / "booking_hotels" / "platform=booking.com").exists()


def test_quality_tables(spark, raw, settings, tmp_path):
    out = str(tmp_path / "out")
    batch.run(spark, raw, out, settings)
    table = lambda n: spark.read.parquet(f"{out}/dq_{n}")
    uniqueness = {r.dataset: (r.duplicate_keys, r.rows_in_duplicates) for r in table("uniqueness").collect()}
    assert uniqueness["booking_hotels"] == (1, 2) and uniqueness["geospatial_attractions"] == (0, 0) and len(uniqueness) == 5
    complete = {(r.dataset, r.column): r.present for r in table("completeness").collect()}
    assert complete["booking_hotels", "hotel_name"] == 3 and complete["booking_hotels", "latitude"] == 2
    assert {r.dataset for r in table("timeliness").collect()} == set(batch.DATASET_KEYS)
    assert {(r.dataset, r.rule) for r in table("accuracy").collect()} >= {("booking_hotels", "stars_range"), ("booking_reviews", "stay_order")}
    assert table("violations").count() == 0 and table("conformance").count() > 20 and "disagreements" in table("consistency").columns


def test_measures_taken_while_writing_equal_scans(spark, raw, settings, tmp_path):
    from lodgewise.operators import quality, stats
    from lodgewise.operators.classify import CLASS
    from lodgewise.schema import REQUIRED

    out = str(tmp_path / "out")
    rows = raw.unionByName(raw.filter("name IS NOT NULL").withColumns({"row_id": F.col("row_id") + 1, "rating": F.lit(99.0)}))
    batch.run(spark, rows, out, settings, features=False)
    table = lambda n: spark.read.parquet(f"{out}/{n}")
    same = lambda n, want: sorted(map(str, table(n).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    stored = {n: table(n) for n in [*batch.DATASET_KEYS, "hotel_attraction_distances"]}
    assert same("summary_statistics", stats.dataset_stats(stored))
    assert same("dq_conformance", quality.conformance(table("classified"), CLASS, REQUIRED))
    for name, (_, date) in batch.DATASET_KEYS.items():
        df, of = stored[name], lambda n: table(n).filter(F.col("dataset") == name)  # noqa: B023, E731
        rules = quality.rules_for(df.columns)
        plain = lambda df: sorted(map(str, df.collect()))
        assert plain(of("dq_completeness").drop("dataset")) == plain(quality.completeness(df))
        assert plain(of("dq_accuracy").drop("dataset")) == plain(quality.accuracy(df, rules))
        ages = quality.timeliness(df.withColumn("dataset", F.lit(name)), "dataset", date, settings.as_of)
        assert plain(of("dq_timeliness").select(*ages.columns)) == plain(ages)
        assert of("dq_violations").count() == quality.violations(df, rules).count()
    assert table("dq_violations").count() > 0


def test_rerun_forgets_what_the_feed_no_longer_has(spark, raw, settings, tmp_path):
    out = str(tmp_path / "out")
    batch.run(spark, raw, out, settings, features=False)
    stats = batch.run(spark, raw.filter("placeId IS NULL"), out, settings, features=False)
    counts = {r.dataset: r.record_count for r in stats.collect()}
    assert counts["geospatial_attractions"] == counts["hotel_attraction_distances"] == 0 and counts["booking_hotels"] == 3


def test_classified_folders_are_pruned(spark, raw, tmp_path):
    from lodgewise.operators.classify import of_class

    landed = batch.land_classified(raw, str(tmp_path / "c"))
    plan = of_class(landed, "booking_hotel").select("hotelId")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_source_type" in plan and "ReadSchema: struct<hotelId:bigint>" in plan


def test_empty_feed_gives_empty_tables(spark, settings, tmp_path):
    empty = spark.createDataFrame([], raw_schema()).withColumn("row_id", F.lit(1).cast("bigint"))
    stats = batch.run(spark, empty, str(tmp_path / "out"), settings)
    assert {r.record_count for r in stats.collect()} == {0}
    assert len(spark.read.parquet(str(tmp_path / "out" / "prediction_dataset")).columns) == 63


def test_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, platform string")
    path = str(tmp_path / "t")
    tables.write_table(df, path)
    tables.write_table(df.filter("platform = 'a'").withColumn("x", F.lit(9)), path)
    assert {(r.x, r.platform) for r in spark.read.parquet(path).collect()} == {(9, "a"), (2, "b")}
    flat = str(tmp_path / "flat")
    tables.write_table(df, flat, partition_by=())
    tables.write_table(df, flat, partition_by=(), even=True)
    assert spark.read.parquet(flat).count() == 2


def test_write_failures_are_raised_after_all_were_tried(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "x int")
    bad = good.select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(ExceptionGroup) as caught:
        tables.write_tables({"bad": bad, "good": good}, str(tmp_path))
    assert len(caught.value.exceptions) == 1
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1


def test_incremental_reads_each_file_once(spark, tmp_path):
    inbox, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    inbox.mkdir()
    (inbox / "a.json").write_text(json.dumps([HOTEL, REVIEW], indent=1))
    (inbox / "a.tmp").write_text("x")

    def go():
        run_available(stream_feed(spark, str(inbox)), out, mark, ["data_source_type"], classify)
        return spark.read.parquet(out).count()

    assert go() == 2 and go() == 2
    (inbox / "b.json").write_text(json.dumps([OTHER_HOTEL, OTHER_REVIEW, PLACE]))
    assert go() == 5 and go() == 5


def test_profile_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, None, [1]), (2, "x", None)], "a int, b string, c array<int>")
    rows = {r.column: r for r in tables.column_profile({"t": df}).collect()}
    assert rows["b"].present == 1 and rows["a"].distinct_estimate == 2 and rows["c"].type == "array<int>" and rows["a"].rows == 2
    tables.write_table(df, str(tmp_path / "t"), ())
    report = tables.write_catalog_report(spark, {"t": str(tmp_path / "t")}, str(tmp_path / "report"))
    assert report.count() == 3 and report.first().bytes > 0
    assert spark.read.json(str(tmp_path / "report")).count() == 3


def test_schema_paths():
    paths = dict(tables.schema_rows(raw_schema()))
    assert paths["location.lat"] == "string" and paths["facilities[].facilities[].name"] == "string"
    assert paths["user.contributions.totalContributions"] == "int"


def test_lookup_tables_are_joined_by_their_size(spark):
    from lodgewise.operators import clean

    rows = spark.range(10**7).select(F.lit(2.0).alias("p"), F.col("id").cast("string").alias("c"))
    rates = spark.range(3).select(F.col("id").cast("string").alias("currency"), F.lit(5.0).alias("to_idr"))
    plan = lambda: clean.to_idr(rows, "p", "c", rates)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checkpoints_go_to_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut(spark.range(3)).count() == 3


def test_facts_of_reviews_are_not_broadcast(spark, classified):
    """Many facts come out of small files, so their estimated size must not send them through the driver."""
    from lodgewise.plans import batch

    tables = batch.typed_tables(classified, "2025-06-01")
    rows = batch.all_reviews(tables)
    merged = spark.createDataFrame([("h", "booking.com:1", None, 1.0, 2.0, 3.0)], "hotel_id string, a_id string, b_id string, rating double, a_rating double, b_rating double")
    lexicon = spark.createDataFrame([("bagus", 1)], "token string, weight int")
    settings = batch.Settings("2025-06-01", None, lexicon, {})
    plan = batch.review_features(rows, merged, settings)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin [id#" in line]

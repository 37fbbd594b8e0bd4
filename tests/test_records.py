import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import CASES
from lodgewise.functions.casts import choice_double, to_int
from lodgewise.operators import nested, project
from lodgewise.operators.classify import CORRECTED, STRICT, class_counts, classify, of_class, quarantine
from lodgewise.operators.facilities import accessibility_index, facility_flags, facility_names
from lodgewise.operators.records import explode_records
from lodgewise.schema import raw_schema
from lodgewise.sources.feeds import infer_feed_schema, merge_schemas, read_catalog_table, read_feed, without_junk

ROWS = len(CASES)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_reads_arrays_and_skips_junk(raw):
    assert raw.count() == ROWS
    assert raw.select("source_file").distinct().count() == 1


def test_junk_patterns(spark):
    df = spark.createDataFrame([("a/x.json",), ("a/x.tmp",), ("a/run.log",), ("a/x_$folder$",)], "source_file string")
    assert [r[0] for r in without_junk(df).collect()] == ["a/x.json"]


def test_row_ids_are_stable(spark, feed_dir, raw):
    again = read_feed(spark, feed_dir).repartition(3)
    ids = sorted(r[0] for r in raw.select("row_id").collect())
    assert ids == sorted(r[0] for r in again.select("row_id").collect())
    assert len(set(ids)) == ROWS


@pytest.mark.parametrize("rules, column", [(STRICT, 1), (CORRECTED, 2)])
def test_classes(raw, rules, column):
    counts = {r[0]: r[1] for r in class_counts(classify(raw, rules)).collect()}
    assert counts == dict(Counter(c[column] for c in CASES))


def test_every_row_has_one_class(classified):
    assert sum(of_class(classified, r.label).count() for r in CORRECTED) + of_class(classified, "unknown").count() == ROWS


def test_quarantine_keeps_errors_and_unknown(classified):
    assert quarantine(classified).count() == 2


def test_catalog_table_shape(spark, raw):
    fields = [f.name for f in raw_schema(keep_corrupt=False).fields]
    table = raw.groupBy().agg(F.collect_list(F.struct(*fields)).alias("array"))
    table.createOrReplaceTempView("raw_table")
    rows = read_catalog_table(spark, "raw_table")
    assert rows.count() == ROWS and rows.select("row_id").distinct().count() == ROWS
    counts = {r[0]: r[1] for r in class_counts(classify(rows)).collect()}
    assert counts == dict(Counter(c[2] for c in CASES))


def test_explode_gives_no_row_for_null_or_empty(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None)], "k int, array array<int>")
    rows = explode_records(df, expand=False)
    assert [(r.k, r.position, r.record) for r in rows.orderBy("k", "position").collect()] == [(1, 0, 5), (1, 1, 6)]


def test_flat_frame_passes(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert explode_records(df).columns == ["k", "row_id"]


def test_booking_hotel_columns(classified):
    table = project.booking_hotels(classified, "2025-06-01")
    assert len(table.columns) == 24
    row = one(table.filter("booking_hotel_id = 1 AND stars = 3"))
    assert (row.latitude, row.longitude, row.rating) == (-7.8, 110.37, None)
    assert (row.postal_code, row.country, row.region, row.street_address, row.full_address) == ("55000", "Indonesia", "Jawa", "Jl. A", "Jl. A")
    assert row.platform == "booking.com" and row.processed_at == datetime.datetime(2025, 6, 1)
    assert one(table.filter("booking_hotel_id = 2")).latitude is None


def test_booking_review_columns(classified):
    table = project.booking_reviews(classified)
    assert len(table.columns) == 20
    row = one(table.filter("review_id = 'r1'"))
    assert row.rating == 10.0 and row.review_date == datetime.date(2025, 3, 21) and row.check_in_date == datetime.date(2025, 3, 18)
    assert one(table.filter("review_id = 'r2'")).review_title is None


def test_tripadvisor_columns(classified):
    hotels = project.tripadvisor_hotels(classified)
    assert len(hotels.columns) == 27
    row = one(hotels.filter("tripadvisor_location_id = '90'"))
    assert row.ranking_denominator == 410 and row.hotel_class == "3.0" and row.full_address == "Jl. B"
    reviews = project.tripadvisor_reviews(classified)
    assert len(reviews.columns) == 16
    row = one(reviews)
    assert row.photos_count == 0 and row.user_location is None and row.travel_date == "2025-02"
    assert row.published_date == datetime.date(2025, 5, 23)


def test_attraction_columns(classified):
    table = project.geospatial_attractions(classified)
    assert len(table.columns) == 23
    row = one(table.filter("place_id = 'p1'"))
    assert (row.latitude, row.longitude, row.rating, row.reviews_count) == (-7.801, 110.387, 4.1, 230)


def test_empty_class_keeps_its_columns(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    nothing = classify(read_feed(spark, str(tmp_path)))
    for name, make in project.PROJECTIONS.items():
        table = make(nothing)
        assert table.count() == 0 and "platform" in table.columns, name


def test_nested_tables(classified):
    hotels = project.booking_hotels(classified).filter("booking_hotel_id = 2")
    rows = {(r.category, r.overview, r.facility) for r in nested.facilities_long(hotels, ["booking_hotel_id"]).collect()}
    assert rows == {("Umum", None, "AC"), ("Internet", "Wi-Fi tersedia", None)}
    places = project.geospatial_attractions(classified)
    flags = {(r["group"], r.label, r.flag) for r in nested.info_flags_long(places, ["place_id"]).collect()}
    assert flags == {("Accessibility", "Wheelchair accessible seating", False), ("Parking", "Free parking lot", True)}
    assert nested.info_flags_long(places, ["place_id"], outer=True).filter("place_id = 'p2'").count() == 1
    reviews = project.booking_reviews(classified).filter("review_id = 'r1'")
    assert nested.rating_scores_long(reviews, ["review_id"]).count() == 6
    assert nested.opening_hours_long(places, ["place_id"]).filter("place_id = 'p1'").first().hours == "9 AM to 5 PM"


def test_facility_flags(classified):
    hotels = project.booking_hotels(classified).filter("booking_hotel_id = 2").withColumn("names", facility_names())
    row = one(facility_flags(hotels, "names", also={"has_breakfast": F.col("breakfast").isNotNull()}))
    assert (row.has_wifi, row.has_ac, row.has_pool, row.has_breakfast) == (True, True, False, False)
    other = project.tripadvisor_hotels(classified).filter("tripadvisor_location_id = '90'")
    row = one(facility_flags(other, "amenities"))
    assert (row.has_wifi, row.has_ac, row.has_pool, row.has_spa) == (True, True, True, False)


def test_accessibility(spark, classified):
    places = project.geospatial_attractions(classified)
    found = {r.place_id: r.a for r in places.select("place_id", accessibility_index().alias("a")).collect()}
    assert found == {"p1": 0.0, "p2": None}


def test_lenient_casts(spark):
    df = spark.createDataFrame([("3.0",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(to_int("s")).collect()] == [3, None, None]
    choice = spark.sql("SELECT named_struct('double', CAST(NULL AS DOUBLE), 'int', 10) AS rating")
    assert choice.select(choice_double("rating")).first()[0] == 10.0


def test_schema_discovery(spark, feed_dir):
    schema = infer_feed_schema(spark, feed_dir)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds["rating"] == "double" and "placeId" in kinds and kinds["address"] == "string"
    merged = merge_schemas(spark.createDataFrame([(1,)], "a int").schema, spark.createDataFrame([(1, 2)], "a long, b int").schema)
    assert merged.simpleString() == "struct<a:bigint,b:int>"

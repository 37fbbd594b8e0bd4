"""The batch job: mixed records in, typed tables, distances, statistics and model tables out."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgewise.functions import scores
from lodgewise.functions.casts import known_fraction, to_int
from lodgewise.functions.text import NAME_STOP_WORDS, name_key
from lodgewise.operators import clean, facilities, market, match, nested, quality, reviews, spatial, temporal
from lodgewise.operators.classify import CLASS, CORRECTED, classify, of_class, quarantine
from lodgewise.operators.project import PROJECTIONS, load_time
from lodgewise.operators.ranking import percent_rank
from lodgewise.operators.vocabulary import with_vocabulary
from lodgewise.schema import FEATURE_COLUMNS, REQUIRED
from lodgewise.session import cut
from lodgewise.sources.tables import observed, write_table, write_tables

HOTEL_POINT = ("hotel_name", "latitude", "longitude", "platform")


@dataclass
class Settings:
    """What the data does not say: the day of the run and the caller's small tables."""

    as_of: str
    rates: DataFrame
    lexicon: DataFrame
    landmarks: dict[str, tuple[float, float]]
    peak_months: tuple[int, ...] = ()
    holidays: tuple | DataFrame = ()  # days, or a table with a column `date`
    stop_words: tuple[str, ...] = NAME_STOP_WORDS
    vocabulary: tuple | DataFrame = facilities.VOCABULARY  # rules, or a table (platform, pattern, mode, flag)
    radius_km: float = 10.0
    match_km: float = 0.1
    match_floor: float = 0.6
    area_km: float = 5.0
    drop_outliers: bool = True
    known_platforms: int = 2
    # Natural key and scrape time of each record class.
    keys: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "booking_hotel": ("hotelId", "timeOfScrapeISO"),
        "booking_review": ("id", "reviewDate"),
        "tripadvisor_hotel": ("coalesce(locationId, id)", "timeOfScrapeISO"),
        "tripadvisor_review": ("id", "publishedDate"),
        "geospatial_attraction": ("placeId", "scrapedAt"),
    })


def typed_tables(classified: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """The five flat tables; a class without records gives an empty table."""
    return {name: project(classified, as_of) for name, project in PROJECTIONS.items()}


def hotel_attraction_distances(hotels, attractions: DataFrame, radius_km: float = 10.0) -> DataFrame:
    """All hotel and attraction pairs within the radius. `hotels` is one table or a list of them."""
    frames = hotels if isinstance(hotels, (list, tuple)) else [hotels]
    points = spatial.union_all(
        spatial.standard_points(h, {c: c for c in HOTEL_POINT} | {"_hotel_row": "source_row_id"}) for h in frames
    )
    places = spatial.standard_points(attractions, {
        "attraction_name": "attraction_name", "attr_latitude": "latitude", "attr_longitude": "longitude",
        "category_name": "category_name", "_place_row": "source_row_id",
    }, "attr_latitude", "attr_longitude")
    pairs = spatial.radius_join(points, places, radius_km)
    return pairs.select(*HOTEL_POINT, "attraction_name", "attr_latitude", "attr_longitude", "category_name", "distance_km")


def latest_records(classified: DataFrame, label: str, settings: Settings) -> DataFrame:
    """Records of a class with a key, the latest one per key."""
    key, scraped = settings.keys[label]
    rows = of_class(classified, label).withColumns({
        "_key": F.expr(key).cast("string"), "collected_at": F.col(scraped).try_cast("timestamp"),
    })
    return clean.latest_per_key(clean.drop_missing(rows, ["_key"]), ["_key"], "collected_at", "row_id").drop("_key")


def clean_tables(classified: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The flat tables of the latest record per key, with the time of collection."""
    labels = dict(zip(PROJECTIONS, settings.keys))
    return {
        name: project(latest_records(classified, labels[name], settings), settings.as_of, [F.col("collected_at")])
        for name, project in PROJECTIONS.items()
    }


def platform_hotels(tables: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """Hotels of both platforms in one shape: key, name, position, class, price in IDR, rating 0-10, facilities."""
    b, t = tables["booking_hotels"], tables["tripadvisor_hotels"]
    collected = F.coalesce("collected_at", "processed_at").alias("collected_at")
    booking = b.select(
        "platform", F.col("booking_hotel_id").cast("string").alias("key"), "hotel_name", "accommodation_type",
        F.col("stars").cast("double").alias("stars"), F.col("stars").alias("hotel_class"),
        "latitude", "longitude", F.col("price").alias("price_text"), "currency",
        F.col("rating"), F.col("reviews").alias("listed_reviews"),
        facilities.facility_names().alias("names"),
        (F.length(F.trim("breakfast")) > 0).alias("breakfast"), collected,
    )
    tripadvisor = t.select(
        "platform", F.col("tripadvisor_location_id").alias("key"), "hotel_name", "accommodation_type",
        F.col("hotel_class").try_cast("double").alias("stars"), to_int("hotel_class").alias("hotel_class"),
        "latitude", "longitude", F.col("price_range").alias("price_text"), F.lit(None).cast("string").alias("currency"),
        F.col("rating"), F.col("reviews_count").alias("listed_reviews"),
        F.col("amenities").alias("names"), F.lit(None).cast("boolean").alias("breakfast"), collected,
    )
    both = spatial.union_all([booking, tripadvisor])
    both = clean.to_idr(clean.price_columns(both, "price_text", "currency"), "price_mid", "price_currency", settings.rates)
    both = both.withColumns({
        "rating": scores.rating10("rating", "platform"),
        "name_key": name_key("hotel_name", settings.stop_words),
        "id": F.concat_ws(":", "platform", "key"),
    })
    return both.select(
        "id", "platform", "key", "hotel_name", "name_key", "accommodation_type", "stars", "hotel_class", "latitude",
        "longitude", "price_idr", "rating", "listed_reviews", "names", "breakfast", "collected_at",
    )


def platform_links(hotels: DataFrame, settings: Settings) -> DataFrame:
    """Which hotels of the two platforms are the same: a_id, b_id, similarity, distance_km."""
    a, b = (hotels.filter(F.col("platform") == p).withColumnRenamed("name_key", "name") for p in ("booking.com", "tripadvisor.com"))
    return cut(match.match_entities(a, b, settings.match_km, settings.match_floor))


def merged_hotels(hotels: DataFrame, links: DataFrame) -> DataFrame:
    """One row per hotel: matched across platforms, values of the first platform before the second."""
    a, b = (hotels.filter(F.col("platform") == p) for p in ("booking.com", "tripadvisor.com"))
    per_side = ("id", "price_idr", "rating", "names", "listed_reviews")
    merged = match.merge_matched(a, b, links, keep_both=per_side)
    return merged.withColumns({
        "hotel_id": F.sha2("id", 256),
        "names": F.when(
            F.coalesce("a_names", "b_names").isNotNull(),
            F.concat(F.coalesce("a_names", F.array()), F.coalesce("b_names", F.array())),
        ),
        "rating": F.when(F.col("a_rating").isNotNull() & F.col("b_rating").isNotNull(), (F.col("a_rating") + F.col("b_rating")) / 2)
        .otherwise(F.col("rating")),
    })


def hotel_links(merged: DataFrame) -> DataFrame:
    """(id, hotel_id): which merged hotel a platform's hotel became."""
    ids = F.array_compact(F.array("a_id", "b_id"))
    return merged.select("hotel_id", F.explode(ids).alias("id"))


def all_reviews(tables: dict[str, DataFrame]) -> DataFrame:
    """Reviews of both platforms in one shape."""
    b, t = tables["booking_reviews"], tables["tripadvisor_reviews"]
    none = F.lit(None).cast("string")
    booking = b.select(
        F.concat_ws(":", "platform", F.col("booking_hotel_id").cast("string")).alias("id"), "platform",
        F.concat_ws(":", "platform", "review_id").alias("review"), F.col("review_date").alias("date"),
        F.col("traveler_type").alias("traveler"), "liked_text", "disliked_text", none.alias("review_text"), "category_ratings",
    )
    tripadvisor = t.select(
        F.concat_ws(":", "platform", "tripadvisor_location_id").alias("id"), "platform",
        F.concat_ws(":", "platform", "review_id").alias("review"), F.col("published_date").alias("date"),
        F.col("trip_type").alias("traveler"), none.alias("liked_text"), none.alias("disliked_text"), "review_text",
        F.lit(None).cast(b.schema["category_ratings"].dataType).alias("category_ratings"),
    )
    return spatial.union_all([booking, tripadvisor])


def review_features(rows: DataFrame, merged: DataFrame, settings: Settings) -> DataFrame:
    """Per hotel: counts, category ratings, sentiment, traveller type, share of the main platform."""
    links = hotel_links(merged)

    def per_hotel(facts: DataFrame) -> DataFrame:
        # Sorted, not broadcast: the size of the feed's files says little of how many facts come out of them.
        return facts.hint("merge").join(links, "id").drop("id")

    counts = per_hotel(reviews.review_counts(rows, ["id", "platform"], "date", settings.as_of))
    totals = counts.groupBy("hotel_id").agg(
        F.sum("total_reviews").cast("int").alias("total_reviews"),
        F.sum("recent_reviews").cast("int").alias("recent_reviews"),
        (F.max("total_reviews") / F.sum("total_reviews")).alias("platform_preference_score"),

    )
    long = nested.rating_scores_long(rows, ["id"]).distinct()
    categories = reviews.category_columns(per_hotel(long), ["hotel_id"])
    texts = {"liked_text": 1, "disliked_text": -1, "review_text": 0}
    weights = per_hotel(reviews.sentiment_weights(rows, ["id"], "review", texts, settings.lexicon))
    weights = weights.groupBy("hotel_id").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    feeling = weights.select("hotel_id", reviews.sentiment_score().alias("review_sentiment_score"))
    typed = rows.withColumn("kind", reviews.traveler_type("traveler")).filter(F.col("kind").isNotNull())
    typed = per_hotel(typed.groupBy("id", "kind").agg(F.count(F.lit(1)).alias("n")))
    travelers = reviews.most_common(typed, ["hotel_id"], "kind", "target_traveler_type", "n")
    own = merged.select(
        "hotel_id", F.col("rating").alias("overall_rating"),
        scores.review_consistency("a_rating", "b_rating").alias("review_consistency"),
    )
    out = own
    for part in (totals, categories, feeling, travelers):
        out = out.join(part, "hotel_id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_reviews", "recent_reviews")})


def geospatial_features(merged: DataFrame, attractions: DataFrame, settings: Settings) -> DataFrame:
    """Per hotel: distances to landmarks and the nearest attraction, densities, competitors."""
    places = attractions.select("latitude", "longitude", "category_name", "attraction_name").dropna(subset=["latitude", "longitude"])
    points = merged.select("hotel_id", "latitude", "longitude")
    out = spatial.landmark_distances(points, settings.landmarks)
    out = spatial.nearest(out, places, "distance_to_nearest_attraction")
    rings = {f"attraction_density_{r}km": float(r) for r in (1, 2, 5)}
    out = spatial.count_within(out, places, rings)
    restaurants = places.filter(F.lower("category_name").contains("restaurant"))
    out = spatial.count_within(out, restaurants, {"restaurant_density_1km": 1.0})
    out = spatial.count_within(out, points, {"competitors_within_500m": 0.5}, minus=1)
    numbers = [*rings, "restaurant_density_1km", "competitors_within_500m"]
    return out.withColumns({c: F.col(c).cast("int") for c in numbers})


def hotel_features(merged: DataFrame, settings: Settings) -> DataFrame:
    """Per hotel: identity, class, facilities, price, market position, calendar, collection."""
    also = {"has_breakfast": F.col("breakfast")}
    if isinstance(settings.vocabulary, DataFrame):
        flagged = with_vocabulary(merged, "hotel_id", "names", settings.vocabulary, facilities.FLAGS, also=also)
    else:
        flagged = facilities.facility_flags(merged, "names", settings.vocabulary, also=also)
    flagged = flagged.withColumns({
        "facilities_score": scores.facilities_score(facilities.FLAGS),
        "_area": spatial.area_cell(size_km=settings.area_km),
        "_facilities": F.size("names"),
        "booking_platform_count": F.size(F.array_compact(F.array("a_id", "b_id"))),
        "price_variance_platforms": market.row_variance(["a_price_idr", "b_price_idr"]),
        "log_price": scores.log_price("price_idr"),
        "popularity_score": scores.popularity("rating", F.coalesce("listed_reviews", F.lit(0))),
    })
    ranked = percent_rank(flagged.select("hotel_id", "_area", "price_idr", "rating"), "price_idr", "price_rank_in_area", ["_area"])
    ranked = percent_rank(ranked, "rating", "rating_rank_in_area", ["_area"])
    ranked = market.with_segment(ranked, "price_idr").drop("_area", "price_idr", "rating")
    flagged = flagged.withColumns({
        "price_per_facility": scores.price_per_facility("price_idr", "_facilities"),
        "value_score": scores.value_score("facilities_score", "price_idr"),
        "cross_platform_availability": F.col("booking_platform_count") > 1,
        "availability_score": F.col("booking_platform_count") / F.lit(float(settings.known_platforms)),
        "data_freshness_score": scores.freshness("collected_at", F.lit(settings.as_of).cast("date")),
    })
    dated = temporal.with_calendar(flagged, "collected_at", settings.peak_months, settings.holidays)
    return dated.join(ranked, "hotel_id")


def prediction_dataset(hotel: DataFrame, review: DataFrame, geo: DataFrame, settings: Settings) -> DataFrame:
    """The 63 model columns, one row per hotel."""
    wide = hotel.join(review, "hotel_id", "left").join(geo.drop("latitude", "longitude"), "hotel_id", "left")
    wide = wide.withColumns({
        "hotel_name_clean": F.col("name_key"),
        "accessibility_score": scores.accessibility_score("distance_to_city_center"),
        "experience_score": scores.experience_score("overall_rating", F.coalesce("review_sentiment_score", F.lit(0.0))),
        "data_collection_date": F.col("collected_at"),
        "last_updated": load_time(settings.as_of),
    })
    measured = [c for c, _ in FEATURE_COLUMNS if c != "data_completeness_score"]
    wide = wide.withColumn("data_completeness_score", known_fraction(measured))
    return wide.select(*[F.col(c).cast(kind).alias(c) for c, kind in FEATURE_COLUMNS])


def _columns_of(part: DataFrame, first: list[str]) -> list[Column]:
    wanted = {c for c, _ in FEATURE_COLUMNS}
    return [F.col(c) for c in first] + [F.col(c) for c, _ in FEATURE_COLUMNS if c in part.columns and c in wanted and c not in first]


MODEL_TABLES = ("prediction_dataset", "hotel_features", "review_features", "geospatial_features")


def model_tables(classified: DataFrame, settings: Settings, names=MODEL_TABLES) -> dict[str, DataFrame]:
    """`prediction_dataset` and its three parts, or those of them that are named."""
    tables = clean_tables(classified, settings)
    hotels = cut(platform_hotels(tables, settings))
    if settings.drop_outliers:
        hotels = cut(clean.remove_outliers(hotels, ["price_idr", "rating"], ["platform"]))
    links = platform_links(hotels, settings)
    merged = cut(merged_hotels(hotels, links))
    whole = "prediction_dataset" in names
    made = {}
    if "dq_consistency" in names:
        pairs = merged.select("hotel_id", "a_id", "b_id", "a_rating", "b_rating").join(links, ["a_id", "b_id"])
        made["dq_consistency"] = match.inconsistencies(pairs)
    if whole or "hotel_features" in names:
        hotel = hotel_features(merged, settings)
        hotel = cut(hotel) if whole else hotel
        made["hotel_features"] = hotel.withColumn("hotel_name_clean", F.col("name_key")).select(
            *_columns_of(hotel, ["hotel_id", "hotel_name_clean"])
        )
    if whole or "review_features" in names:
        review = review_features(cut(all_reviews(tables)), merged, settings)
        review = cut(review) if whole else review
        made["review_features"] = review.select(*_columns_of(review, ["hotel_id"]))
    if whole or "geospatial_features" in names:
        places = tables["geospatial_attractions"].select("latitude", "longitude", "category_name", "attraction_name")
        geo = geospatial_features(merged, cut(places), settings)
        geo = cut(geo) if whole else geo
        made["geospatial_features"] = geo.select(*_columns_of(geo, ["hotel_id"]))
    if whole:
        made["prediction_dataset"] = prediction_dataset(hotel, review, geo, settings)
    return {n: made[n] for n in names}


# Keys and dates of the typed tables, for the measures of quality.
DATASET_KEYS = {
    "booking_hotels": ("booking_hotel_id", "processed_at"), "booking_reviews": ("review_id", "review_date"),
    "tripadvisor_hotels": ("tripadvisor_location_id", "processed_at"), "tripadvisor_reviews": ("review_id", "published_date"),
    "geospatial_attractions": ("place_id", "processed_at"),
}


def table_measures(name: str, df: DataFrame, as_of: str) -> dict[str, Column]:
    """What is measured of a typed table while it is written."""
    date = DATASET_KEYS[name][1] if name in DATASET_KEYS else None
    return quality.row_measures(df.columns, quality.rules_for(df.columns) if date else {}, date, as_of, "rating" if "rating" in df.columns else None)


def statistics(spark: SparkSession, seen: dict[str, dict], columns: dict[str, int]) -> DataFrame:
    """(dataset, record_count, columns, avg_rating, min_rating, max_rating) from the measures of each table."""
    rows = [(n, s["rows"], columns[n], s["avg"], s["min"], s["max"]) for n, s in seen.items()]
    return spark.createDataFrame(rows, "dataset string, record_count bigint, columns int, avg_rating double, min_rating double, max_rating double")


def quality_tables(spark: SparkSession, sources: dict, seen: dict[str, dict], stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Conformance of the records, and completeness, accuracy, timeliness, uniqueness and violations of the typed tables.

    All but uniqueness come from what was measured while the tables were written; violations are looked up only in
    tables that have some.
    """
    complete, valid, ages, unique, broken = [], [], [], [], []
    for name, (key, _) in DATASET_KEYS.items():
        df, own = stored[name], seen[name]
        rules = quality.rules_for(df.columns)
        complete += quality.completeness_of(own, df.columns, name)
        valid += quality.accuracy_of(own, rules, name)
        ages += [(name, own["rows"], own["max age"], own["mean age"])] if own["rows"] else []
        unique.append(quality.uniqueness(df, [key]).withColumn("dataset", F.lit(name)))
        if own["broken"] or not broken:
            rows = df if own["broken"] else df.limit(0)
            broken.append(quality.violations(rows, rules).select(F.lit(name).alias("dataset"), "source_row_id", "broken_rules"))
    table = spark.createDataFrame
    return {
        "dq_conformance": table(quality.conformance_of(sources, REQUIRED), "source string, field string, rows bigint, present bigint, null_ratio double"),
        "dq_completeness": table(complete, "column string, present bigint, rows bigint, completeness double, dataset string"),
        "dq_accuracy": table(valid, "rule string, valid bigint, rows bigint, accuracy double, dataset string"),
        "dq_timeliness": table(ages, "dataset string, rows bigint, max_age_days bigint, mean_age_days double"),
        "dq_uniqueness": spatial.union_all(unique), "dq_violations": spatial.union_all(broken),
    }


def land_classified(records: DataFrame, path: str, rules=CORRECTED, measures=None) -> tuple[DataFrame, dict] | DataFrame:
    """Write the classified records, one folder per class, so that later steps read one class and few columns. With
    `measures`, they are taken of the rows written and given too."""
    classified = classify(records, rules)
    watched, seen = observed(classified, measures) if measures else (classified, None)
    write_table(watched, path, (CLASS,), replace="all")
    landed = records.sparkSession.read.schema(classified.schema).parquet(path)
    return (landed, seen()) if seen else landed


def run(spark: SparkSession, records: DataFrame, out: str, settings: Settings, rules=CORRECTED, features: bool = True) -> DataFrame:
    """Write every table under `out` and give the statistics.

    The classified records are written first, one folder per class; every later step reads only the
    folders and columns it needs. Measures of quality are taken while tables are written, and
    written as tables of their own.
    """
    classified, sources = land_classified(records, f"{out}/classified", rules, quality.source_measures(CLASS, REQUIRED))
    tables = typed_tables(classified, settings.as_of)
    watched = {n: observed(df, table_measures(n, df, settings.as_of)) for n, df in tables.items()}
    written = write_tables({n: df for n, (df, _) in watched.items()}, out, replace="all")
    stored = {n: spark.read.schema(tables[n].schema).parquet(p) for n, p in written.items()}
    distances = hotel_attraction_distances(
        [stored["booking_hotels"], stored["tripadvisor_hotels"]], stored["geospatial_attractions"], settings.radius_km
    )
    pairs, taken = observed(distances, table_measures("hotel_attraction_distances", distances, settings.as_of))
    write_table(pairs, f"{out}/hotel_attraction_distances", replace="all")
    seen = {n: get() for n, (_, get) in watched.items()} | {"hotel_attraction_distances": taken()}
    write_table(quarantine(classified), f"{out}/quarantine", ())
    stats = statistics(spark, seen, {n: len(df.columns) for n, df in stored.items()} | {"hotel_attraction_distances": len(distances.columns)})
    write_table(stats, f"{out}/summary_statistics", ())
    write_tables(quality_tables(spark, sources, seen, stored), out, partition_by=())
    if features:
        write_tables(model_tables(classified, settings, [*MODEL_TABLES, "dq_consistency"]), out, partition_by=())
    return spark.read.schema(stats.schema).parquet(f"{out}/summary_statistics")

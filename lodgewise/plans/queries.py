"""Queries that run the operators over the driver tables, each with equivalent SQL where there is one.

`QUERIES` maps a name to a function of (spark, folder of the tables); `ORACLES` maps it to the SQL.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgewise.functions import casts, scores, text
from lodgewise.functions.geo import grid_step, has_position, haversine_km
from lodgewise.operators import (
    classify, clean, facilities, market, match, nested, project, quality, ranking, records, reviews, spatial, stats, temporal,
)
from lodgewise.plans import batch, lodging_feed as feed
from lodgewise.schema import FEATURE_COLUMNS, REQUIRED
from lodgewise.session import shared_folder
from lodgewise.sources import feeds, tables
from lodgewise.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2025-06-01"
EVENTS_AS_OF = "2024-02-15"
CITY = {
    "distance_to_city_center": (-7.8, 110.37),
    "distance_to_malioboro": (-7.793, 110.366),
    "distance_to_airport": (-7.9, 110.06),
}
HOLIDAYS = ("2024-01-01", "2024-02-10", "2025-01-01", "2025-05-12", "1998-12-25")
PEAK_MONTHS = (6, 7, 12)
LEXICON = [("the", 1), ("and", 1), ("la", -1), ("der", -1), ("of", 2), ("que", -2), ("bersih", 1), ("dingin", -1), ("kurang", -1)]
RATES = [("IDR", 1.0), ("USD", 16000.0), ("GBP", 20000.0)]


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def read(spark, sf_dir, table):
    return feed.read(spark, sf_dir, table)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, weight int")


def rates(spark):
    return spark.createDataFrame(RATES, "currency string, to_idr double")


def settings(spark) -> batch.Settings:
    import datetime

    return batch.Settings(
        as_of=AS_OF, rates=rates(spark), lexicon=lexicon(spark), landmarks=CITY, peak_months=PEAK_MONTHS,
        holidays=tuple(datetime.date.fromisoformat(h) for h in HOLIDAYS),
    )


# --- SQL fragments ------------------------------------------------------------------------------

def lat(k, shift=0):
    return f"(-8.2e0 + ((CAST({k} AS BIGINT)*7919+{shift}) % 10007)/10007e0*0.7e0)"


def lon(k):
    return f"(110e0 + ((CAST({k} AS BIGINT)*7907) % 10009)/10009e0*0.8e0)"


def hav(a, b, c, d):
    return (
        f"(2e0*6371e0*asin(sqrt(least(1e0, pow(sin((radians({c})-radians({a}))/2e0),2)"
        f"+cos(radians({a}))*cos(radians({c}))*pow(sin((radians({d})-radians({b}))/2e0),2)))))"
    )


SHIFT = feed.ATTRACTION_SHIFT
MIXED_SQL = """mixed AS (
  SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier UNION ALL BY NAME SELECT * FROM part
  UNION ALL BY NAME SELECT * FROM orders UNION ALL BY NAME SELECT * FROM events)"""
BH_SQL = f"""bh AS (
  SELECT c_custkey AS k, c_name AS hotel_name, lower(c_mktsegment) AS accommodation_type, CAST(c_nationkey % 6 AS INTEGER) AS stars,
    150000 + c_custkey*7717 % 850000 AS amount, CASE WHEN c_custkey % 11 <> 0 THEN 5 + (c_custkey % 50)/10e0 END AS rating,
    CAST(c_custkey % 300 AS INTEGER) AS reviews, CASE WHEN c_custkey % 97 <> 0 THEN {lat('c_custkey')} END AS latitude,
    CASE WHEN c_custkey % 97 <> 0 THEN {lon('c_custkey')} END AS longitude,
    CASE WHEN c_custkey % 3 = 0 THEN 'Buffet' END AS breakfast, CAST(DATE '2025-05-01' + CAST(c_custkey % 28 AS INTEGER) AS DATE) AS collected
  FROM customer)"""
TH_SQL = f"""th AS (
  SELECT s_suppkey AS k, s_name AS hotel_name, 'hotel' AS accommodation_type, CAST(s_suppkey % 6 AS INTEGER) AS stars,
    160000 + s_suppkey*6007 % 700000 + 100000 AS amount, CASE WHEN s_suppkey % 13 <> 0 THEN 1 + (s_suppkey % 41)/10e0 END AS rating,
    CAST(s_suppkey % 500 AS INTEGER) AS reviews, {lat('s_suppkey')} AS latitude, {lon('s_suppkey')} AS longitude
  FROM supplier)"""
AT_SQL = f"""att AS (
  SELECT p_partkey AS k, p_name AS attraction_name, CASE WHEN p_type = 'SMALL' THEN 'Ramen restaurant' ELSE p_type END AS category_name,
    p_size/10e0 AS rating, CAST(p_size*10 AS INTEGER) AS reviews_count, {lat('p_partkey', SHIFT)} AS latitude, {lon('p_partkey')} AS longitude
  FROM part)"""


def clean_sql(c):
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+', ' ', 'g'))"


# --- shapes ---------------------------------------------------------------------------------------

def places(spark, sf_dir, table, key, name, platform=None, shift=0):
    kind = [F.lit(platform).alias("platform")] if platform else []
    return read(spark, sf_dir, table).select(
        F.col(key).alias("id"), F.col(name).alias("name"), feed.latitude(key, shift).alias("latitude"),
        feed.longitude(key).alias("longitude"), *kind,
    )


def mixed(spark, sf_dir):
    frames = [read(spark, sf_dir, t) for t in ("customer", "supplier", "part", "orders", "events")]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


MIXED_RULES = (
    classify.Rule("person", ("c_custkey", "c_name"), ("o_orderkey",)),
    classify.Rule("company", ("s_suppkey",)),
    classify.Rule("order", ("coalesce(o_orderkey, o_custkey)", "o_totalprice")),
    classify.Rule("large_part", ("p_partkey", "nullif(p_size > 25, false)")),
    classify.Rule("event", ("event_id", "props")),
)


# --- records, classes, projections ------------------------------------------------------------------

@query("classify_counts", f"""WITH {MIXED_SQL}
SELECT CASE WHEN c_custkey IS NOT NULL AND c_name IS NOT NULL AND o_orderkey IS NULL THEN 'person'
  WHEN s_suppkey IS NOT NULL THEN 'company' WHEN coalesce(o_orderkey, o_custkey) IS NOT NULL AND o_totalprice IS NOT NULL THEN 'order'
  WHEN p_partkey IS NOT NULL AND p_size > 25 THEN 'large_part' WHEN event_id IS NOT NULL AND props IS NOT NULL THEN 'event'
  ELSE 'unknown' END AS data_source_type, count(*) AS records FROM mixed GROUP BY 1""")
def classify_counts(spark, sf_dir):
    return classify.class_counts(classify.classify(mixed(spark, sf_dir), MIXED_RULES))


def _feed_counts(rules):
    return lambda spark, sf_dir: classify.class_counts(classify.classify(feed.lodging_feed(spark, sf_dir), rules))


query("feed_classes_strict", """
SELECT 'booking_hotel' AS data_source_type, (SELECT count(*) FROM customer) AS records
UNION ALL SELECT 'booking_review', (SELECT count(*) FROM events WHERE event_id % 5 <> 0)
UNION ALL SELECT 'tripadvisor_review', (SELECT count(*) FROM conversations WHERE text IS NOT NULL)
UNION ALL SELECT 'geospatial_attraction', (SELECT count(*) FROM part WHERE p_partkey % 4 <> 0)
UNION ALL SELECT 'unknown', (SELECT count(*) FROM events WHERE event_id % 5 = 0) + (SELECT count(*) FROM part WHERE p_partkey % 4 = 0)
  + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM region)""")(_feed_counts(classify.STRICT))
query("feed_classes_corrected", """
SELECT 'booking_hotel' AS data_source_type, (SELECT count(*) FROM customer) AS records
UNION ALL SELECT 'booking_review', (SELECT count(*) FROM events)
UNION ALL SELECT 'tripadvisor_hotel', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'tripadvisor_review', (SELECT count(*) FROM conversations WHERE text IS NOT NULL)
UNION ALL SELECT 'geospatial_attraction', (SELECT count(*) FROM part)
UNION ALL SELECT 'scrape_error', (SELECT count(*) FROM region)""")(_feed_counts(classify.CORRECTED))


@query("catalog_table", """SELECT data_source_type, count(*) AS records, count(*) AS ids, round(avg(rating), 6) AS rating, CAST(coalesce(sum(topics), 0) AS BIGINT) AS topics FROM (
  SELECT 'booking_hotel' AS data_source_type, CASE WHEN c_custkey % 11 <> 0 THEN 5 + (c_custkey % 50) / 10e0 END AS rating, NULL AS topics FROM customer
  UNION ALL SELECT 'booking_review', event_id % 11, NULL FROM events
  UNION ALL SELECT 'tripadvisor_hotel', CASE WHEN s_suppkey % 13 <> 0 THEN 1 + (s_suppkey % 41) / 10e0 END, NULL FROM supplier
  UNION ALL SELECT CASE WHEN text IS NOT NULL THEN 'tripadvisor_review' ELSE 'unknown' END, 1 + (conv_id + turn) % 5, NULL FROM conversations
  UNION ALL SELECT 'geospatial_attraction', NULL, CASE WHEN p_partkey % 4 <> 0 THEN 2 END FROM part
  UNION ALL SELECT 'scrape_error', NULL, NULL FROM region) GROUP BY 1""")
def catalog_table(spark, sf_dir):
    """Records saved as a catalog table of one array column, about a hundred in a row, with the types a crawler finds:
    ratings as choices of number types, free keys as structs. Read back, conformed and classified."""
    rows = feed.lodging_feed(spark, sf_dir).drop("row_id")
    info = F.col("additionalInfo")
    whole = F.col("rating") == F.floor("rating")
    crawled = rows.withColumns({
        "rating": F.struct(F.when(~whole, F.col("rating")).alias("double"), F.when(whole, F.col("rating").cast("int")).alias("int")),
        "additionalInfo": F.when(info.isNotNull(), F.struct(info["Accessibility"].alias("Accessibility"), info["Parking"].alias("Parking"))),
    })
    rounds = -(-rows.count() // 100)
    record = F.struct(*crawled.columns)
    arrays = crawled.select(F.pmod(F.xxhash64(F.to_json(record)), F.lit(rounds)).alias("part"), record.alias("r")).groupBy("part").agg(F.collect_list("r").alias("array"))
    path = run_folder(spark, "crawled")
    name = f"crawled_{path[-32:]}"
    # Row groups of few arrays: a task that reads nested columns holds up to 4096 rows of one group, here about 100 records each.
    arrays.select("array").write.option("path", path).option("parquet.block.size", 8 << 20).saveAsTable(name)
    read_back = classify.classify(feeds.read_catalog_table(spark, name))
    topics = F.sum(F.size(F.map_keys("additionalInfo"))).alias("topics")
    out = read_back.groupBy(classify.CLASS).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("row_id").alias("ids"), F.round(F.avg("rating"), 6).alias("rating"), topics
    )
    return out.withColumn("topics", F.coalesce("topics", F.lit(0)))


@query("quarantine_rows", """
SELECT 'unknown' AS data_source_type, p_partkey AS k FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'unknown', event_id FROM events WHERE event_id % 5 = 0
UNION ALL SELECT 'unknown', s_suppkey FROM supplier
UNION ALL SELECT 'unknown', CAST(r_regionkey AS BIGINT) FROM region""")
def quarantine_rows(spark, sf_dir):
    rows = classify.quarantine(classify.classify(feed.lodging_feed(spark, sf_dir), classify.STRICT))
    key = F.coalesce(F.regexp_extract("placeId", "[0-9]+", 0).try_cast("bigint"), F.col("id").try_cast("bigint"), "reviewsCategoryData.hotelId")
    return rows.select("data_source_type", key.alias("k"))


@query("explode_array", """SELECT vec_id, CAST(p - 1 AS INTEGER) AS position, CAST(embedding[p] AS DOUBLE) AS record
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)""")
def explode_array(spark, sf_dir):
    rows = records.explode_records(read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("array")), expand=False)
    return rows.select("vec_id", F.col("position").cast("int"), F.col("record").cast("double"))


@query("explode_struct_records", """SELECT event_id // 64 AS file, user_id, event_type, "value",
  CAST(row_number() OVER (PARTITION BY event_id // 64 ORDER BY event_id) - 1 AS INTEGER) AS position FROM events""")
def explode_struct_records(spark, sf_dir):
    """Arrays of up to 64 structs, as a catalog table of small files holds them, back to flat records in order."""
    one = F.struct("event_id", "user_id", "event_type", "value")
    held = read(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 64).alias("file")).agg(F.array_sort(F.collect_list(one)).alias("array"))
    rows = records.explode_records(held, "array", "file", expand=False)
    return rows.select("file", "record.user_id", "record.event_type", "record.value", F.col("position").cast("int"))


@query("project_typed", f"""WITH {MIXED_SQL}
SELECT o_orderkey AS order_id, TRY_CAST(floor(o_totalprice) AS INTEGER) AS whole_price, o_totalprice AS price,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus = 'F' AS finished, o_orderpriority AS priority, 'orders' AS platform
FROM mixed WHERE o_orderkey IS NOT NULL""")
def project_typed(spark, sf_dir):
    rows = classify.of_class(classify.classify(mixed(spark, sf_dir), MIXED_RULES), "order")
    spec = {
        "order_id": ("o_orderkey", "bigint"), "whole_price": ("cast(o_totalprice as string)", "int"),
        "price": ("cast(o_totalprice as string)", "double"), "order_date": ("cast(o_orderdate as string)", "date"),
        "finished": ("if(o_orderstatus = 'F', 'true', 'false')", "boolean"), "priority": ("o_orderpriority", "string"),
    }
    return project.project_columns(rows, spec, "orders").withColumn("order_date", F.col("order_date").cast("string"))


def _table(name):
    def run(spark, sf_dir):
        classified = classify.classify(feed.lodging_feed(spark, sf_dir))
        return project.PROJECTIONS[name](classified, AS_OF).drop("source_row_id", "processed_at")

    return run


@query("booking_hotels", f"""WITH {BH_SQL}
SELECT k AS booking_hotel_id, hotel_name, accommodation_type, CAST(NULL AS VARCHAR) AS description, stars,
  'Rp ' || CAST(amount // 1000 AS VARCHAR) || '.' || lpad(CAST(amount % 1000 AS VARCHAR), 3, '0') AS price, CAST(NULL AS VARCHAR) AS currency,
  rating, reviews, latitude, longitude, 'Jl. ' || k AS full_address, CASE WHEN k % 2 = 0 THEN 'Jl. A' END AS street_address,
  CASE WHEN k % 2 = 0 THEN 'Indonesia' END AS country, CASE WHEN k % 2 = 0 THEN 'Jawa' END AS region,
  CASE WHEN k % 2 = 0 THEN CAST(55000 + k % 900 AS VARCHAR) END AS postal_code, breakfast, '15.20' AS check_in_time, '10.40' AS check_out_time,
  CAST(NULL AS VARCHAR) AS booking_url, 2 AS facility_groups, 'booking.com' AS platform FROM bh""")
def booking_hotels(spark, sf_dir):
    return _table("booking_hotels")(spark, sf_dir).withColumn("facility_groups", F.size("facilities")).drop("facilities")


EV_TEXT = """CASE WHEN event_type IN ('purchase','signup') THEN 'Tempat bagus, bersih!' END"""
EV_BAD = """CASE WHEN event_type IN ('error','click') THEN 'AC kurang dingin' END"""


@query("booking_reviews", f"""SELECT CAST(event_id AS VARCHAR) AS review_id, user_id AS booking_hotel_id, CAST(event_id % 11 AS DOUBLE) AS rating,
  CASE WHEN event_id % 5 <> 0 THEN event_type END AS review_title, {EV_TEXT} AS liked_text, {EV_BAD} AS disliked_text,
  CASE event_type WHEN 'view' THEN 'Solo traveler' WHEN 'click' THEN 'Couple' WHEN 'purchase' THEN 'Family' WHEN 'signup' THEN 'Group' END AS traveler_type,
  CAST(NULL AS VARCHAR) AS user_location, CAST(NULL AS VARCHAR) AS user_name, CAST(event_id % 5 + 1 AS INTEGER) AS number_of_nights,
  CAST(NULL AS VARCHAR) AS room_info, CAST(event_id % 3 AS INTEGER) AS helpful_votes, 'id' AS review_language,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS check_in_date, CAST(CAST(CAST(ts AS DATE) + CAST(event_id % 5 + 1 AS INTEGER) AS DATE) AS VARCHAR) AS check_out_date,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS review_date, 6 AS categories, 'booking.com' AS platform FROM events""")
def booking_reviews(spark, sf_dir):
    rows = _table("booking_reviews")(spark, sf_dir).withColumn("categories", F.size("category_ratings")).drop("category_ratings")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("check_in_date", "check_out_date", "review_date")})


@query("tripadvisor_hotels", f"""WITH {TH_SQL}
SELECT CAST(k AS VARCHAR) AS tripadvisor_location_id, hotel_name, accommodation_type, CAST(NULL AS VARCHAR) AS description, rating,
  reviews AS reviews_count, CAST(stars AS VARCHAR) || '.0' AS hotel_class, latitude, longitude, 'Jl. ' || k AS full_address,
  'Jl. ' || k AS street_address, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, 'Indonesia' AS country, '55244' AS postal_code,
  CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS website, CAST(k + 1 AS INTEGER) AS ranking_position,
  410 AS ranking_denominator, '$$' AS price_level,
  'Rp ' || CAST((amount - 100000) // 1000 AS VARCHAR) || '.' || lpad(CAST(amount % 1000 AS VARCHAR), 3, '0') || ' - Rp '
    || CAST((amount + 100000) // 1000 AS VARCHAR) || '.' || lpad(CAST(amount % 1000 AS VARCHAR), 3, '0') AS price_range,
  CAST(NULL AS INTEGER) AS photo_count,
  concat_ws('|', CASE WHEN k % 3 = 0 THEN 'AC' END, CASE WHEN k % 2 = 0 THEN 'Wi-Fi Gratis' END, CASE WHEN k % 4 = 1 THEN 'Kolam Renang' END, 'Parkir gratis') AS amenities,
  'tripadvisor.com' AS platform FROM th""")
def tripadvisor_hotels(spark, sf_dir):
    return _table("tripadvisor_hotels")(spark, sf_dir).withColumn("amenities", F.array_join("amenities", "|"))


@query("tripadvisor_reviews", """SELECT conv_id || '-' || turn AS review_id, CAST(conv_id AS VARCHAR) AS tripadvisor_location_id,
  CAST(1 + (conv_id + turn) % 5 AS DOUBLE) AS rating, role AS review_title, text AS review_text, 'id' AS review_language,
  CASE WHEN turn % 2 = 0 THEN 'FAMILY' ELSE 'BUSINESS' END AS trip_type, 'user ' || conv_id AS user_name, CAST(NULL AS VARCHAR) AS user_location,
  CAST(turn + 1 AS INTEGER) AS user_total_contributions, '2024-' || lpad(CAST(1 + conv_id % 12 AS VARCHAR), 2, '0') || '-15' AS published_date,
  '2024-01' AS travel_date, CAST(turn % 2 AS INTEGER) AS photos_count, 'tripadvisor.com' AS platform FROM conversations""")
def tripadvisor_reviews(spark, sf_dir):
    return _table("tripadvisor_reviews")(spark, sf_dir).withColumn("published_date", F.col("published_date").cast("string"))


@query("geospatial_attractions", f"""WITH {AT_SQL}
SELECT 'p' || k AS place_id, attraction_name, category_name, rating, reviews_count, CAST(NULL AS INTEGER) AS images_count, latitude, longitude,
  CAST(NULL AS VARCHAR) AS full_address, CAST(NULL AS VARCHAR) AS neighborhood, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
  CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS phone_unformatted,
  k % 50 = 0 AS permanently_closed, FALSE AS temporarily_closed, CASE WHEN k % 4 <> 0 THEN 2 END AS info_groups, 2 AS opening_days,
  2 AS category_count, 'google_maps' AS platform FROM att""")
def geospatial_attractions(spark, sf_dir):
    rows = _table("geospatial_attractions")(spark, sf_dir)
    return rows.withColumns({
        "info_groups": F.size("additionalInfo"), "opening_days": F.size("opening_hours"), "category_count": F.size("categories"),
    }).drop("additionalInfo", "opening_hours", "categories")


@query("json_fields", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing,
  coalesce(len(json_keys(props)), 0)::INTEGER AS n_keys FROM events""")
def json_fields(spark, sf_dir):
    rows = nested.json_fields(read(spark, sf_dir, "events"), "props", {"k": "k", "missing": "none"}, "k int, none string")
    return rows.select("event_id", "k", "missing", casts.size_or_zero(F.json_object_keys("props")).alias("n_keys"))


@query("coalesce_coords", f"""SELECT * FROM (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN {lat('c_custkey')} WHEN c_custkey % 7 <> 0 THEN {lat('c_custkey')} + 1 END AS latitude,
    {lon('c_custkey')} AS longitude, 'a' AS platform FROM customer
  UNION ALL SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN {lat('s_suppkey')} WHEN s_suppkey % 7 <> 0 THEN {lat('s_suppkey')} + 1 END, {lon('s_suppkey')}, 'b' FROM supplier)
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def coalesce_coords(spark, sf_dir):
    both = spatial.union_all([
        places(spark, sf_dir, "customer", "c_custkey", "c_name", "a"), places(spark, sf_dir, "supplier", "s_suppkey", "s_name", "b"),
    ])
    own = F.when(F.col("id") % 5 == 0, F.col("latitude").cast("string"))
    nested_one = F.struct(F.when(F.col("id") % 7 != 0, (F.col("latitude") + 1).cast("string")).alias("lat"))
    rows = both.withColumns({"top": own, "location": nested_one})
    rows = rows.withColumn("latitude", F.coalesce(casts.to_double("top"), casts.to_double("location.lat")))
    return rows.filter(has_position(F.col("latitude"), F.col("longitude"))).select("id", "latitude", "longitude", "platform")


# --- union, distance, radius ------------------------------------------------------------------------

def two_platforms(spark, sf_dir):
    columns = {"hotel_name": "name", "latitude": "latitude", "longitude": "longitude", "platform": "platform"}
    return spatial.union_all([
        spatial.standard_points(places(spark, sf_dir, "customer", "c_custkey", "c_name", "booking.com"), columns),
        spatial.standard_points(places(spark, sf_dir, "supplier", "s_suppkey", "s_name", "tripadvisor.com"), columns),
    ])


TWO_SQL = f"""two AS (SELECT c_name AS hotel_name, {lat('c_custkey')} AS latitude, {lon('c_custkey')} AS longitude, 'booking.com' AS platform FROM customer
  UNION ALL SELECT s_name, {lat('s_suppkey')}, {lon('s_suppkey')}, 'tripadvisor.com' FROM supplier)"""


@query("union_platforms", f"WITH {TWO_SQL} SELECT * FROM two")
def union_platforms(spark, sf_dir):
    return two_platforms(spark, sf_dir)


@query("haversine", f"""SELECT c_custkey AS id, round({hav(lat('c_custkey'), lon('c_custkey'), lat('c_nationkey'), lon('c_nationkey'))}, 6) AS km FROM customer""")
def haversine(spark, sf_dir):
    k, n = ("c_custkey",), ("c_nationkey",)
    km = haversine_km(feed.latitude(*k), feed.longitude(*k), feed.latitude(*n), feed.longitude(*n))
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.round(km, 6).alias("km"))


RADIUS_SQL = """WITH {two}, spots AS (SELECT p_name AS attraction_name, {la} AS attr_latitude, {lo} AS attr_longitude, p_type AS category_name FROM part)
SELECT * FROM (SELECT hotel_name, latitude, longitude, platform, attraction_name, attr_latitude, attr_longitude, category_name,
  round({d}, 6) AS distance_km, {d} AS exact FROM two, spots) WHERE exact <= {r}"""


def radius_sql(r):
    sql = RADIUS_SQL.format(two=TWO_SQL, la=lat("p_partkey"), lo=lon("p_partkey"), d=hav("latitude", "longitude", "attr_latitude", "attr_longitude"), r=r)
    return sql.replace("SELECT * FROM (SELECT hotel_name", "SELECT * EXCLUDE (exact) FROM (SELECT hotel_name")


@query("radius_pairs", radius_sql("2e0"))
def radius_pairs(spark, sf_dir, radius_km=2.0):
    spots = read(spark, sf_dir, "part").select(
        F.col("p_name").alias("attraction_name"), feed.latitude("p_partkey").alias("attr_latitude"),
        feed.longitude("p_partkey").alias("attr_longitude"), F.col("p_type").alias("category_name"),
    )
    pairs = spatial.radius_join(two_platforms(spark, sf_dir), spots, radius_km)
    return pairs.withColumn("distance_km", F.round("distance_km", 6))


@query("radius_pairs_10km", f"""WITH {TWO_SQL}, spots AS (SELECT p_type AS category_name, {lat('p_partkey')} AS b, {lon('p_partkey')} AS c FROM part)
SELECT platform, category_name, count(*) AS pairs, round(avg(d), 6) AS mean_km FROM (
  SELECT platform, category_name, {hav('latitude', 'longitude', 'b', 'c')} AS d FROM two, spots) WHERE d <= 10 GROUP BY 1, 2""")
def radius_pairs_10km(spark, sf_dir):
    spots = read(spark, sf_dir, "part").select(
        F.col("p_type").alias("category_name"), feed.latitude("p_partkey").alias("attr_latitude"),
        feed.longitude("p_partkey").alias("attr_longitude"),
    )
    found = spatial.radius_join(two_platforms(spark, sf_dir), spots, 10.0, totals=(("platform",), ("category_name",)))
    return rounded(found.select("platform", "category_name", "pairs", (F.col("distance_km") / F.col("pairs")).alias("mean_km")))


@query("hotel_attraction_distances", f"""WITH {BH_SQL}, {TH_SQL}, {AT_SQL},
h AS (SELECT hotel_name, latitude, longitude, 'booking.com' AS platform FROM bh WHERE latitude IS NOT NULL
  UNION ALL SELECT hotel_name, latitude, longitude, 'tripadvisor.com' FROM th),
p AS (SELECT h.*, attraction_name, att.latitude AS attr_latitude, att.longitude AS attr_longitude, category_name,
  {hav('h.latitude', 'h.longitude', 'att.latitude', 'att.longitude')} AS d FROM h, att)
SELECT * EXCLUDE (d), round(d, 6) AS distance_km FROM p WHERE d <= 10e0""")
def hotel_attraction_distances(spark, sf_dir):
    typed = batch.typed_tables(classify.classify(feed.lodging_feed(spark, sf_dir)), AS_OF)
    hotels = [typed["booking_hotels"], typed["tripadvisor_hotels"]]
    pairs = batch.hotel_attraction_distances(hotels, typed["geospatial_attractions"])
    return pairs.withColumn("distance_km", F.round("distance_km", 6))


@query("batch_run", f"""WITH {BH_SQL}, {TH_SQL}, {AT_SQL},
h AS (SELECT latitude, longitude FROM bh WHERE latitude IS NOT NULL UNION ALL SELECT latitude, longitude FROM th),
d AS (SELECT count(*) AS n FROM h, att WHERE {hav('h.latitude', 'h.longitude', 'att.latitude', 'att.longitude')} <= 10e0)
SELECT 'booking_hotels' AS dataset, count(*) AS record_count, round(avg(rating), 6) AS avg_rating FROM bh
UNION ALL SELECT 'booking_reviews', count(*), round(avg(event_id % 11), 6) FROM events
UNION ALL SELECT 'tripadvisor_hotels', count(*), round(avg(rating), 6) FROM th
UNION ALL SELECT 'tripadvisor_reviews', count(*), round(avg(1 + (conv_id + turn) % 5), 6) FROM conversations WHERE text IS NOT NULL
UNION ALL SELECT 'geospatial_attractions', count(*), round(avg(p_size / 10e0), 6) FROM part
UNION ALL SELECT 'hotel_attraction_distances', n, NULL FROM d""")
def batch_run(spark, sf_dir):
    """The whole job over the feed: every table is written, and the statistics are read from the written ones."""
    stats = batch.run(spark, feed.lodging_feed(spark, sf_dir), run_folder(spark, "batch"), settings(spark))
    return rounded(stats.select("dataset", "record_count", "avg_rating"))


def spots_of(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        feed.latitude("p_partkey", SHIFT).alias("latitude"), feed.longitude("p_partkey").alias("longitude"),
        F.col("p_type").alias("category_name"), F.col("p_name").alias("attraction_name"),
    )


POINTS_SQL = f"pts AS (SELECT c_custkey AS id, {lat('c_custkey')} AS la, {lon('c_custkey')} AS lo FROM customer)"
SPOTS_SQL = f"spots AS (SELECT {lat('p_partkey', SHIFT)} AS b, {lon('p_partkey')} AS c, p_type AS category_name FROM part)"
DIST_SQL = hav("la", "lo", "b", "c")


@query("attraction_density", f"""WITH {POINTS_SQL}, {SPOTS_SQL}, d AS (SELECT id, {DIST_SQL} AS d FROM pts, spots)
SELECT id, count(*) FILTER (d <= 1e0) AS density_1km, count(*) FILTER (d <= 2e0) AS density_2km, count(*) FILTER (d <= 5e0) AS density_5km
FROM d GROUP BY id""")
def attraction_density(spark, sf_dir, crowd=5_000):
    points = places(spark, sf_dir, "customer", "c_custkey", "c_name")
    rings = {f"density_{r}km": float(r) for r in (1, 2, 5)}
    return spatial.count_within(points, spots_of(spark, sf_dir), rings, crowd=crowd).select("id", *rings)


@query("attraction_density_by_tree", ORACLES["attraction_density"])
def attraction_density_by_tree(spark, sf_dir):
    """The same counts by the way taken where targets crowd."""
    return attraction_density(spark, sf_dir, crowd=0)


@query("restaurant_density", f"""WITH {POINTS_SQL}, {SPOTS_SQL}
SELECT id, (SELECT count(*) FROM spots WHERE lower(category_name) LIKE '%econ%' AND {DIST_SQL} <= 1.5e0) AS density FROM pts""")
def restaurant_density(spark, sf_dir):
    wanted = spots_of(spark, sf_dir).filter(F.lower("category_name").contains("econ"))
    points = places(spark, sf_dir, "customer", "c_custkey", "c_name")
    return spatial.count_within(points, wanted, {"density": 1.5}).select("id", "density")


@query("competitors", f"""WITH {POINTS_SQL}, o AS (SELECT la AS b, lo AS c FROM pts)
SELECT id, count(*) FILTER ({DIST_SQL} <= 3e0) - 1 AS competitors FROM pts, o GROUP BY id""")
def competitors(spark, sf_dir):
    points = places(spark, sf_dir, "customer", "c_custkey", "c_name")
    return spatial.count_within(points, points, {"competitors": 3.0}, minus=1).select("id", "competitors")


@query("nearest_attraction", f"""WITH {POINTS_SQL}, {SPOTS_SQL} SELECT id, round(min({DIST_SQL}), 6) AS nearest_km FROM pts, spots GROUP BY id""")
def nearest_attraction(spark, sf_dir):
    points = places(spark, sf_dir, "customer", "c_custkey", "c_name")
    return rounded(spatial.nearest(points, spots_of(spark, sf_dir)).select("id", "nearest_km"))


@query("landmarks", f"""WITH {POINTS_SQL} SELECT id, round({hav('la', 'lo', '(-7.8e0)', '110.37e0')}, 6) AS distance_to_city_center,
  round({hav('la', 'lo', '(-7.793e0)', '110.366e0')}, 6) AS distance_to_malioboro, round({hav('la', 'lo', '(-7.9e0)', '110.06e0')}, 6) AS distance_to_airport FROM pts""")
def landmarks(spark, sf_dir):
    points = places(spark, sf_dir, "customer", "c_custkey", "c_name").drop("name")
    return rounded(spatial.landmark_distances(points, CITY).drop("latitude", "longitude"))


# --- statistics -------------------------------------------------------------------------------------

@query("class_counts", "SELECT event_type, count(*) AS records FROM events GROUP BY 1")
def class_counts(spark, sf_dir):
    return classify.class_counts(read(spark, sf_dir, "events"), "event_type")


@query("rating_stats", """SELECT 'customer' AS dataset, count(*) AS record_count, 6 AS columns, round(avg(c_acctbal), 4) AS avg_rating, min(c_acctbal) AS min_rating, max(c_acctbal) AS max_rating FROM customer
UNION ALL SELECT 'part', count(*), 7, round(avg(p_size), 4), min(p_size), max(p_size) FROM part
UNION ALL SELECT 'events', count(*), 7, round(avg("value"), 4), min("value"), max("value") FROM events
UNION ALL SELECT 'region', count(*), 2, NULL, NULL, NULL FROM region
UNION ALL SELECT 'none', 0, 3, NULL, NULL, NULL""")
def rating_stats(spark, sf_dir):
    frames = {
        "customer": read(spark, sf_dir, "customer").withColumn("rating", F.col("c_acctbal")),
        "part": read(spark, sf_dir, "part").withColumn("rating", F.col("p_size")),
        "events": read(spark, sf_dir, "events").withColumn("rating", F.col("value")),
        "region": read(spark, sf_dir, "region"),
        "none": read(spark, sf_dir, "region").filter("r_regionkey < 0").withColumn("rating", F.lit(1.0)),
    }
    return rounded(stats.dataset_stats(frames), 4)


@query("grouped_rollup", """SELECT p_type, p_brand, CAST(grouping(p_type)*2 + grouping(p_brand) AS INTEGER) AS level, count(*) AS places,
  round(avg(p_retailprice), 4) AS avg_price, round(avg(p_size), 4) AS avg_rating FROM part GROUP BY ROLLUP (p_type, p_brand)""")
def grouped_rollup(spark, sf_dir):
    return rounded(market.grouped_summary(read(spark, sf_dir, "part"), ["p_type", "p_brand"], "p_retailprice", "p_size"), 4)


@query("grouped_counts", """SELECT c_nationkey, c_mktsegment, count(*) AS places, round(avg(c_acctbal), 4) AS avg_price, round(avg(c_custkey), 4) AS avg_rating
FROM customer GROUP BY 1, 2""")
def grouped_counts(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    return rounded(market.grouped_summary(rows, ["c_nationkey", "c_mktsegment"], "c_acctbal", "c_custkey", rollup=False), 4)


# --- sources, sinks, catalog ------------------------------------------------------------------------

def run_folder(spark, name):
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("read_incremental", """SELECT event_type, count(*) AS n, round(sum("value"), 2) AS total FROM events GROUP BY 1""")
def read_incremental(spark, sf_dir):
    """Two deliveries of JSON files, each taken up once by a run with a bookmark; a third run finds nothing."""
    base = run_folder(spark, "incremental")
    rows = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    schema = rows.schema
    for part in ("event_type IN ('view', 'click')", "NOT event_type IN ('view', 'click')"):
        rows.filter(part).write.mode("append").json(f"{base}/in")
        for _ in range(2):
            stream = incremental.stream_feed(spark, f"{base}/in", schema, multi_line=False)
            incremental.run_available(stream, f"{base}/out", f"{base}/bookmark", ["event_type"])
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("partitioned_write", """SELECT o_orderpriority AS platform, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderkey) AS last FROM orders GROUP BY 1""")
def partitioned_write(spark, sf_dir):
    """Write twice by platform; the second run replaces what the first wrote."""
    path = run_folder(spark, "orders")
    rows = read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "platform")
    for _ in range(2):
        tables.write_table(rows, path)
    out = spark.read.parquet(path)
    return out.groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderkey").alias("last")
    )


# Columns of the driver tables.
PROFILED = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "events": "event_id ts user_id event_type value props",
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
    "documents": "doc_id text lang source n_chars",
}


@query("column_profile", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", (SELECT count(*) FROM {t}) AS "rows", (SELECT count("{c}") FROM {t}) AS present"""
    for t, columns in PROFILED.items() for c in columns.split()
))
def column_profile(spark, sf_dir):
    return tables.column_profile({t: read(spark, sf_dir, t) for t in PROFILED}, distinct=False).drop("type", "comment")


@query("schema_union", """SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part)
  + (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS "rows", 27 AS columns""")
def schema_union(spark, sf_dir):
    """Tables of different columns as one: a column is null where its table lacks it."""
    rows = mixed(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(rows.columns)))


@query("catalog_report", ORACLES["column_profile"])
def catalog_report(spark, sf_dir):
    """What the written report says of every table; its file sizes and estimates are beyond SQL."""
    report = tables.write_catalog_report(spark, {n: f"{sf_dir}/{n}.parquet" for n in PROFILED}, run_folder(spark, "report"))
    return report.select("table", "column", "rows", "present")


def conformance_sql():
    source = {"booking_hotel": "customer", "booking_review": "events", "tripadvisor_hotel": "supplier",
              "tripadvisor_review": "conversations", "geospatial_attraction": "part"}
    missing = {("booking_hotel", "location"): "c_custkey % 97 = 0", ("booking_review", "reviewTitle"): "event_id % 5 = 0",
               ("booking_review", "travelerType"): "event_type NOT IN ('view','click','purchase','signup')",
               ("tripadvisor_hotel", "rating"): "s_suppkey % 13 = 0"}
    one = """SELECT '{s}' AS source, '{f}' AS field, count(*) AS "rows", count(*) FILTER (NOT ({m})) AS present,
      round(count(*) FILTER ({m}) / CAST(count(*) AS DOUBLE), 6) AS null_ratio FROM {t}"""
    return " UNION ALL ".join(one.format(s=s, f=f, t=source[s], m=missing.get((s, f), "FALSE")) for s, fs in REQUIRED.items() for f in fs)


@query("conformance", conformance_sql())
def conformance(spark, sf_dir):
    return rounded(quality.conformance(classify.classify(feed.lodging_feed(spark, sf_dir)), classify.CLASS, REQUIRED))


# --- cleaning ---------------------------------------------------------------------------------------

@query("latest_per_key", """SELECT user_id, event_id, event_type, "value" FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return clean.latest_per_key(rows, ["user_id", "event_type"], "day", "event_id").select("user_id", "event_id", "event_type", "value")


@query("missing_policy", f"""WITH {MIXED_SQL} SELECT event_id, user_id, "value", o_totalprice FROM mixed WHERE event_id IS NOT NULL AND user_id IS NOT NULL""")
def missing_policy(spark, sf_dir):
    return clean.drop_missing(mixed(spark, sf_dir), ["event_id", "user_id"]).select("event_id", "user_id", "value", "o_totalprice")


@query("price_idr", """SELECT id, CAST(low AS DOUBLE) AS price_min, CAST(high AS DOUBLE) AS price_max, (low + high) / 2e0 AS price_mid, currency AS price_currency,
  round((low + high) / 2e0 * CASE currency WHEN 'IDR' THEN 1e0 WHEN 'USD' THEN 16000e0 WHEN 'GBP' THEN 20000e0 END, 2) AS price_idr FROM (
  SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS low, CAST(floor(o_totalprice) AS BIGINT) + 200000 + o_custkey AS high,
    CASE o_orderkey % 8 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'USD' WHEN 3 THEN 'GBP' WHEN 4 THEN 'SGD' WHEN 5 THEN 'SGD' WHEN 6 THEN NULL ELSE 'IDR' END AS currency FROM orders)""")
def price_idr(spark, sf_dir):
    low = F.floor("o_totalprice").cast("bigint")
    symbols = F.array(*[F.lit(s) for s in ("€", "US$", "$ ", "£ ", "S$", "SGD ", "₿ ", "Rp ")])
    symbol = F.get(symbols, F.col("o_orderkey") % 8)

    def amount(a):
        return F.concat(symbol, F.substring(feed.rupiah(a), 4, 20))

    rows = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(amount(low), F.lit(" - "), amount(low + 200000 + F.col("o_custkey"))).alias("text")
    )
    out = clean.to_idr(clean.price_columns(rows, "text"), "price_mid", "price_currency", rates(spark).unionByName(rates(spark)))
    out = out.withColumns({c: F.col(c).cast("double") for c in ("price_min", "price_max", "price_mid")})
    return rounded(out.drop("text"), 2)


@query("outliers", """WITH q AS (SELECT o_orderpriority AS p, quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders JOIN q ON p = o_orderpriority
WHERE o_totalprice BETWEEN a - 0.3e0 * (b - a) AND b + 0.3e0 * (b - a)""")
def outliers(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return clean.remove_outliers(rows, "o_totalprice", ["o_orderpriority"], 0.3)


@query("quantiles", """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1, 2""")
def quantiles(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    wanted = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    return rounded(ranking.quantiles(rows, "l_extendedprice", wanted, ["l_returnflag", "l_linestatus"]))


@query("clean_text", f"SELECT doc_id, length(c) AS n, md5(c) AS digest FROM (SELECT doc_id, {clean_sql('text')} AS c FROM documents)")
def clean_text(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", text.clean_text("text").alias("c"))
    return rows.select("doc_id", F.length("c").cast("bigint").alias("n"), F.md5("c").alias("digest"))


@query("outliers_by_ranges", ORACLES["outliers"])
def outliers_by_ranges(spark, sf_dir):
    """The same limits, put together from the quantiles."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    q = ranking.quantiles(rows, "o_totalprice", {"q1": 0.25, "q3": 0.75}, ["o_orderpriority"])
    reach = (F.col("q3") - F.col("q1")) * F.lit(0.3)
    kept = rows.join(q, "o_orderpriority").filter(F.col("o_totalprice").between(F.col("q1") - reach, F.col("q3") + reach))
    return kept.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("name_keys", f"""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split({clean_sql('p_name')}, ' '), lambda w: w NOT IN ('red', 'ring')))), ' ') AS name_key FROM part""")
def name_keys(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.name_key("p_name", ("red", "ring")).alias("name_key"))


@query("rating_scale", """SELECT event_id, round("value" * CASE event_type WHEN 'view' THEN 1e0 WHEN 'click' THEN 2e0 WHEN 'error' THEN 2e0 END, 6) AS rating10 FROM events""")
def rating_scale(spark, sf_dir):
    factors = {"view": 1.0, "click": 2.0, "error": 2.0}
    return rounded(read(spark, sf_dir, "events").select("event_id", scores.rating10("value", "event_type", factors).alias("rating10")))


# --- nested -----------------------------------------------------------------------------------------

@query("flatten_values", "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings")
def flatten_values(spark, sf_dir):
    rows = nested.explode_values(read(spark, sf_dir, "embeddings"), ["vec_id"], "embedding")
    return rows.select("vec_id", F.col("value").cast("double"))


@query("flatten_facilities", """SELECT k AS booking_hotel_id, 'Umum' AS category, CAST(NULL AS VARCHAR) AS overview, f AS facility, 0 AS extras FROM (
  SELECT c_custkey AS k, unnest(CASE WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR c_custkey % 4 = 0 THEN
    list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'AC' END, CASE WHEN c_custkey % 5 = 0 THEN 'Layanan kamar' END, CASE WHEN c_custkey % 7 = 0 THEN 'Restoran' END,
      CASE WHEN c_custkey % 4 = 0 THEN 'Resepsionis 24 Jam' END], lambda x: x IS NOT NULL) ELSE [NULL] END) AS f FROM customer) WHERE f IS NOT NULL
UNION ALL SELECT c_custkey, 'Umum', NULL, NULL, NULL FROM customer WHERE NOT (c_custkey % 2 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR c_custkey % 4 = 0)
UNION ALL SELECT c_custkey, 'Internet', CASE WHEN c_custkey % 3 <> 0 THEN 'Wi-Fi tersedia' END, NULL, NULL FROM customer""")
def flatten_facilities(spark, sf_dir):
    rows = nested.facilities_long(project.booking_hotels(classify.classify(feed.lodging_feed(spark, sf_dir))), ["booking_hotel_id"])
    return rows.withColumn("extras", F.size("extra")).drop("extra")


@query("flatten_info", """SELECT 'p' || p_partkey AS place_id, 'Accessibility' AS "group", 'Wheelchair accessible seating' AS label, p_partkey % 2 = 0 AS flag FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT 'p' || p_partkey, 'Accessibility', 'Wheelchair accessible entrance', p_partkey % 3 = 0 FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT 'p' || p_partkey, 'Parking', 'Free parking lot', TRUE FROM part WHERE p_partkey % 4 <> 0""")
def flatten_info(spark, sf_dir):
    return nested.info_flags_long(project.geospatial_attractions(classify.classify(feed.lodging_feed(spark, sf_dir))), ["place_id"])


SCORE_SQL = " UNION ALL ".join(
    f"SELECT event_id, user_id, '{c}' AS code, ((event_id * {i + 3}) % 41) / 4e0 AS score FROM events" for i, c in enumerate(feed.CODES)
)


@query("flatten_scores", f"SELECT CAST(event_id AS VARCHAR) AS review_id, code, score FROM ({SCORE_SQL})")
def flatten_scores(spark, sf_dir):
    return nested.rating_scores_long(project.booking_reviews(classify.classify(feed.lodging_feed(spark, sf_dir))), ["review_id"])


@query("flatten_hours", """SELECT 'p' || p_partkey AS place_id, 'Monday' AS "day", '9 AM to 5 PM' AS hours FROM part
UNION ALL SELECT 'p' || p_partkey, 'Tuesday', 'Closed' FROM part""")
def flatten_hours(spark, sf_dir):
    return nested.opening_hours_long(project.geospatial_attractions(classify.classify(feed.lodging_feed(spark, sf_dir))), ["place_id"])


@query("flatten_tokens", f"""SELECT doc_id, w AS word, count(*) AS n FROM (SELECT doc_id, unnest(string_split({clean_sql('text')}, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 1, 2""")
def flatten_tokens(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").withColumn("words", text.tokens("text"))
    return nested.explode_values(rows, ["doc_id"], "words", "word").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query("accessibility_index", """SELECT 'p' || p_partkey AS place_id, CASE WHEN p_partkey % 4 <> 0 THEN (CAST(p_partkey % 2 = 0 AS INTEGER) + CAST(p_partkey % 3 = 0 AS INTEGER)) / 2e0 END AS accessibility FROM part""")
def accessibility_index(spark, sf_dir):
    rows = project.geospatial_attractions(classify.classify(feed.lodging_feed(spark, sf_dir)))
    return rows.select("place_id", facilities.accessibility_index().alias("accessibility"))


# --- matching -----------------------------------------------------------------------------------------

def match_sql(radius, floor):
    d = hav("a.la", "a.lo", "b.la", "b.lo")
    s = "1e0 - levenshtein(a.n, b.n) / CAST(greatest(length(a.n), length(b.n)) AS DOUBLE)"
    return f"""a AS (SELECT c_custkey AS id, {clean_sql('c_name')} AS n, {lat('c_custkey')} AS la, {lon('c_custkey')} AS lo FROM customer),
b AS (SELECT s_suppkey AS id, {clean_sql('s_name')} AS n, {lat('s_suppkey', 31)} AS la, {lon('s_suppkey')} AS lo FROM supplier),
pairs AS (SELECT a.id AS a_id, b.id AS b_id, {s} AS similarity, {d} AS distance_km FROM a, b),
good AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY similarity DESC, distance_km, b_id) AS ra,
  row_number() OVER (PARTITION BY b_id ORDER BY similarity DESC, distance_km, a_id) AS rb FROM pairs WHERE distance_km < {radius} AND similarity >= {floor}),
m AS (SELECT a_id, b_id, similarity, distance_km FROM good WHERE ra = 1 AND rb = 1)"""


def two_sides(spark, sf_dir):
    a = places(spark, sf_dir, "customer", "c_custkey", "c_name").withColumn("name", text.clean_text("name"))
    b = places(spark, sf_dir, "supplier", "s_suppkey", "s_name", shift=31).withColumn("name", text.clean_text("name"))
    return a, b


@query("match_entities", f"""WITH {match_sql('5e0', '0.5e0')} SELECT a_id, b_id, round(similarity, 6) AS similarity, round(distance_km, 6) AS distance_km FROM m""")
def match_entities(spark, sf_dir):
    return rounded(match.match_entities(*two_sides(spark, sf_dir), 5.0, 0.5))


def with_prices(spark, sf_dir):
    a, b = two_sides(spark, sf_dir)
    links = match.match_entities(a, b, 5.0, 0.5)
    prices_a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("price"), (F.col("c_custkey") % 10).cast("double").alias("rating"))
    prices_b = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("price"), (F.col("s_suppkey") % 7).cast("double").alias("rating"))
    return a.join(prices_a, "id"), b.join(prices_b, "id"), links


@query("merge_entities", f"""WITH {match_sql('5e0', '0.5e0')}
SELECT a.id AS id, a.n AS name, 'merged' AS platform_source, c_acctbal AS a_price, s_acctbal AS b_price FROM m JOIN a ON a.id = a_id JOIN customer ON c_custkey = a_id JOIN supplier ON s_suppkey = b_id
UNION ALL SELECT a.id, a.n, 'booking', c_acctbal, NULL FROM a JOIN customer ON c_custkey = id WHERE id NOT IN (SELECT a_id FROM m)
UNION ALL SELECT b.id, b.n, 'tripadvisor', NULL, s_acctbal FROM b JOIN supplier ON s_suppkey = id WHERE id NOT IN (SELECT b_id FROM m)""")
def merge_entities(spark, sf_dir):
    merged = match.merge_matched(*with_prices(spark, sf_dir), keep_both=["price"])
    return merged.select("id", "name", "platform_source", "a_price", "b_price")


@query("price_compare", f"""WITH {match_sql('5e0', '0.5e0')}
SELECT a_id AS id, round(c_acctbal - s_acctbal, 6) AS price_difference, round(CASE WHEN s_acctbal <> 0 THEN c_acctbal / s_acctbal END, 6) AS price_ratio,
  round((c_acctbal - s_acctbal) * (c_acctbal - s_acctbal) / 4, 4) AS price_variance,
  round(1 - abs(a_id % 10 - b_id % 7) / 10e0, 6) AS consistency
FROM m JOIN customer ON c_custkey = a_id JOIN supplier ON s_suppkey = b_id""")
def price_compare(spark, sf_dir):
    merged = match.merge_matched(*with_prices(spark, sf_dir), keep_both=["price", "rating"]).filter("platform_source = 'merged'")
    merged = match.price_comparison(merged, "a_price", "b_price")
    return merged.select(
        "id", F.round("price_difference", 6).alias("price_difference"), F.round("price_ratio", 6).alias("price_ratio"),
        F.round(market.row_variance(["a_price", "b_price"]), 4).alias("price_variance"),
        F.round(scores.review_consistency("a_rating", "b_rating"), 6).alias("consistency"),
    )


@query("dq_consistency", f"""WITH {match_sql('5e0', '0.5e0')}, t AS (SELECT a_id, b_id, abs(a_id % 10 - b_id % 7) > 2 AS r, similarity < 0.62e0 AS n, distance_km > 2e0 AS p FROM m)
SELECT a_id, b_id, concat_ws(',', CASE WHEN r THEN 'rating' END, CASE WHEN n THEN 'name' END, CASE WHEN p THEN 'position' END) AS disagreements FROM t WHERE r OR n OR p""")
def dq_consistency(spark, sf_dir):
    a, b, links = with_prices(spark, sf_dir)
    rows = links.join(a.select(F.col("id").alias("a_id"), F.col("rating").alias("a_rating")), "a_id")
    rows = rows.join(b.select(F.col("id").alias("b_id"), F.col("rating").alias("b_rating")), "b_id")
    out = quality_of_matches(rows)
    return out.select("a_id", "b_id", F.array_join("disagreements", ",").alias("disagreements"))


def quality_of_matches(rows):
    return match.inconsistencies(rows, rating_gap=2.0, distance_gap_km=2.0, name_floor=0.62)


@query("price_variance", """SELECT o_custkey, round(var_pop(o_totalprice) / 1e6, 3) AS price_variance_platforms FROM orders GROUP BY 1""")
def price_variance(spark, sf_dir):
    out = match.price_variance(read(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")
    return out.withColumn("price_variance_platforms", F.round(F.col("price_variance_platforms") / F.lit(1e6), 3))


# --- reviews ----------------------------------------------------------------------------------------

@query("pivot_categories", """SELECT user_id, round(avg("value") FILTER (event_type = 'view'), 6) AS views, round(avg("value") FILTER (event_type = 'click'), 6) AS clicks,
  round(avg("value") FILTER (event_type = 'error'), 6) AS errors FROM events GROUP BY 1""")
def pivot_categories(spark, sf_dir):
    columns = {"view": "views", "click": "clicks", "error": "errors"}
    return rounded(reviews.category_columns(read(spark, sf_dir, "events"), ["user_id"], "event_type", "value", columns))


@query("category_mean", f"""WITH s AS (SELECT DISTINCT user_id, code, score FROM ({SCORE_SQL})),
c AS (SELECT user_id, code, avg(score) AS score FROM s GROUP BY 1, 2)
SELECT user_id AS booking_hotel_id, round(avg(score), 6) AS category_rating FROM c GROUP BY 1""")
def category_mean(spark, sf_dir):
    rows = project.booking_reviews(classify.classify(feed.lodging_feed(spark, sf_dir)))
    long = nested.rating_scores_long(rows, ["booking_hotel_id", "review_id"])
    long = long.drop("review_id").distinct()
    columns = reviews.category_columns(long, ["booking_hotel_id"])
    out = reviews.category_mean(columns, reviews.CATEGORY_COLUMNS.values())
    return rounded(out.select("booking_hotel_id", "category_rating"))


def lexicon_sql():
    values = ", ".join(f"('{t}', {w})" for t, w in LEXICON)
    return f"lex(token, weight) AS (VALUES {values})"


@query("sentiment", f"""WITH {lexicon_sql()}, w AS (SELECT doc_id, unnest(string_split({clean_sql('text')}, ' ')) AS t FROM documents),
s AS (SELECT doc_id, sum(greatest(coalesce(weight, 0), 0)) AS p, sum(greatest(-coalesce(weight, 0), 0)) AS n FROM w LEFT JOIN lex ON t = token WHERE t <> '' GROUP BY 1)
SELECT doc_id, round(CASE WHEN p + n > 0 THEN CAST(p - n AS DOUBLE) / CAST(p + n AS DOUBLE) END, 6) AS sentiment FROM s""")
def sentiment(spark, sf_dir):
    return rounded(reviews.sentiment(read(spark, sf_dir, "documents"), ["doc_id"], "doc_id", {"text": 0}, lexicon(spark)))


@query("sentiment_liked_disliked", """WITH s AS (SELECT user_id, sum(CASE WHEN event_type IN ('purchase','signup') THEN 1 ELSE 0 END) AS p,
  sum(CASE WHEN event_type IN ('error','click') THEN 2 ELSE 0 END) AS n FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT user_id AS booking_hotel_id, round(CAST(p - n AS DOUBLE) / CAST(p + n AS DOUBLE), 6) AS sentiment FROM s""")
def sentiment_liked_disliked(spark, sf_dir):
    rows = project.booking_reviews(classify.classify(feed.lodging_feed(spark, sf_dir)))
    texts = {"liked_text": 1, "disliked_text": -1}
    return rounded(reviews.sentiment(rows, ["booking_hotel_id"], "review_id", texts, lexicon(spark)))


@query("recent_reviews", f"""SELECT user_id, count(*) AS total_reviews, count(*) FILTER (CAST(ts AS DATE) > DATE '{EVENTS_AS_OF}' - INTERVAL 1 MONTH AND CAST(ts AS DATE) <= DATE '{EVENTS_AS_OF}') AS recent_reviews
FROM events GROUP BY 1""")
def recent_reviews(spark, sf_dir):
    return reviews.review_counts(read(spark, sf_dir, "events"), ["user_id"], "ts", EVENTS_AS_OF, 1)


@query("traveler_mode", """SELECT user_id, kind AS target_traveler_type FROM (SELECT user_id, kind, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, kind) AS r FROM (
  SELECT user_id, CASE event_type WHEN 'view' THEN 'solo' WHEN 'click' THEN 'couple' WHEN 'purchase' THEN 'family' WHEN 'signup' THEN 'group' END AS kind FROM events)
  WHERE kind IS NOT NULL GROUP BY 1, 2) WHERE r = 1""")
def traveler_mode(spark, sf_dir):
    rows = project.booking_reviews(classify.classify(feed.lodging_feed(spark, sf_dir)))
    rows = rows.select(F.col("booking_hotel_id").alias("user_id"), reviews.traveler_type("traveler_type").alias("kind"))
    return reviews.most_common(rows, ["user_id"], "kind", "target_traveler_type")


# --- facilities, scores, market ---------------------------------------------------------------------

FLAG_SQL = {
    "has_wifi": "k % 3 <> 0", "has_breakfast": "k % 3 = 0", "has_parking": "FALSE", "has_ac": "k % 2 = 0", "has_pool": "FALSE",
    "has_gym": "FALSE", "has_spa": "FALSE", "has_restaurant": "k % 7 = 0", "has_room_service": "k % 5 = 0", "has_24h_reception": "k % 4 = 0",
}


@query("facility_flags", f"""SELECT k AS booking_hotel_id, {', '.join(f'{v} AS {c}' for c, v in FLAG_SQL.items())},
  ({' + '.join(f'CAST({v} AS INTEGER)' for v in FLAG_SQL.values())}) * 10e0 AS facilities_score FROM (SELECT c_custkey AS k FROM customer)""")
def facility_flags(spark, sf_dir):
    rows = project.booking_hotels(classify.classify(feed.lodging_feed(spark, sf_dir)))
    rows = rows.withColumn("names", facilities.facility_names())
    out = facilities.facility_flags(rows, "names", also={"has_breakfast": F.length("breakfast") > 0})
    return out.select("booking_hotel_id", *facilities.FLAGS, scores.facilities_score(facilities.FLAGS).alias("facilities_score"))


@query("vocabulary_flags", """SELECT doc_id, lower(text) LIKE '%tion%' OR (lang = 'fr' AND lower(text) LIKE '%eau%') AS has_a,
  len(list_filter(string_split(text, ' '), lambda w: lower(w) = 'the')) > 0 AS has_b FROM documents""")
def vocabulary_flags(spark, sf_dir):
    rules = (
        facilities.FlagRule("has_a", "tion"), facilities.FlagRule("has_a", "EAU", platform="fr"), facilities.FlagRule("has_b", "The", "exact"),
    )
    rows = read(spark, sf_dir, "documents").withColumn("words", F.split("text", " "))
    return facilities.facility_flags(rows, "words", rules, ("has_a", "has_b"), "lang").select("doc_id", "has_a", "has_b")


@query("popularity", """SELECT p_partkey, round(p_size / 5e0 * ln(1 + CAST(p_partkey AS DOUBLE)), 6) AS popularity,
  round(CASE WHEN p_retailprice > 0 THEN ln(p_retailprice) END, 6) AS log_price FROM part""")
def popularity(spark, sf_dir):
    return rounded(read(spark, sf_dir, "part").select(
        "p_partkey", scores.popularity(F.col("p_size") / F.lit(5.0), "p_partkey").alias("popularity"),
        scores.log_price("p_retailprice").alias("log_price"),
    ))


@query("score_formulas", """SELECT p_partkey, round(CASE WHEN p_size % 7 > 0 THEN p_retailprice / (p_size % 7) END, 6) AS price_per_facility,
  round(p_size / (p_retailprice / 1e5), 6) AS value_score, round(1 / (1 + p_size / 3e0), 6) AS accessibility_score,
  round(0.7e0 * (p_size / 5e0) + 0.3e0 * (5 + 5 * (p_size % 3 - 1)), 6) AS experience_score, round(1 - abs(p_size / 5e0 - p_size % 11) / 10, 6) AS consistency FROM part""")
def score_formulas(spark, sf_dir):
    size = F.col("p_size")
    return rounded(read(spark, sf_dir, "part").select(
        "p_partkey", scores.price_per_facility("p_retailprice", size % 7).alias("price_per_facility"),
        scores.value_score(size, "p_retailprice").alias("value_score"),
        scores.accessibility_score(size / F.lit(3.0)).alias("accessibility_score"),
        scores.experience_score(size / F.lit(5.0), size % 3 - 1).alias("experience_score"),
        scores.review_consistency(size / F.lit(5.0), size % 11).alias("consistency"),
    ))


@query("area_ranks", """SELECT c_custkey, round(percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal), 9) AS price_rank_in_area,
  round(percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 10), 9) AS rating_rank_in_area FROM customer""")
def area_ranks(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").withColumn("rating", F.col("c_custkey") % 10)
    out = ranking.percent_rank(rows, "c_acctbal", "price_rank_in_area", ["c_nationkey"])
    out = ranking.percent_rank(out, "rating", "rating_rank_in_area", ["c_nationkey"])
    return rounded(out.select("c_custkey", "price_rank_in_area", "rating_rank_in_area"), 9)


@query("area_ranks_by_ranges", ORACLES["area_ranks"])
def area_ranks_by_ranges(spark, sf_dir):
    """The same ranks after a shuffle of the rows: their order and partitions play no part."""
    rows = read(spark, sf_dir, "customer").withColumn("rating", F.col("c_custkey") % 10).repartition(7, "c_acctbal")
    out = ranking.percent_rank(rows, "rating", "rating_rank_in_area", ["c_nationkey"])
    out = ranking.percent_rank(out, "c_acctbal", "price_rank_in_area", ["c_nationkey"])
    return rounded(out.select("c_custkey", "price_rank_in_area", "rating_rank_in_area"), 9)


@query("market_segments", """WITH q AS (SELECT quantile_cont(o_totalprice, 1/3e0) AS a, quantile_cont(o_totalprice, 2/3e0) AS b FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 'budget' WHEN o_totalprice <= b THEN 'mid-range' ELSE 'luxury' END AS market_segment FROM orders, q""")
def market_segments(spark, sf_dir):
    return market.with_segment(read(spark, sf_dir, "orders"), "o_totalprice").select("o_orderkey", "market_segment")


@query("availability", """SELECT user_id, count(DISTINCT event_type) AS booking_platform_count, count(DISTINCT event_type) / 5e0 AS availability_score,
  count(DISTINCT event_type) > 1 AS cross_platform_availability FROM events GROUP BY 1""")
def availability(spark, sf_dir):
    return market.availability(read(spark, sf_dir, "events"), "user_id", "event_type", 5)


@query("platform_preference", """SELECT user_id, event_type, count(*) AS reviews, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY user_id) AS DOUBLE), 6) AS platform_preference_score FROM events GROUP BY 1, 2""")
def platform_preference(spark, sf_dir):
    return rounded(market.platform_preference(read(spark, sf_dir, "events"), "user_id", "event_type"))


def calendar_sql():
    days = ", ".join(f"abs(date_diff('day', DATE '{h}', d))" for h in HOLIDAYS)
    return f"""SELECT o_orderkey, dayofweek(d) IN (0, 6) AS is_weekend, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
  month(d) IN (6, 7, 12) AS is_peak_season, CAST(least({days}) AS INTEGER) AS days_to_holiday FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""


@query("calendar", calendar_sql())
def calendar(spark, sf_dir):
    import datetime

    holidays = [datetime.date.fromisoformat(h) for h in HOLIDAYS]
    out = temporal.with_calendar(read(spark, sf_dir, "orders"), "o_orderdate", PEAK_MONTHS, holidays)
    return out.select("o_orderkey", "is_weekend", "month", "quarter", "is_peak_season", "days_to_holiday")


@query("hotel_identity", f"""SELECT sha256('booking.com:' || c_custkey) AS hotel_id, {clean_sql('c_name')} AS hotel_name_clean, 'booking' AS platform_source, {lat('c_custkey')} AS latitude,
  {lon('c_custkey')} AS longitude, lower(c_mktsegment) AS accommodation_type, CAST(c_nationkey % 6 AS DOUBLE) AS stars, CAST(c_nationkey % 6 AS INTEGER) AS hotel_class FROM customer""")
def hotel_identity(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").withColumn("class_text", (F.col("c_nationkey") % 6).cast("double").cast("string"))
    return rows.select(
        F.sha2(F.concat_ws(":", F.lit("booking.com"), "c_custkey"), 256).alias("hotel_id"), text.name_key("c_name").alias("hotel_name_clean"),
        scores.platform_source(F.lit(True), F.lit(False)).alias("platform_source"),
        feed.latitude("c_custkey").alias("latitude"), feed.longitude("c_custkey").alias("longitude"),
        F.lower("c_mktsegment").alias("accommodation_type"), casts.to_double("class_text").alias("stars"), casts.to_int("class_text").alias("hotel_class"),
    )


@query("freshness", f"""SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS collected, round(exp(-date_diff('day', CAST(ts AS DATE), DATE '{EVENTS_AS_OF}') / 180e0), 6) AS freshness,
  round((3 + CAST(event_id % 5 <> 0 AS INTEGER)) / 4e0, 6) AS completeness FROM events""")
def freshness(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("title", F.when(F.col("event_id") % 5 != 0, F.col("event_type")))
    return rounded(rows.select(
        "event_id", F.to_date("ts").cast("string").alias("collected"),
        scores.freshness(F.to_date("ts"), F.lit(EVENTS_AS_OF).cast("date")).alias("freshness"),
        casts.known_fraction(["event_id", "ts", "value", "title"]).alias("completeness"),
    ))


# --- data quality -----------------------------------------------------------------------------------

@query("dq_completeness", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS present, count(*) AS "rows", round(count("{c}") / CAST(count(*) AS DOUBLE), 6) AS completeness FROM m"""
    for t in ("customer", "supplier", "part", "orders", "events") for c in PROFILED[t].split()
).join([f"WITH {MIXED_SQL}, m AS (SELECT * FROM mixed) ", ""]))
def dq_completeness(spark, sf_dir):
    return rounded(quality.completeness(mixed(spark, sf_dir)))


ORDER_RULES = {
    "price_range": "o_totalprice BETWEEN 2000 AND 400000",
    "known_status": "o_orderstatus IN ('F', 'O')",
    "dated": "o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'",
}


@query("dq_accuracy", " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, count(*) FILTER ({e}) AS valid, count(*) AS "rows", round(count(*) FILTER ({e}) / CAST(count(*) AS DOUBLE), 6) AS accuracy FROM orders"""
    for n, e in ORDER_RULES.items()
))
def dq_accuracy(spark, sf_dir):
    return rounded(quality.accuracy(read(spark, sf_dir, "orders"), ORDER_RULES))


@query("dq_timeliness", f"""SELECT event_type, count(*) AS "rows", CAST(max(date_diff('day', CAST(ts AS DATE), DATE '{EVENTS_AS_OF}')) AS BIGINT) AS max_age_days,
  round(avg(date_diff('day', CAST(ts AS DATE), DATE '{EVENTS_AS_OF}')), 6) AS mean_age_days FROM events GROUP BY 1""")
def dq_timeliness(spark, sf_dir):
    return rounded(quality.timeliness(read(spark, sf_dir, "events"), "event_type", "ts", EVENTS_AS_OF))


@query("dq_uniqueness", """SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_duplicates FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def dq_uniqueness(spark, sf_dir):
    return quality.uniqueness(read(spark, sf_dir, "documents"), ["text"], digest=True)


@query("dq_duplicate_keys", "SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(read(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("dq_violations", "SELECT o_orderkey, concat_ws(',', {}) AS broken_rules FROM orders WHERE NOT ({})".format(
    ", ".join(f"CASE WHEN NOT ({e}) THEN '{n}' END" for n, e in ORDER_RULES.items()), " AND ".join(f"({e})" for e in ORDER_RULES.values())
))
def dq_violations(spark, sf_dir):
    rows = quality.violations(read(spark, sf_dir, "orders"), ORDER_RULES)
    return rows.select("o_orderkey", F.array_join("broken_rules", ",").alias("broken_rules"))


# --- the model tables -------------------------------------------------------------------------------

def model_sql() -> str:
    """Common table expressions of the model tables: hotels, their match, and the three parts."""
    n, s = clean_sql("hotel_name"), "1e0 - levenshtein(a.n, b.n) / CAST(greatest(length(a.n), length(b.n)) AS DOUBLE)"
    d = hav("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    step = repr(grid_step(5.0)) + "e0"
    row = f"CAST(floor((latitude + 90) / {step}) AS BIGINT)"
    width = f"floor({360.0 / grid_step(5.0)!r}e0 * cos(radians(greatest(abs(r * {step} - 90), abs(r * {step} - 90 + {step})))))"
    flags_b = {"has_wifi": "k % 3 <> 0", "has_ac": "k % 2 = 0", "has_restaurant": "k % 7 = 0", "has_room_service": "k % 5 = 0", "has_24h_reception": "k % 4 = 0"}
    flags_t = {"has_wifi": "k % 2 = 0", "has_ac": "k % 3 = 0", "has_pool": "k % 4 = 1", "has_parking": "TRUE"}
    def side(flags):
        return ", ".join(f"{flags.get(f, 'FALSE')} AS {f}" for f in facilities.FLAGS)

    count_b, count_t = (" + ".join(f"CAST({v} AS INTEGER)" for v in f.values()) for f in (flags_b, flags_t))
    days = ", ".join(f"abs(date_diff('day', DATE '{h}', collected))" for h in HOLIDAYS)
    rings = ", ".join(f"CAST(count(*) FILTER (km <= {r}e0) AS INTEGER) AS attraction_density_{r}km" for r in (1, 2, 5))
    marks = ", ".join(f"{hav('latitude', 'longitude', f'({a}e0)', f'{b}e0')} AS {c}" for c, (a, b) in CITY.items())
    categories = ", ".join(f"avg(DISTINCT score) FILTER (code = '{c}') AS {name}" for c, name in reviews.CATEGORY_COLUMNS.items())
    return f"""{BH_SQL}, {TH_SQL}, {AT_SQL}, {lexicon_sql()},
a AS (SELECT *, {n} AS n FROM bh), b AS (SELECT *, {n} AS n FROM th),
pairs AS (SELECT a.k AS a_id, b.k AS b_id, {s} AS similarity, {d} AS km FROM a, b WHERE a.latitude IS NOT NULL),
good AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY similarity DESC, km, CAST(b_id AS VARCHAR)) AS ra,
  row_number() OVER (PARTITION BY b_id ORDER BY similarity DESC, km, CAST(a_id AS VARCHAR)) AS rb FROM pairs WHERE km < 0.1e0 AND similarity >= 0.6e0),
m AS (SELECT a_id, b_id FROM good WHERE ra = 1 AND rb = 1),
pa AS (SELECT a.*, CAST(amount AS DOUBLE) AS price, {side(flags_b)}, {count_b} AS names FROM a),
pb AS (SELECT b.*, CAST(amount AS DOUBLE) AS price, {side(flags_t)}, {count_t} AS names FROM b),
merged AS (
  SELECT sha256('booking.com:' || pa.k) AS hotel_id, pa.n AS hotel_name_clean, pa.accommodation_type, CAST(pa.stars AS DOUBLE) AS stars, pa.stars AS hotel_class,
    pa.latitude, pa.longitude, pa.price AS price_idr, CASE WHEN pb.k IS NULL THEN 0e0 ELSE pow((pa.price - pb.price) / 2, 2) END AS price_variance_platforms,
    CASE WHEN pa.rating IS NOT NULL AND pb.rating IS NOT NULL THEN (pa.rating + pb.rating * 2) / 2 ELSE coalesce(pa.rating, pb.rating * 2) END AS rating,
    1 - abs(pa.rating - pb.rating * 2) / 10 AS review_consistency, pa.reviews AS listed, pa.names + coalesce(pb.names, 0) AS names, pa.collected,
    CASE WHEN pb.k IS NULL THEN 'booking' ELSE 'merged' END AS platform_source, pa.k AS a_k, pb.k AS b_k,
    {', '.join(f"pa.{f} OR coalesce(pb.{f}, FALSE){' OR pa.breakfast IS NOT NULL' if f == 'has_breakfast' else ''} AS {f}" for f in facilities.FLAGS)}
  FROM pa LEFT JOIN m ON a_id = pa.k LEFT JOIN pb ON pb.k = b_id
  UNION ALL SELECT sha256('tripadvisor.com:' || k), n, accommodation_type, CAST(stars AS DOUBLE), stars, latitude, longitude, price, 0e0, rating * 2, NULL, reviews, names,
    DATE '{AS_OF}', 'tripadvisor', NULL, k, {', '.join(facilities.FLAGS)} FROM pb WHERE k NOT IN (SELECT b_id FROM m)),
scored AS (SELECT *, ({' + '.join(f'CAST({f} AS INTEGER)' for f in facilities.FLAGS)}) * 10e0 AS facilities_score FROM merged),
located AS (SELECT *, CAST(floor((longitude + 180) * {width} / 360) AS BIGINT) AS c FROM (SELECT *, {row} AS r FROM scored WHERE latitude IS NOT NULL)),
price_ranks AS (SELECT hotel_id, percent_rank() OVER (PARTITION BY r, c ORDER BY price_idr) AS price_rank_in_area FROM located),
rating_ranks AS (SELECT hotel_id, percent_rank() OVER (PARTITION BY r, c ORDER BY rating) AS rating_rank_in_area FROM located WHERE rating IS NOT NULL),
terciles AS (SELECT quantile_cont(price_idr, 1/3e0) AS low, quantile_cont(price_idr, 2/3e0) AS high FROM merged),
hotel_part AS (SELECT scored.hotel_id, hotel_name_clean, price_idr, ln(price_idr) AS log_price, platform_source, latitude, longitude, accommodation_type, stars, hotel_class,
  {', '.join(facilities.FLAGS)}, facilities_score, price_rank_in_area, rating_rank_in_area,
  dayofweek(collected) IN (0, 6) AS is_weekend, CAST(month(collected) AS INTEGER) AS month, CAST(quarter(collected) AS INTEGER) AS quarter,
  month(collected) IN (6, 7, 12) AS is_peak_season, CAST(least({days}) AS INTEGER) AS days_to_holiday,
  CASE WHEN price_idr <= low THEN 'budget' WHEN price_idr <= high THEN 'mid-range' ELSE 'luxury' END AS market_segment,
  CASE WHEN platform_source = 'merged' THEN 2 ELSE 1 END AS booking_platform_count, CASE WHEN names > 0 THEN price_idr / names END AS price_per_facility,
  rating * ln(1 + listed) AS popularity_score, facilities_score / (price_idr / 1e5) AS value_score, price_variance_platforms,
  platform_source = 'merged' AS cross_platform_availability, exp(-date_diff('day', collected, DATE '{AS_OF}') / 180e0) AS data_freshness_score
  FROM scored CROSS JOIN terciles LEFT JOIN price_ranks USING (hotel_id) LEFT JOIN rating_ranks USING (hotel_id)),
geo AS (SELECT h.hotel_id, {hav('h.latitude', 'h.longitude', 'att.latitude', 'att.longitude')} AS km, category_name FROM merged h, att WHERE h.latitude IS NOT NULL),
near AS (SELECT hotel_id, min(km) AS distance_to_nearest_attraction, {rings},
  CAST(count(*) FILTER (km <= 1e0 AND lower(category_name) LIKE '%restaurant%') AS INTEGER) AS restaurant_density_1km FROM geo GROUP BY 1),
rivals AS (SELECT a.hotel_id, CAST(count(*) FILTER ({d} <= 0.5e0) - 1 AS INTEGER) AS competitors_within_500m
  FROM merged a, merged b WHERE a.latitude IS NOT NULL AND b.latitude IS NOT NULL GROUP BY 1),
geo_part AS (SELECT merged.hotel_id, latitude, longitude, {marks}, near.* EXCLUDE (hotel_id), competitors_within_500m
  FROM merged LEFT JOIN near USING (hotel_id) LEFT JOIN rivals USING (hotel_id)),
links AS (SELECT 'b' AS p, a_k AS k, hotel_id FROM merged WHERE a_k IS NOT NULL UNION ALL SELECT 't', b_k, hotel_id FROM merged WHERE b_k IS NOT NULL),
facts AS (SELECT 'b' AS p, user_id AS k, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'view' THEN 'solo' WHEN 'click' THEN 'couple' WHEN 'purchase' THEN 'family' WHEN 'signup' THEN 'group' END AS kind,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS pos, CASE WHEN event_type IN ('error', 'click') THEN 2 ELSE 0 END AS neg FROM events
  UNION ALL SELECT 't', conv_id, CAST('2024-' || lpad(CAST(1 + conv_id % 12 AS VARCHAR), 2, '0') || '-15' AS DATE),
    CASE WHEN turn % 2 = 0 THEN 'family' ELSE 'business' END, pos, neg FROM (
    SELECT conv_id, turn, sum(greatest(coalesce(weight, 0), 0)) AS pos, sum(greatest(-coalesce(weight, 0), 0)) AS neg FROM (
      SELECT conv_id, turn, unnest(string_split({clean_sql('text')}, ' ')) AS t FROM conversations) LEFT JOIN lex ON t = token GROUP BY 1, 2)),
joined AS (SELECT * FROM facts JOIN links USING (p, k)),
per_platform AS (SELECT hotel_id, p, count(*) AS n, count(*) FILTER (day > DATE '2024-12-01' AND day <= DATE '{AS_OF}') AS recent, sum(pos) AS pos, sum(neg) AS neg FROM joined GROUP BY 1, 2),
totals AS (SELECT hotel_id, CAST(sum(n) AS INTEGER) AS total_reviews, CAST(sum(recent) AS INTEGER) AS recent_reviews, max(n) / CAST(sum(n) AS DOUBLE) AS platform_preference_score,
  CASE WHEN sum(pos) + sum(neg) > 0 THEN CAST(sum(pos) - sum(neg) AS DOUBLE) / CAST(sum(pos) + sum(neg) AS DOUBLE) END AS review_sentiment_score FROM per_platform GROUP BY 1),
modes AS (SELECT hotel_id, kind AS target_traveler_type FROM (SELECT hotel_id, kind, row_number() OVER (PARTITION BY hotel_id ORDER BY count(*) DESC, kind) AS r
  FROM joined WHERE kind IS NOT NULL GROUP BY 1, 2) WHERE r = 1),
marks AS (SELECT hotel_id, {categories} FROM (SELECT user_id AS k, code, score FROM ({SCORE_SQL})) JOIN links ON links.k = user_id_k AND p = 'b' GROUP BY 1),
review_part AS (SELECT merged.hotel_id, rating AS overall_rating, marks.* EXCLUDE (hotel_id), coalesce(total_reviews, 0) AS total_reviews, coalesce(recent_reviews, 0) AS recent_reviews,
  review_sentiment_score, review_consistency, target_traveler_type, platform_preference_score
  FROM merged LEFT JOIN totals USING (hotel_id) LEFT JOIN modes USING (hotel_id) LEFT JOIN marks USING (hotel_id))""".replace(
        "SELECT user_id AS k, code, score FROM", "SELECT user_id AS user_id_k, code, score FROM"
    )


def _part_columns(kinds, chosen):
    return ", ".join(f"round({c}, 6) AS {c}" if kinds[c] == "double" else c for c in chosen)


def model_select(part: str, columns) -> str:
    kinds = dict(FEATURE_COLUMNS)
    return f"WITH {model_sql()} SELECT {_part_columns(kinds, columns)} FROM {part}"


HOTEL_PART = ("hotel_id hotel_name_clean price_idr log_price platform_source latitude longitude accommodation_type stars hotel_class "
              + " ".join(facilities.FLAGS) + " facilities_score price_rank_in_area rating_rank_in_area is_weekend month quarter is_peak_season "
              "days_to_holiday market_segment booking_platform_count price_per_facility popularity_score value_score price_variance_platforms "
              "cross_platform_availability data_freshness_score").split()
GEO_PART = ("hotel_id latitude longitude distance_to_city_center distance_to_malioboro distance_to_airport distance_to_nearest_attraction "
            "attraction_density_1km attraction_density_2km attraction_density_5km restaurant_density_1km competitors_within_500m").split()
REVIEW_PART = ("hotel_id overall_rating rating_staff rating_cleanliness rating_facilities rating_location rating_comfort rating_value_for_money "
               "total_reviews recent_reviews review_sentiment_score review_consistency target_traveler_type platform_preference_score").split()


def prediction_sql():
    kinds = dict(FEATURE_COLUMNS)
    filled = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in kinds if c != "data_completeness_score")
    days = {"data_collection_date": "CAST(data_collection_date AS VARCHAR) AS data_collection_date", "last_updated": "CAST(last_updated AS VARCHAR) AS last_updated"}
    columns = ", ".join(days.get(c) or _part_columns(kinds, [c]) for c in kinds)
    return f"""WITH {model_sql()}, wide AS (SELECT hotel_part.*, review_part.* EXCLUDE (hotel_id), geo_part.* EXCLUDE (hotel_id, latitude, longitude),
  1 / (1 + distance_to_city_center) AS accessibility_score, 0.7e0 * overall_rating + 0.3e0 * (5 + 5 * coalesce(review_sentiment_score, 0)) AS experience_score,
  scored.collected AS data_collection_date, DATE '{AS_OF}' AS last_updated
  FROM hotel_part JOIN scored USING (hotel_id) JOIN review_part USING (hotel_id) JOIN geo_part USING (hotel_id)),
whole AS (SELECT *, ({filled}) / 62e0 AS data_completeness_score FROM wide) SELECT {columns} FROM whole"""


def _model(name):
    def run(spark, sf_dir):
        classified = batch.land_classified(feed.lodging_feed(spark, sf_dir), run_folder(spark, "classified"))
        return rounded(batch.model_tables(classified, settings(spark), (name,))[name])

    return run


query("hotel_features", model_select("hotel_part", HOTEL_PART))(_model("hotel_features"))
query("geospatial_features", model_select("geo_part", GEO_PART))(_model("geospatial_features"))
query("review_features", model_select("review_part", REVIEW_PART))(_model("review_features"))


@query("prediction_dataset", prediction_sql())
def prediction_dataset(spark, sf_dir):
    rows = _model("prediction_dataset")(spark, sf_dir)
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("data_collection_date", "last_updated")})

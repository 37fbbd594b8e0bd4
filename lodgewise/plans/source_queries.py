"""Queries over sources, snapshots and large lookup tables; they join those of `queries`."""

from pyspark.sql import DataFrame, functions as F


from lodgewise.operators import asof, classify, edit_join as editing, reviews, vocabulary
from lodgewise.operators.records import explode_records
from lodgewise.plans import batch, lodging_feed as feed
from lodgewise.plans.queries import AS_OF, CITY, SHIFT, clean_sql, hav, lat, lon, places, query, read, run_folder, settings
from lodgewise.sources import clustered, discovery, feeds, json_arrays, sketches
from lodgewise.streaming import upsert

RADIUS = 6.0


# --- clustered files (R45, R05) -------------------------------------------------------------------

@query("radius_read", " UNION ALL ".join(
    f"SELECT '{name}' AS place, id, round(d, 6) AS distance_km FROM (SELECT p_partkey AS id, {hav(lat('p_partkey', SHIFT), lon('p_partkey'), f'{a}e0', f'{b}e0')} AS d FROM part) WHERE d <= {RADIUS}e0"
    for name, (a, b) in CITY.items()))
def radius_read(spark, sf_dir):
    """Attractions stored along the curve; only what the circles around the landmarks touch is read back."""
    spots = places(spark, sf_dir, "part", "p_partkey", "p_name", shift=SHIFT)
    path = clustered.write_clustered(spots, run_folder(spark, "clustered"))
    found = clustered.read_around(spark, path, CITY, RADIUS)
    return found.select("place", "id", F.round("distance_km", 6).alias("distance_km"))


# --- schema discovery (R06) -----------------------------------------------------------------------

def _texts(spark, sf_dir):
    """Events and orders as JSON of uneven shape, written as text and read back."""
    events = read(spark, sf_dir, "events").select(F.to_json(F.struct(
        "event_id", "event_type", F.from_json("props", "k int").alias("props"), F.array("user_id", "event_id").alias("pair"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))).alias("value"))
    orders = read(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    shapes = [
        orders.filter(key % 7 == 0).select(F.to_json(F.struct(key, F.concat(F.lit("Rp "), price.cast("string")).alias("price"))).alias("value")),
        orders.filter(key % 7 == 1).select(F.to_json(F.struct(key, F.floor(price).cast("long").alias("price"))).alias("value")),
        orders.filter(key % 7 > 1).select(F.to_json(F.struct(key, (F.floor(price) + F.lit(0.5)).alias("price"))).alias("value")),
    ]
    path = run_folder(spark, "texts")
    for i, part in enumerate([events, *shapes]):
        part.write.text(f"{path}/{i}")
    return [spark.read.text(f"{path}/{i}") for i in range(4)]


@query("schema_discovery", """WITH e AS (SELECT count(*) AS n, count(*) FILTER (event_id % 3 = 0 AND "value" IS NOT NULL) AS v, count(event_type) AS t,
    count(json_extract(props, '$.k')) AS k, count(event_id) AS i FROM events),
o AS (SELECT count(*) AS n, count(o_orderkey) AS k, count(o_totalprice) AS p FROM orders), r AS (SELECT e.n + o.n AS n FROM e, o)
SELECT '' AS path, 'struct' AS type, r.n AS "rows", r.n AS present FROM r
UNION ALL SELECT 'event_id', 'bigint', r.n, i FROM e, r UNION ALL SELECT 'event_type', 'string', r.n, t FROM e, r
UNION ALL SELECT 'props', 'struct', r.n, e.n FROM e, r UNION ALL SELECT 'props.k', 'bigint', e.n, k FROM e
UNION ALL SELECT 'pair', 'array', r.n, e.n FROM e, r UNION ALL SELECT 'pair[]', 'bigint', 2 * e.n, 2 * e.n FROM e
UNION ALL SELECT 'value', 'double', r.n, v FROM e, r UNION ALL SELECT 'o_orderkey', 'bigint', r.n, o.k FROM o, r
UNION ALL SELECT 'price', 'choice<bigint,double,string>', r.n, p FROM o, r""")
def schema_discovery(spark, sf_dir):
    """Counts of each delivery are made apart and added; the schema is read from the sums."""
    return discovery.schema_table(discovery.added(*[discovery.kind_counts(t) for t in _texts(spark, sf_dir)]))


@query("read_discovered", """SELECT count(*) AS n, count(*) FILTER (o_orderkey % 7 = 1) AS whole, count(*) FILTER (o_orderkey % 7 > 1) AS broken,
  count(*) FILTER (o_orderkey % 7 = 0) AS texts, round(sum(floor(o_totalprice)) FILTER (o_orderkey % 7 = 1), 2) AS total FROM orders""")
def read_discovered(spark, sf_dir):
    """Orders of three shapes read in the schema found in them: the price is a choice with a branch per kind."""
    _, *shapes = _texts(spark, sf_dir)
    texts = shapes[0].union(shapes[1]).union(shapes[2])
    rows = discovery.read_discovered(texts, choices=True)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count("price.long").alias("whole"), F.count("price.double").alias("broken"), F.count("price.string").alias("texts"),
        F.round(F.sum(F.col("price.long").cast("double")), 2).alias("total"),
    )


# --- JSON files (R02, R03, R10, R16) --------------------------------------------------------------

def _write_arrays(df: DataFrame, path: str, files: int) -> str:
    """Each file one JSON array."""
    def lines(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        first = True
        for batch in batches:
            if batch.num_rows:
                marks = pa.array(["[" if first else ",", *[","] * (batch.num_rows - 1)], batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0), "")], ["value"])
                first = False
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).repartition(files).mapInArrow(lines, "value string").write.text(path)
    return path


EVENTS_SQL = 'SELECT event_id, user_id, event_type, "value", props FROM events'


@query("read_large_array", EVENTS_SQL)
def read_large_array(spark, sf_dir):
    """Events, whose `props` hold braces and quotes, from files of one array each, cut at record boundaries."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = _write_arrays(events, run_folder(spark, "arrays"), 3)
    return json_arrays.read_arrays(spark, path, events.schema, pattern="*.txt").select(*events.columns)


@query("read_json_files", """SELECT 'events' AS feed, count(*) AS records, count(*) AS ids FROM events
UNION ALL SELECT 'orders', count(*), count(*) FROM orders""")
def read_json_files(spark, sf_dir):
    """Feeds of several files; text files that other jobs left in the folders are no data."""
    path = run_folder(spark, "feeds")
    for name in ("events", "orders"):
        rows = read(spark, sf_dir, name).select(F.to_json(F.struct("*")).alias("value"))
        rows.repartition(3).write.option("compression", "none").json(f"{path}/{name}")
        rows.limit(5).coalesce(1).write.text(f"{path}/{name}/left.tmp")
    out = []
    for name, key in (("events", "event_id"), ("orders", "o_orderkey")):
        nested = feeds.read_feed(spark, [f"{path}/{name}", f"{path}/{name}/left.tmp"], _one_text(), multi_line=False)
        out.append(nested.groupBy().agg(F.lit(name).alias("feed"), F.count("value").alias("records"), F.count_distinct("value").alias("ids")))
    return out[0].unionByName(out[1])


def _one_text():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("value", T.StringType())])


@query("flat_or_array", "SELECT event_type, 2 * count(*) AS n, count(*) AS ids FROM events GROUP BY 1")
def flat_or_array(spark, sf_dir):
    """A table without the array column is flat already; one with it gives a row per element. Both give the same rows."""
    flat = read(spark, sf_dir, "events").select("event_id", "event_type")
    held = flat.groupBy(F.floor(F.col("event_id") / 50).alias("part")).agg(F.collect_list(F.struct("event_id", "event_type")).alias("array"))
    both = explode_records(flat).drop("row_id").unionByName(explode_records(held, source="part").select("event_id", "event_type"))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("empty_classes", """SELECT 'booking_hotels' AS name, 24 AS columns, count(*) AS n FROM customer
UNION ALL SELECT 'booking_reviews', 20, 0 UNION ALL SELECT 'tripadvisor_hotels', 27, 0 UNION ALL SELECT 'tripadvisor_reviews', 16, 0
UNION ALL SELECT 'geospatial_attractions', 23, 0""")
def empty_classes(spark, sf_dir):
    """A feed of hotels only: the other classes give empty tables with all their columns."""
    hotels = feed.lodging_feed(spark, sf_dir).filter(F.col("hotelId").isNotNull() & F.col("type").isNotNull())
    tables = batch.typed_tables(classify.classify(hotels), AS_OF)
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(len(df.columns)).alias("columns"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# --- upserts (R04, D01) ---------------------------------------------------------------------------

@query("upsert_deliveries", """SELECT user_id, event_id, event_type, "value" FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def upsert_deliveries(spark, sf_dir):
    """Three deliveries in an order that makes some rows late and repeats others; one of them is sent twice."""
    events, path = read(spark, sf_dir, "events"), run_folder(spark, "upserts")
    third = F.col("event_id") % 3
    deliveries = [events.filter(third == 2), events.filter((third == 0) | (F.col("event_id") % 5 == 2)), events.filter(third == 1)]
    for n in (0, 1, 1, 2):
        upsert.upsert(deliveries[n], path, ["user_id"], "ts", "event_id", f"delivery-{n}", buckets=16)
    return upsert.read_snapshot(spark, path).select("user_id", "event_id", "event_type", "value")


# --- names (D08) ----------------------------------------------------------------------------------

@query("similar_names", """WITH n AS (SELECT doc_id AS id, lang, substr(trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')), 1, 26) AS name FROM documents)
SELECT a.lang, a.id AS a_id, b.id AS b_id, round(1e0 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)), 6) AS similarity
FROM n a JOIN n b ON a.lang = b.lang AND a.id % 2 = 0 AND b.id % 2 = 1
WHERE greatest(length(a.name), length(b.name)) > 0 AND 1e0 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)) >= 0.7e0
UNION ALL SELECT a.lang, a.id, b.id, 1e0 FROM n a JOIN n b ON a.lang = b.lang AND a.id % 2 = 0 AND b.id % 2 = 1 AND a.name = '' AND b.name = ''""")
def similar_names(spark, sf_dir):
    """Beginnings of texts of one language that differ in few characters."""
    name = F.substring(F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " ")), 1, 26)
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", name.alias("name"))
    pairs = editing.edit_join(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), 0.7, by=["lang"])
    return pairs.withColumn("similarity", F.round("similarity", 6))


# --- dated tables (D32, D03) ----------------------------------------------------------------------

HOLIDAYS_SQL = """h AS (SELECT DISTINCT n_regionkey AS region, CAST(o_orderdate AS DATE) AS date FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 211 = 0)"""


@query("holidays_by_region", f"""WITH {HOLIDAYS_SQL}, f AS (SELECT o_orderkey, n_regionkey AS region, CAST(o_orderdate AS DATE) AS day FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT o_orderkey, CAST(min(abs(h.date - day)) AS INTEGER) AS days_to_holiday FROM f LEFT JOIN h USING (region) GROUP BY o_orderkey""")
def holidays_by_region(spark, sf_dir):
    """Days from each order to the nearest holiday of its region, from a table of holidays."""
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    region = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_regionkey").alias("region"))
    facts = read(spark, sf_dir, "orders").join(region, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "region", "o_orderdate")
    holidays = facts.filter("o_orderkey % 211 = 0").select("region", F.col("o_orderdate").cast("date").alias("date")).distinct()
    return asof.days_to_nearest(facts, "o_orderdate", holidays, key="region").select("o_orderkey", "days_to_holiday")


@query("rates_by_day", """WITH r AS (SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS date, min(1 + (o_orderkey % 100) / 100e0) AS to_idr FROM orders
  WHERE o_orderkey % 37 = 0 GROUP BY ALL)
SELECT o_orderkey, round(o_totalprice * to_idr, 6) AS price_idr FROM orders o ASOF LEFT JOIN r ON o.o_orderpriority = r.currency AND CAST(o.o_orderdate AS DATE) >= r.date""")
def rates_by_day(spark, sf_dir):
    """Prices by the rate of their day, or the last one before it; days with several rates count the lowest."""
    orders = read(spark, sf_dir, "orders")
    rates = orders.filter("o_orderkey % 37 = 0").select(F.col("o_orderpriority").alias("currency"), F.col("o_orderdate").alias("date"), (1 + (F.col("o_orderkey") % 100) / 100.0).alias("to_idr"))
    found = asof.to_idr_by_day(orders, "o_totalprice", "o_orderpriority", "o_orderdate", rates)
    return found.select("o_orderkey", F.round("price_idr", 6).alias("price_idr"))


# --- a table of patterns (D14) --------------------------------------------------------------------

def _mode_sql(text, pattern, mode):
    return f"CASE {mode} WHEN 0 THEN {text} = {pattern} WHEN 1 THEN contains({text}, {pattern}) WHEN 2 THEN starts_with({text}, {pattern}) ELSE suffix({text}, {pattern}) END"


@query("vocabulary_table", f"""WITH p AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN p_type END AS own, lower(substr(p_name, CAST(1 + p_partkey % 4 AS BIGINT), CAST(2 + p_partkey % 7 AS BIGINT))) AS pattern,
    p_partkey % 4 AS mode, 'flag' || p_partkey % 40 AS flag FROM part),
n AS (SELECT DISTINCT p_type AS platform, lower(p_name) AS name FROM part),
r AS (SELECT DISTINCT platform, name, flag FROM n JOIN p ON (own IS NULL OR own = platform) AND pattern <> '' AND {_mode_sql('name', 'pattern', 'mode')})
SELECT p_partkey, string_agg(flag, ',' ORDER BY flag) AS flags FROM part JOIN r ON p_type = platform AND lower(p_name) = name GROUP BY p_partkey""")
def vocabulary_table(spark, sf_dir):
    """Thousands of rules taken from the names themselves, matched with the names of their platform or of all."""
    part = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    modes = F.array(*[F.lit(m) for m in ("exact", "has", "starts", "ends")])
    rules = part.select(
        F.when(k % 2 == 0, F.col("p_type")).alias("platform"), F.substring("p_name", (1 + k % 4).cast("int"), (2 + k % 7).cast("int")).alias("pattern"),
        F.get(modes, (k % 4).cast("int")).alias("mode"), F.concat(F.lit("flag"), (k % 40).cast("string")).alias("flag"),
    )
    flags = [f"flag{i}" for i in range(40)]
    rows = part.select(k, "p_type", F.array("p_name").alias("names"))
    out = vocabulary.with_vocabulary(rows, "p_partkey", "names", rules, flags, "p_type")
    held = F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]))), ",")
    return out.select(k, held.alias("flags")).filter("flags <> ''")


# --- words of a text in its row (D20) -------------------------------------------------------------

PRAISE = {"the": 1, "and": 1, "la": -1, "der": -1, "of": 2, "que": -2, "pour": 1, "los": 3}
NEGATORS = ("is", "le", "und", "por")


@query("phrase_sentiment", f"""WITH w AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id) AS p, w FROM (SELECT doc_id, lang, unnest(list_filter(string_split({clean_sql('text')}, ' '), lambda x: x <> '')) AS w FROM documents)),
o AS (SELECT doc_id, lang, w, lag(w) OVER (PARTITION BY doc_id ORDER BY p) AS b FROM w),
s AS (SELECT doc_id, lang, CASE w {' '.join(f"WHEN '{k}' THEN {v}" for k, v in PRAISE.items())} ELSE 0 END * CASE WHEN b IN {NEGATORS} THEN -1 ELSE 1 END AS s FROM o),
t AS (SELECT doc_id, lang, sum(greatest(s, 0)) AS p, sum(greatest(-s, 0)) AS n FROM s GROUP BY ALL)
SELECT d.lang, CAST(sum(CASE WHEN p + n = 0 THEN 1 ELSE coalesce(p, 0) END) AS BIGINT) AS positive, CAST(coalesce(sum(n), 0) AS BIGINT) AS negative
FROM documents d LEFT JOIN t USING (doc_id) GROUP BY d.lang""")
def phrase_sentiment(spark, sf_dir):
    """Praise and complaint per language; a word right behind a negator counts the other way round."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return reviews.phrase_weights(docs, ["lang"], {"text": 1}, PRAISE, NEGATORS)


# --- profiles from stored sketches (R08) ----------------------------------------------------------

PROFILED_EVENTS = ("event_id", "user_id", "event_type", "value")


@query("stored_profiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS "rows", count("{c}") AS present, {'CAST(min("' + c + '") AS DOUBLE)' if c != 'event_type' else 'CAST(NULL AS DOUBLE)'} AS least,
  {'CAST(max("' + c + '") AS DOUBLE)' if c != 'event_type' else 'CAST(NULL AS DOUBLE)'} AS most, TRUE AS distinct_within, TRUE AS median_within FROM events""" for c in PROFILED_EVENTS))
def stored_profiles(spark, sf_dir):
    """Four deliveries of events profiled apart; their sketches merged say what the whole table holds, within their
    bounds: 3 % of the distinct values, 2 % of the rows around the median."""
    events, path = read(spark, sf_dir, "events").select(*PROFILED_EVENTS), run_folder(spark, "profiles")
    for i in range(4):
        sketches.store(events.filter(F.col("event_id") % 4 == i), f"delivery-{i}", path)
    merged = sketches.merged(sketches.stored(spark, path), (0.5,))
    medians = {r.column: r.quantiles[0] if r.quantiles else None for r in merged.select("column", "quantiles").collect()}  # a row per column
    share = lambda c, below: F.count_if(F.col(c).cast("double") < medians[c] if below else F.col(c).cast("double") <= medians[c]) / F.count(c)
    near = lambda c: F.lit(True) if medians[c] is None else (share(c, True) <= 0.52) & (share(c, False) >= 0.48)
    exact = events.agg(*[F.struct(F.lit(c).alias("c"), F.count_distinct(c).alias("distinct"), near(c).alias("median_within")).alias(f"x{i}") for i, c in enumerate(PROFILED_EVENTS)])
    exact = exact.select(F.explode(F.array(*[f"x{i}" for i in range(len(PROFILED_EVENTS))])).alias("x")).select("x.*")
    out = merged.join(exact, F.col("column") == F.col("c"))
    within = F.abs(F.col("distinct_estimate") - F.col("distinct")) <= 0.03 * F.col("distinct")
    return out.select("column", "rows", "present", "least", "most", within.alias("distinct_within"), "median_within")


# --- what the batch run measures while it writes (D40, D41, D43) ----------------------------------

@query("batch_quality", """SELECT 'booking_hotels' AS dataset, 'rows' AS measure, count(*) AS value FROM customer
UNION ALL SELECT 'booking_hotels', 'present latitude', count(*) FILTER (c_custkey % 97 <> 0) FROM customer
UNION ALL SELECT 'booking_hotels', 'present rating', count(*) FILTER (c_custkey % 11 <> 0) FROM customer
UNION ALL SELECT 'booking_hotels', 'valid stars_range', count(*) FROM customer
UNION ALL SELECT 'booking_reviews', 'rows', count(*) FROM events
UNION ALL SELECT 'booking_reviews', 'present liked_text', count(*) FILTER (event_type IN ('purchase', 'signup')) FROM events
UNION ALL SELECT 'booking_reviews', 'valid rating_range', count(*) FROM events
UNION ALL SELECT 'tripadvisor_hotels', 'rows', count(*) FROM supplier
UNION ALL SELECT 'tripadvisor_hotels', 'present rating', count(*) FILTER (s_suppkey % 13 <> 0) FROM supplier
UNION ALL SELECT 'tripadvisor_reviews', 'rows', count(*) FROM conversations WHERE text IS NOT NULL
UNION ALL SELECT 'geospatial_attractions', 'rows', count(*) FROM part
UNION ALL SELECT 'geospatial_attractions', 'duplicate_keys', 0
UNION ALL SELECT 'unknown', 'quarantined', count(*) FROM conversations WHERE text IS NULL HAVING count(*) > 0
UNION ALL SELECT 'scrape_error', 'quarantined', count(*) FROM region HAVING count(*) > 0""")
def batch_quality(spark, sf_dir):
    """The tables of quality that a run writes, read back."""
    out = run_folder(spark, "quality")
    batch.run(spark, feed.lodging_feed(spark, sf_dir), out, settings(spark), features=False)
    table = lambda n: spark.read.parquet(f"{out}/{n}")
    complete = table("dq_completeness")
    wanted = {
        "booking_hotels": ("present latitude", "present rating", "valid stars_range"), "booking_reviews": ("present liked_text", "valid rating_range"),
        "tripadvisor_hotels": ("present rating",),
    }
    rows = complete.groupBy("dataset").agg(F.lit("rows").alias("measure"), F.max("rows").alias("value"))
    present = complete.select("dataset", F.concat(F.lit("present "), "column").alias("measure"), F.col("present").alias("value"))
    valid = table("dq_accuracy").select("dataset", F.concat(F.lit("valid "), "rule").alias("measure"), F.col("valid").alias("value"))
    some = present.unionByName(valid).filter(F.concat_ws("|", "dataset", "measure").isin([f"{d}|{m}" for d, ms in wanted.items() for m in ms]))
    twice = table("dq_uniqueness").filter("dataset = 'geospatial_attractions'").select("dataset", F.lit("duplicate_keys").alias("measure"), F.col("duplicate_keys").alias("value"))
    apart = table("quarantine").groupBy(F.col(classify.CLASS).alias("dataset")).agg(F.lit("quarantined").alias("measure"), F.count(F.lit(1)).alias("value"))
    return rows.unionByName(some).unionByName(twice).unionByName(apart)

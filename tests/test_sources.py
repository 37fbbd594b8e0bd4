"""Large arrays, schema discovery, upserts, clustered files."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgewise.operators.clean import latest_per_key
from lodgewise.operators.spatial import radius_join
from lodgewise.sources import clustered, discovery, json_arrays
from lodgewise.sources.feeds import merge_schemas, read_feed
from lodgewise.streaming import upsert

ODD = ['{', '}', '{}', '}{"a":1}', '"', '\\', '\\\\', '\\"', '\\"}', 'é}', '日本{', '🙂"}', '', ' ', '[]', '",{', 'a\nb', '\\u007d', "}" * 30]
TEXT = T.StringType()
SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("text", TEXT),
    T.StructField("deep", T.StructType([T.StructField("x", TEXT), T.StructField("more", T.ArrayType(T.StructType([T.StructField("y", TEXT)])))])),
    T.StructField("_corrupt_record", TEXT),
])


def records(n, seed=1):
    rng = random.Random(seed)
    return [
        {"id": i, "text": rng.choice(ODD) + rng.choice(ODD), "deep": {"x": rng.choice(ODD), "more": [{"y": rng.choice(ODD)} for _ in range(rng.randint(0, 3))]}}
        for i in range(n)
    ]


@pytest.fixture
def small_parts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "160")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(df):
    return sorted((json.dumps(r.asDict(True), sort_keys=True) for r in df.collect()))


@pytest.mark.parametrize("indent, ascii_", [(1, False)])
def test_arrays_equal_the_plain_reader(spark, tmp_path, small_parts, indent, ascii_):
    one, two = records(40), records(12, 2)
    (tmp_path / "a.json").write_text(json.dumps(one, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    (tmp_path / "b.json").write_text("\n".join(json.dumps(r, ensure_ascii=ascii_) for r in two), encoding="utf-8")  # no array, no line end
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "x.tmp").write_text("[{]")
    got = json_arrays.read_arrays(spark, str(tmp_path), SCHEMA)
    a = got.filter(F.col("source_file").endswith("a.json"))
    assert rows(a) == rows(read_feed(spark, str(tmp_path / "a.json"), SCHEMA))
    b = got.filter(F.col("source_file").endswith("b.json"))
    assert rows(b) == rows(read_feed(spark, str(tmp_path / "b.json"), SCHEMA, multi_line=False))
    assert got.count() == 52 and json_arrays._segments(spark, str(tmp_path), "*.json").rdd.getNumPartitions() > 20


def test_every_cut_of_a_small_array(spark, tmp_path):
    text = json.dumps([{"id": 1, "text": '}{\\"é🙂}\\\\', "deep": {"x": "{", "more": [{"y": "}"}]}}, {"id": 2, "text": "", "deep": None}], ensure_ascii=False)
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    want = rows(read_feed(spark, str(tmp_path), SCHEMA))
    try:
        for size in (5, 29, len(text.encode())):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert rows(json_arrays.read_arrays(spark, str(tmp_path), SCHEMA)) == want, size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_damaged_files_go_to_the_plain_reader(spark, tmp_path, small_parts):
    (tmp_path / "good.json").write_text(json.dumps(records(5)))
    for name, text in (("open", '[{"id": 1}, {"id": 2'), ("close", '[{"id": 1}}, {"id": 3}]'), ("text", '[{"id": 1, "text": "no end}]')):
        (tmp_path / f"{name}.json").write_text(text)
    got = json_arrays.read_arrays(spark, str(tmp_path), SCHEMA)
    assert rows(got) == rows(read_feed(spark, str(tmp_path), SCHEMA))


def test_slashes_before_quotes_over_batches():
    text = rb'{"a\\":"\"{\\\"}","b":"\\\\"}\\"{'
    whole = json_arrays._Scan().braces(np.frombuffer(text, np.uint8))
    for at in range(len(text) + 1):
        scan = json_arrays._Scan()
        one, two = (scan.braces(np.frombuffer(x, np.uint8)) for x in (text[:at], text[at:]))
        assert [*one[2], *two[2]] == [*whole[2]] and [*one[0], *(two[0] + at)] == [*whole[0]], at
    quoted, odd = [], 0
    for i, c in enumerate(text):
        before = text[:i]
        odd ^= c == 34 and (len(before) - len(before.rstrip(b"\\"))) % 2 == 0
        quoted += [odd] if c in b"{}" else []
    assert [*whole[2]] == quoted


def test_files_are_listed_without_reading_them(spark, tmp_path, small_parts):
    (tmp_path / "a.json").write_text(json.dumps(records(40)))
    plan = json_arrays.read_arrays(spark, str(tmp_path), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    # texts are read for the states at the beginning of parts, for records inside parts and for those across
    assert sum(line.endswith(" text") for line in plan.splitlines()) == 4


def test_values_that_are_no_objects_are_corrupt(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, 17, "x", {"id": 2}]')
    got = json_arrays.read_arrays(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r.id or 0, r["_corrupt_record"] is not None) for r in got) == [(0, True), (1, False), (2, False)]


# --- schema discovery -----------------------------------------------------------------------------

TEXTS = [
    '{"a": 1, "b": "x", "c": {"d": [1, 2.5, null]}, "e": null}', '{"a": 2.5, "c": {"d": [], "f": true}}', '{"a": "x", "c": 7, "e": null}',
    '{"a": null, "g": [{"h": 1}, {"h": "y", "i": {}}]}', "", None, "not json", '{"big": 123456789012345678901234567890}',
]


def counts_of(spark, texts, parts=3):
    return discovery.kind_counts(spark.createDataFrame([(t,) for t in texts], "value string").repartition(parts))


def test_schema_table(spark):
    got = {r.path: (r.type, r.rows, r.present) for r in discovery.schema_table(counts_of(spark, TEXTS)).collect()}
    assert got == {
        "": ("struct", 5, 5), "a": ("choice<bigint,double,string>", 5, 3), "b": ("string", 5, 1), "c": ("choice<bigint,struct>", 5, 3),
        "c.d": ("array", 2, 2), "c.d[]": ("choice<bigint,double>", 3, 2), "c.f": ("boolean", 2, 1), "e": ("null", 5, 0), "g": ("array", 5, 1),
        "g[]": ("struct", 2, 2), "g[].h": ("choice<bigint,string>", 2, 2), "g[].i": ("struct", 2, 1), "big": ("double", 5, 1),
    }


def test_counts_add_up_in_any_order(spark):
    whole = sorted(map(tuple, counts_of(spark, TEXTS).collect()))
    parts = [counts_of(spark, TEXTS[i::3], 1) for i in range(3)]
    assert sorted(map(tuple, discovery.added(*parts).collect())) == whole == sorted(map(tuple, discovery.added(discovery.added(parts[2], parts[0]), parts[1]).collect()))


def test_spark_type_and_reading(spark):
    counts = counts_of(spark, TEXTS)
    assert discovery.spark_type(counts).simpleString() == (
        "struct<a:struct<double:double,string:string>,b:string,big:double,"
        "c:struct<long:bigint,struct:struct<d:array<double>,f:boolean>>,e:string,g:array<struct<h:struct<long:bigint,string:string>,i:struct<>>>>"
    )
    texts = spark.createDataFrame([(t,) for t in ('{"a": 1, "n": [1, "x"]}', '{"a": 2.5, "n": []}', '{"a": "1", "n": [{"z": 3}]}', '{"a": null}')], "value string")
    got = discovery.read_discovered(texts, choices=True).select(F.to_json("a", {"ignoreNullFields": "true"}).alias("a"), F.to_json("n").alias("n")).collect()
    assert [r.a for r in got] == ['{"long":1}', '{"double":2.5}', '{"string":"1"}', None]
    assert [r.n for r in got] == ['[{"long":1},{"string":"x"}]', "[]", '[{"struct":{"z":3}}]', None]
    with pytest.raises(ValueError, match="paths"):
        discovery.spark_type(counts, most_paths=3)


def test_no_texts(spark):
    empty = counts_of(spark, [""])
    assert discovery.schema_table(empty).count() == 0 and discovery.spark_type(empty) == T.StructType()


def test_types_join_like_a_lattice(spark):
    kinds = [T.StructType.fromDDL(d) for d in ("a int", "a bigint", "a double", "a string", "a struct<b:int>", "a struct<b:string,c:int>", "a array<int>", "a array<double>", "b date")]
    plain = lambda t: sorted(json.dumps(x, sort_keys=True) for x in [json.loads(t.json())])

    def order(t):
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, order(f.dataType), True, f.metadata) for f in sorted(t.fields, key=lambda f: f.name)])
        return T.ArrayType(order(t.elementType)) if isinstance(t, T.ArrayType) else t

    for x in kinds:
        assert merge_schemas(x, x) == x
        for y in kinds:
            assert plain(order(merge_schemas(x, y))) == plain(order(merge_schemas(y, x)))
            for z in kinds:
                assert plain(order(merge_schemas(merge_schemas(x, y), z))) == plain(order(merge_schemas(x, merge_schemas(y, z)))), (x, y, z)
    assert merge_schemas(kinds[0], kinds[3])["a"].dataType.names == ["integer", "string"]


# --- upserts ----------------------------------------------------------------------------------------

def delivery(spark, rows_):
    return spark.createDataFrame(rows_, "k string, at long, row_id long, v string")


def test_three_deliveries_equal_the_latest_of_all(spark, tmp_path):
    rng, path = random.Random(4), str(tmp_path / "t")
    parts = [[(rng.choice([None, *(f"k{i}" for i in range(40))]), rng.choice([None, *range(9)]), n * 1000 + i, f"{n}-{i}") for i in range(120)] for n in range(3)]
    parts[2] += parts[0][:30]  # repeats and late rows
    frames = [delivery(spark, p) for p in parts]
    for n, df in enumerate(frames):
        upsert.upsert(df, path, ["k"], "at", "row_id", f"b{n}", buckets=8)
    everything = latest_per_key(frames[0].unionByName(frames[1]).unionByName(frames[2]).dropna(subset=["k"]), ["k"], "at", "row_id")
    want = sorted(map(tuple, everything.collect()))
    assert sorted(map(tuple, upsert.read_snapshot(spark, path).select("k", "at", "row_id", "v").collect())) == want
    assert upsert.upsert(delivery(spark, [("k1", 99, 0, "again")]), path, ["k"], "at", "row_id", "b1", buckets=8) == []
    assert sorted(map(tuple, upsert.read_snapshot(spark, path).select("k", "at", "row_id", "v").collect())) == want
    assert sorted(r.batch for r in upsert.applied(spark, path).collect()) == ["b0", "b1", "b2"]


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet") if "rows" in f.parts}


def test_other_buckets_stay_as_they_are(spark, tmp_path):
    path = tmp_path / "t"
    upsert.upsert(delivery(spark, [(f"k{i}", 1, i, "old") for i in range(200)]), str(path), ["k"], "at", "row_id", "a", buckets=16)
    before = files_of(path)
    touched = upsert.upsert(delivery(spark, [("k7", 2, 1, "new"), ("k8", 0, 2, "late")]), str(path), ["k"], "at", "row_id", "b", buckets=16)
    after = files_of(path)
    changed = {f.split("bucket=")[1].split("/")[0] for f in before.keys() ^ after.keys()}
    assert changed == {str(t) for t in touched} and 1 <= len(touched) <= 2
    assert all(after[f] == before[f] for f in before.keys() & after.keys())
    got = {r.k: r.v for r in upsert.read_snapshot(spark, str(path)).collect()}
    assert len(got) == 200 and got["k7"] == "new" and got["k8"] == "old"


def test_a_run_that_stopped_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert.upsert(delivery(spark, [("a", 1, 1, "x"), ("b", 1, 2, "x")]), path, ["k"], "at", "row_id", "1", buckets=4)
    with monkeypatch.context() as m:
        m.setattr(upsert, "_replace", lambda *_: None)  # stops before the buckets are replaced
        upsert.upsert(delivery(spark, [("a", 2, 3, "y")]), path, ["k"], "at", "row_id", "2", buckets=4)
    assert {r.k: r.v for r in upsert.read_snapshot(spark, path).collect()} == {"a": "x", "b": "x"}
    upsert.upsert(delivery(spark, [("b", 2, 4, "z")]), path, ["k"], "at", "row_id", "3", buckets=4)
    assert {r.k: r.v for r in upsert.read_snapshot(spark, path).collect()} == {"a": "y", "b": "z"}


def test_stream_of_files(spark, tmp_path):
    folder, path, mark = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "mark")
    folder.mkdir()
    stream = lambda: spark.readStream.schema("k string, at long, row_id long, v string, more string").json(str(folder))
    for n in range(3):
        (folder / f"{n}.json").write_text("\n".join(json.dumps({"k": f"k{i % 5}", "at": n, "row_id": i, "v": f"{n}-{i}"}) for i in range(10)))
        upsert.upsert_available(stream(), path, mark, ["k"], "at", "row_id", buckets=4)
    assert {r.k: r.v for r in upsert.read_snapshot(spark, path).collect()} == {f"k{i}": f"2-{i}" for i in range(5)}


# --- clustered files --------------------------------------------------------------------------------

def test_circles_read_what_a_join_finds(spark, tmp_path):
    rng = random.Random(8)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(3000)]
    spots += [(5000 + i, 89.9 - rng.random() * 0.3, rng.uniform(-180, 180)) for i in range(100)]
    spots += [(6000 + i, rng.uniform(-0.3, 0.3), rng.choice([179.9, -179.9, 180.0, -180.0, 0.0])) for i in range(200)]
    spots += [(7000, None, 1.0), (7001, float("nan"), 2.0), (7002, 10.0, None)]
    points = spark.createDataFrame(spots, "id long, latitude double, longitude double")
    path = clustered.write_clustered(points, str(tmp_path / "c"), files=8)
    assert spark.read.parquet(path).count() == len(spots)
    for lat, lon, km in ((0.0, -179.95, 800.0), (90.0, 0.0, 60.0), (89.8, -179.0, 40.0), (20.0, 20.0, 21000.0)):
        centre = spark.createDataFrame([(lat, lon)], "a double, b double")
        want = radius_join(centre, points, km, ("a", "b"), ("latitude", "longitude")).select("id", F.round("distance_km", 6))
        got = clustered.read_within(spark, path, lat, lon, km).select("id", F.round("distance_km", 6))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), (lat, lon, km)


def test_few_row_groups_are_read(spark, tmp_path):
    n = 200_000
    points = spark.range(n).select("id", (F.rand(1) * 10 - 5).alias("latitude"), (F.rand(2) * 10 + 100).alias("longitude"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    path = clustered.write_clustered(points, str(tmp_path / "c"), files=4, row_group_bytes=256 << 10)
    near = clustered.read_within(spark, path, 0.5, 104.0, 20.0)
    found = near.collect()
    plan = near._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    read = plan.metrics().apply("numOutputRows").value()
    assert 0 < len(found) <= read < n / 10
    assert "PartitionFilters: [zone" in near._jdf.queryExecution().toString().replace("isnotnull(zone#", "zone") or "zone" in plan.toString()


def test_curve_keys_interleave(spark):
    got = spark.createDataFrame([(-90.0, -180.0), (89.9999999, 179.9999999), (90.0, 0.0), (None, 0.0)], "a double, b double").select(clustered.curve_key("a", "b")).collect()
    assert [r[0] for r in got][:2] == [0, (1 << 48) - 1] and got[2][0] >> 46 == 3 and got[3][0] is None
    runs = clustered.circle_ranges(-7.8, 110.3, 5.0)
    assert 1 < len(runs) <= 64 and all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


# --- stored sketches --------------------------------------------------------------------------------

def test_merged_sketches_equal_those_of_the_whole(spark, tmp_path):
    from lodgewise.sources import sketches

    rows = spark.range(9000).select(F.col("id").cast("int").alias("a"), (F.col("id") % 70).cast("string").alias("b"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("c"), F.array("id").alias("d"))
    path = str(tmp_path / "p")
    for i in range(3):
        sketches.store(rows.filter(F.col("a") % 3 == i), f"day-{i}", path)
    sketches.store(rows.filter(F.col("a") % 3 == 1), "day-1", path)  # sent again
    parts = {r.column: r for r in sketches.merged(sketches.stored(spark, path)).collect()}
    whole = {r.column: r for r in sketches.merged(sketches.profile(rows, "all")).collect()}
    for c in "abcd":
        assert (parts[c].rows, parts[c].present, parts[c].least, parts[c].most, parts[c].type) == (whole[c].rows, whole[c].present, whole[c].least, whole[c].most, whole[c].type)
        assert abs(parts[c].distinct_estimate - whole[c].distinct_estimate) <= 0.02 * whole[c].distinct_estimate  # merging gives up one of two estimators
    assert parts["b"].distinct_estimate == 70 and parts["b"].quantiles is None and abs(parts["a"].distinct_estimate - 9000) < 270
    assert all(abs(q - p * 8999) < 180 for q, p in zip(parts["a"].quantiles, (0.25, 0.5, 0.75)))
    empty = sketches.merged(sketches.profile(rows.limit(0), "none")).collect()
    assert len(empty) == 4 and all(r.rows == 0 and r.quantiles is None for r in empty)

"""Profiles kept as sketches per delivery, so that a new one is profiled alone and the table by merging."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
SCHEMA = "delivery string, column string, type string, rows bigint, present bigint, distinct_sketch binary, value_sketch binary, least double, most double"


def _measures(f: T.StructField, accuracy: int, depth: int) -> Column:
    value = F.col(f"`{f.name}`")
    number = value.cast("double") if isinstance(f.dataType, _NUMBERS) else F.lit(None).cast("double")
    finite = F.when(~F.isnan(number), number)
    text = value.cast("string") if isinstance(f.dataType, T.AtomicType) else F.to_json(value)
    return F.struct(
        F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.lit(1)).alias("rows"), F.count(value).alias("present"),
        F.hll_sketch_agg(text, accuracy).alias("distinct_sketch"), F.call_function("kll_sketch_agg_double", finite, F.lit(depth)).alias("value_sketch"),
        F.min(finite).alias("least"), F.max(finite).alias("most"),
    )


def profile(df: DataFrame, delivery: str, accuracy: int = 14, depth: int = 400) -> DataFrame:
    """A row per column with counts and sketches: of distinct values (2^accuracy registers) and of numbers (`depth` sets
    how near quantiles are). One pass; nothing but sketches leaves a task."""
    fields = df.schema.fields
    measured = df.agg(*[_measures(f, accuracy, depth).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = measured.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(fields))])).alias("c"))
    return rows.select(F.lit(delivery).alias("delivery"), "c.*")


def store(df: DataFrame, delivery: str, path: str, **options) -> None:
    """Profile a delivery and keep the result below `path`; the same delivery again replaces its own."""
    writer = profile(df, delivery, **options).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("delivery").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merged(profiles: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """(column, type, rows, present, distinct_estimate, least, most, quantiles) of all deliveries together, without a look
    at their rows. A column of several types has the name of each."""
    both = profiles.groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("type"), F.sum("rows").alias("rows"), F.sum("present").alias("present"),
        F.hll_union_agg("distinct_sketch", F.lit(True)).alias("d"), F.call_function("kll_merge_agg_double", F.col("value_sketch")).alias("v"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )
    points = F.array(*[F.lit(float(q)) for q in quantiles])
    return both.select(
        "column", "type", "rows", "present", F.hll_sketch_estimate("d").alias("distinct_estimate"), "least", "most",
        F.when(F.col("least").isNotNull(), F.call_function("kll_sketch_get_quantile_double", F.col("v"), points)).alias("quantiles"),
    )

"""Deliveries merged into a table that keeps the latest row per key.

The table is cut into buckets by a hash of the key, one folder each. A delivery rewrites the buckets its keys fall into and
leaves the others as they are. New contents are written beside the table first; only a complete set replaces the old
buckets, and a run that stopped in between is finished by the next one.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lodgewise.operators.clean import latest_per_key

BUCKET = "bucket"
_LOG = T.StructType([T.StructField("batch", T.StringType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])


def bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or nothing where none has been written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if files.exists(folder) and any(not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(folder)) else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every key."""
    rows = _read(spark, f"{path}/rows")
    if rows is None:
        raise ValueError(f"nothing has been delivered to {path}")
    return rows.drop(BUCKET)


def applied(spark: SparkSession, path: str) -> DataFrame:
    """(batch, buckets) of every delivery the table holds."""
    log = _read(spark, f"{path}/log")
    return spark.createDataFrame([], _LOG) if log is None else log


def _replace(spark: SparkSession, path: str) -> None:
    """Put what lies complete beside the table in the place of the buckets it names, then note the delivery."""
    noted = _read(spark, f"{path}/staged-log")
    if noted is None:
        return
    (batch,) = noted.collect()
    if applied(spark, path).filter(F.col("batch") == batch.batch).isEmpty():
        staged = _read(spark, f"{path}/staged-{batch.batch}")
        if staged is not None:
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{path}/rows")
        noted.coalesce(1).write.mode("append").parquet(f"{path}/log")
    for done in ("staged-log", f"staged-{batch.batch}"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{done}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def upsert(delivery: DataFrame, path: str, keys, latest: str, tie: str, batch: str, buckets: int = 64) -> list[int]:
    """Merge a delivery into the table at `path` and give the buckets that were rewritten.

    Of the rows of a key, in the table and the delivery, that with the newest `latest` stays (ties: the smallest `tie`), so
    late rows lose and repeated ones change nothing. Rows without a key are not taken. A `batch` that the table
    holds already is not merged again. New columns are added, null in older rows. One run at a time per table.
    """
    spark, keys = delivery.sparkSession, list(keys)
    _replace(spark, path)
    if not applied(spark, path).filter(F.col("batch") == batch).isEmpty():
        return []
    fresh = latest_per_key(delivery.dropna(subset=keys), keys, latest, tie).withColumn(BUCKET, bucket_of(keys, buckets))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most one row per bucket
    before = _read(spark, f"{path}/rows")
    if before is not None:
        held = before.filter(F.col(BUCKET).isin(touched))  # the other folders are not opened
        fresh = latest_per_key(held.unionByName(fresh, allowMissingColumns=True), keys, latest, tie)
    if touched:
        fresh.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/staged-{batch}")
    # this small file says that the buckets above are complete
    spark.createDataFrame([(batch, touched)], _LOG).coalesce(1).write.mode("overwrite").parquet(f"{path}/staged-log")
    _replace(spark, path)
    return touched


def upsert_available(rows: DataFrame, path: str, bookmark: str, keys, latest: str, tie: str, buckets: int = 64, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge what is new in a stream of files, remember it under `bookmark`, and stop. A batch that is tried again after a
    failure is recognised by its number and merged once."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(transform(batch) if transform else batch, path, keys, latest, tie, f"stream-{number}", buckets)

    rows.writeStream.foreachBatch(merge).option("checkpointLocation", bookmark).trigger(availableNow=True).start().awaitTermination()

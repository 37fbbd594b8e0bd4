"""From landed files or a one-column table to one row per record."""

from pyspark.sql import DataFrame, functions as F


def explode_records(df: DataFrame, column: str = "array", source: str | None = None, expand: bool = True) -> DataFrame:
    """One row per element of an array column, with a stable `row_id` made of source and position.

    A frame without the column is already flat: it keeps its rows, and gets a `row_id` from
    their content unless it has one.
    """
    if column not in df.columns:
        return df if "row_id" in df.columns else with_content_id(df, source)
    lineage = [F.col(source)] if source else []
    keep = [F.col(c) for c in df.columns if c != column]
    rows = df.select(*keep, F.posexplode(column).alias("_pos", "_record"))
    rows = rows.withColumn("row_id", F.xxhash64(*lineage, "_pos"))
    if expand:
        return rows.select("row_id", *keep, "_record.*")
    return rows.select("row_id", *keep, F.col("_pos").alias("position"), F.col("_record").alias("record"))


def with_content_id(df: DataFrame, source: str | None = None) -> DataFrame:
    """A `row_id` that is the same on every run: hash of the source path and the record's JSON text.

    Two identical records of one file share it, which no later step can tell apart anyway.
    """
    lineage = [F.col(source)] if source else []
    body = F.to_json(F.struct(*[c for c in df.columns if c != source]))
    return df.withColumn("row_id", F.xxhash64(*lineage, body))

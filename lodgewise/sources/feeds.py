"""JSON feeds and catalog tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lodgewise.functions.casts import choice_double
from lodgewise.operators.records import explode_records, with_content_id
from lodgewise.schema import CORRUPT, raw_schema
from lodgewise.sources.discovery import joined_types

# Objects that are never data.
JUNK = ("*.tmp", "*.log", "*_$folder$")
LINEAGE = ("source_file", "source_bytes")


def without_junk(df: DataFrame, path: str = "source_file", patterns=JUNK) -> DataFrame:
    """Drop rows that come from files matching any of the patterns (`*` stands for anything)."""
    keep = F.lit(True)
    for p in patterns:
        parts = [r"\Q" + part + r"\E" if part else "" for part in p.split("*")]
        keep = keep & ~F.col(path).rlike("^" + ".*".join(parts) + "$")
    return df.filter(keep)


def read_feed(spark: SparkSession, path, schema: T.StructType | None = None, multi_line: bool = True, pattern: str = "*.json") -> DataFrame:
    """One row per record of the JSON files in a folder, with source file and a stable `row_id`.

    A JSON array over many lines is parsed by one task per file; `json_arrays.read_arrays` gives the same rows from
    large files, and `multi_line=False` reads one record per line. Text that is not a record is kept in
    `_corrupt_record`.
    """
    schema = schema or raw_schema()
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("pathGlobFilter", pattern)
    if CORRUPT in schema.names:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.json(path).select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("source_bytes")
    )
    return with_content_id(without_junk(rows), "source_file")


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    """A column in the type of the raw schema: choice structs become numbers, structs of free keys become maps."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    own, column = df.schema[field.name].dataType, F.col(f"`{field.name}`")
    if own == field.dataType:
        return column
    if isinstance(own, T.StructType) and isinstance(field.dataType, T.NumericType):
        return choice_double(column, [b.name for b in own.fields]).try_cast(field.dataType).alias(field.name)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        text = column if isinstance(own, T.StringType) else F.to_json(column)
        return F.from_json(text, field.dataType).alias(field.name)
    plain = F.to_json(column) if isinstance(own, (T.StructType, T.ArrayType, T.MapType)) else column
    return plain.try_cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """All fields of the raw schema in their types, null where the table lacks them; its other columns stay."""
    fields = (schema or raw_schema(keep_corrupt=False)).fields
    names = {f.name for f in fields}
    return df.select(*[_conformed(df, f) for f in fields], *[c for c in df.columns if c not in names])


def read_catalog_table(spark: SparkSession, name: str, column: str = "array") -> DataFrame:
    """Records of a catalog table in the raw schema; a table of one array column becomes one row per element.

    `row_id` comes from the file, the row in it and the place in the array; where the table's format does not tell
    these, from the content.
    """
    table = spark.table(name)
    if column not in table.columns:
        return conform(with_content_id(table) if "row_id" not in table.columns else table)
    try:
        rows = table.select(column, F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("source_file"))
    except AnalysisException:
        rows = table.select(column, F.sha2(F.to_json(F.struct(column)), 256).alias("source_file"))
    return conform(explode_records(rows, column, "source_file"))


def infer_feed_schema(spark: SparkSession, paths, multi_line: bool = True, sampling: float = 1.0) -> T.StructType:
    """One schema for all files: every field of any of them, in its widest type."""
    reader = spark.read.option("multiLine", multi_line).option("samplingRatio", sampling).option("pathGlobFilter", "*.json")
    return reader.json(paths).schema


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old fields, with the new ones added at the end, nested ones too; a field of two types gets the wider number or
    a choice of both."""
    return joined_types(old, new)

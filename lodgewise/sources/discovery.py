"""Schema discovery as an aggregate: which kinds of value stand at which path, counted, in any number of partial sums.

Kinds form a lattice: nothing below null, null below every kind, `bigint` below `double`, and above kinds that differ
stands the choice of them. Joining is associative, commutative and idempotent, so counts of files, days or deliveries can
be added in any order and kept for later.
"""

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

#: Kinds of value, in the order in which a choice names them.
KINDS = ("boolean", "bigint", "double", "string", "struct", "array")
NULL, BROKEN = "null", "broken"
_FLUSH = 100_000  # paths and kinds a task holds before it hands on its sums
_SIMPLE = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def _fold(value, path: str, seen: Counter) -> None:
    if value is None:
        seen[path, NULL] += 1
    elif isinstance(value, bool):
        seen[path, "boolean"] += 1
    elif isinstance(value, int):
        seen[path, "bigint" if -(1 << 63) <= value < 1 << 63 else "double"] += 1
    elif isinstance(value, float):
        seen[path, "double"] += 1
    elif isinstance(value, str):
        seen[path, "string"] += 1
    elif isinstance(value, list):
        seen[path, "array"] += 1
        for v in value:
            _fold(v, f"{path}[]", seen)
    else:
        seen[path, "struct"] += 1
        for name, v in value.items():
            _fold(v, f"{path}.{name}" if path else name, seen)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(seen)
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([seen[k] for k in keys], pa.int64())], ["path", "kind", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text is None or not text.strip():
                continue
            try:
                value = json.loads(text)
            except ValueError:
                seen["", BROKEN] += 1
                continue
            _fold(value, "", seen)
            if len(seen) > _FLUSH:
                yield out()
                seen.clear()
    if seen:
        yield out()


def kind_counts(texts: DataFrame, column: str = "value") -> DataFrame:
    """(path, kind, n) over a column of JSON texts: each task adds up its own, sums of tasks are added by path.

    `a.b` is a field of a struct, `a[]` an element of an array, the empty path the record. Empty texts hold nothing;
    texts that are not JSON count as `broken` records.
    """
    return added(texts.select(F.col(column).cast("string")).mapInArrow(_counted, "path string, kind string, n long"))


def added(*counts: DataFrame) -> DataFrame:
    """Counts of several sources as one."""
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy("path", "kind").agg(F.sum("n").alias("n"))


def _named(kinds):
    """The join of the kinds at a path: null, one kind, or a choice of kinds in the order of KINDS."""
    real = F.filter(F.array(*[F.lit(k) for k in KINDS]), lambda k: F.array_contains(kinds, k))
    choice = F.concat(F.lit("choice<"), F.array_join(real, ","), F.lit(">"))
    return F.when(F.size(real) == 0, F.lit(NULL)).when(F.size(real) == 1, real[0]).otherwise(choice)


def schema_table(counts: DataFrame) -> DataFrame:
    """(path, type, rows, present): `rows` counts the structs that could hold the field (for `a[]`, the elements), and
    `present` the values that are not null. Broken records are left out."""
    good = counts.filter(F.col("kind") != BROKEN)
    known = good.groupBy("path").agg(F.collect_set("kind").alias("kinds"), F.sum("n").alias("seen"), F.sum(F.when(F.col("kind") != NULL, F.col("n")).otherwise(0)).alias("present"))
    parent = F.when(F.col("path").endswith("[]"), F.lit(None)).otherwise(F.regexp_replace("path", r"(^|\.)[^.]*$", ""))
    structs = good.filter("kind = 'struct'").select(F.col("path").alias("_parent"), F.col("n").alias("_structs"))
    rows = known.withColumn("_of", F.when(F.col("path") != "", parent)).join(structs, F.col("_of") == F.col("_parent"), "left")
    return rows.select("path", _named(F.col("kinds")).alias("type"), F.coalesce("_structs", "seen").alias("rows"), "present")


def _joined(kinds: set[str], inner: dict[str, T.DataType], choices: bool) -> T.DataType:
    """The Spark type for the kinds at a path."""
    real = [k for k in KINDS if k in kinds]
    if not choices and "double" in real:
        real = [k for k in real if k != "bigint"]
    types = [_SIMPLE.get(k) or inner[k] for k in real]
    if not real:
        return T.StringType()  # nothing but nulls: text can hold whatever comes later
    if len(real) == 1:
        return types[0]
    return _choice_of({t.typeName(): t for t in types})


def _choice_of(branches: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"choice": True}) for n, t in branches.items()])


def is_choice(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and bool(kind.names) and all(f.metadata.get("choice") for f in kind.fields)


def spark_type(counts: DataFrame, choices: bool = False, most_paths: int = 100_000) -> T.StructType:
    """The schema as a Spark type. Whole and broken numbers widen to double, unless `choices` keeps them apart; kinds that
    no single type holds become a struct with a field per kind.

    A schema belongs to the driver: more than `most_paths` paths (free keys that should be a map) are an error.
    """
    rows = counts.filter(F.col("kind") != BROKEN).groupBy("path").agg(F.collect_set("kind").alias("kinds")).limit(most_paths + 1).collect()
    if len(rows) > most_paths:
        raise ValueError(f"more than {most_paths} paths: free keys are no fields")
    kinds = {r.path: set(r.kinds) for r in rows}
    children: dict[str, list[str]] = {}
    for path in sorted(kinds):
        if path and not path.endswith("[]"):
            children.setdefault(path.rpartition(".")[0], []).append(path)

    def at(path: str) -> T.DataType:
        inner = {}
        if "struct" in kinds[path]:
            inner["struct"] = T.StructType([T.StructField(p.rpartition(".")[2], at(p)) for p in children.get(path, [])])
        if "array" in kinds[path]:
            inner["array"] = T.ArrayType(at(f"{path}[]") if f"{path}[]" in kinds else T.StringType())
        return _joined(kinds[path], inner, choices)

    found = at("") if "" in kinds else T.StructType()
    return found if isinstance(found, T.StructType) else T.StructType([T.StructField("value", found)])


def joined_types(old: T.DataType, new: T.DataType) -> T.DataType:
    """The least type that holds both: fields of both structs, the wider number, else a choice of the two."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType) and not (is_choice(old) or is_choice(new)):
        later = {f.name: f for f in new.fields}
        own = [T.StructField(f.name, joined_types(f.dataType, later[f.name].dataType), True, f.metadata) if f.name in later else f for f in old.fields]
        return T.StructType([*own, *(f for f in new.fields if f.name not in old.names)])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(joined_types(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(joined_types(old.keyType, new.keyType), joined_types(old.valueType, new.valueType))
    if type(old) in _NUMBERS and type(new) in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(type(old)), _NUMBERS.index(type(new)))]()
    branches: dict[str, T.DataType] = {}
    for t in (old, new):
        for kind in [f.dataType for f in t.fields] if is_choice(t) else [t]:
            name = next((n for n, b in branches.items() if _mix(b, kind)), kind.typeName())
            kind = joined_types(branches.pop(name), kind) if name in branches else kind
            branches[kind.typeName()] = kind
    return _choice_of(branches)


#: Numbers, each holding those before it. What a double can't tell apart of a very large whole number is lost.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def _mix(a: T.DataType, b: T.DataType) -> bool:
    """Whether one branch of a choice can hold both."""
    return type(a) is type(b) and not isinstance(a, T.DecimalType) or type(a) in _NUMBERS and type(b) in _NUMBERS


def _open_choices(kind: T.DataType) -> T.DataType:
    """The type to parse with: choices as variants, which keep what the text said."""
    if is_choice(kind):
        return T.VariantType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _open_choices(f.dataType)) for f in kind.fields])
    return T.ArrayType(_open_choices(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


# How Spark names the kinds of a variant, by the name of the branch that takes them.
_VARIANTS = {"boolean": "BOOLEAN", "long": "BIGINT", "double": "DECIMAL|DOUBLE|FLOAT", "string": "STRING", "struct": "OBJECT", "array": "ARRAY"}


def _filled(column: Column, kind: T.DataType) -> Column:
    """A parsed column in its final type: of a choice, the branch that fits is filled."""
    if is_choice(kind):
        found = F.schema_of_variant(column)

        def branch(f: T.StructField) -> Column:
            value = F.variant_get(column, "$", _open_choices(f.dataType).simpleString())
            return F.when(found.rlike(f"^({_VARIANTS[f.name]})"), _filled(value, f.dataType)).alias(f.name)

        return F.when(column.isNotNull() & (found != "VOID"), F.struct(*[branch(f) for f in kind.fields]))
    if _open_choices(kind) == kind:
        return column
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _filled(x, kind.elementType))
    return F.when(column.isNotNull(), F.struct(*[_filled(column[f.name], f.dataType).alias(f.name) for f in kind.fields]))


def read_discovered(texts: DataFrame, column: str = "value", choices: bool = False) -> DataFrame:
    """JSON texts in the schema found in them. Of a choice, the field of the kind that a value has is filled."""
    schema = spark_type(kind_counts(texts, column), choices)
    rows = texts.select(F.from_json(column, _open_choices(schema)).alias("_r"))
    return rows.select(*[_filled(F.col("_r")[f.name], f.dataType).alias(f.name) for f in schema.fields])

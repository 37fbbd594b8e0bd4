"""Lenient casts: text that does not fit the type becomes null instead of an error."""

from pyspark.sql import Column, functions as F

from lodgewise.schema import ADDRESS_DDL


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    return _col(c).try_cast("double")


def to_int(c) -> Column:
    """Integer by way of double, so "3.0" reads as 3."""
    return _col(c).try_cast("double").try_cast("int")


def to_bool(c) -> Column:
    return _col(c).try_cast("boolean")


def to_date(c) -> Column:
    """Date from `2025-02-11` as well as from `2025-02-11T21:40:05.000Z`."""
    return _col(c).try_cast("date")


def choice_double(c, branches=("double", "int")) -> Column:
    """The value of a choice struct, whichever branch holds it."""
    return F.coalesce(*[_col(c)[b].try_cast("double") for b in branches])


def size_or_zero(c) -> Column:
    return F.when(_col(c).isNotNull(), F.size(_col(c))).otherwise(F.lit(0))


def address_part(field: str, c="address") -> Column:
    """A field of an address that arrived as JSON text; null for a plain-text address."""
    text = _col(c)
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, ADDRESS_DDL)[field])


def known_fraction(columns) -> Column:
    """Share of the given columns that is not null."""
    columns = list(columns)
    filled = " + ".join(f"CAST(`{c}` IS NOT NULL AS INT)" for c in columns)
    return F.expr(f"({filled}) / {float(len(columns))}D")

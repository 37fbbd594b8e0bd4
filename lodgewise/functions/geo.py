"""Great-circle distance and the grid cells used to join on it."""

import math

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_KM = 6371.0
# Room for rounding in the cell search, about 0.6 m; it only adds candidates.
_SLACK_RADIANS = 1e-7


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = F.sin((p2 - p1) / F.lit(2.0))
    dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / F.lit(2.0))
    a = dlat * dlat + F.cos(p1) * F.cos(p2) * dlon * dlon
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def has_position(lat, lon) -> Column:
    """Both coordinates present and finite."""
    return (F.abs(lat) < F.lit(1e9)) & (F.abs(lon) < F.lit(1e9))


def on_globe(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same point with latitude in [-90, 90] and longitude counted from 0 to 360."""
    rad = F.radians(lat)
    inside = F.abs(lat) <= F.lit(90.0)
    folded_lat = F.when(inside, lat).otherwise(F.degrees(F.asin(F.sin(rad))))
    folded_lon = F.when(inside | (F.cos(rad) >= F.lit(0.0)), lon).otherwise(lon + F.lit(180.0))
    return folded_lat, F.pmod(folded_lon + F.lit(180.0), F.lit(360.0))


def _floor(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def _row_of(lat: Column, step: float) -> Column:
    top = math.floor(180.0 / step)
    return F.least(F.lit(top), F.greatest(F.lit(0), _floor((lat + F.lit(90.0)) / F.lit(step))))


def _columns_in(row: Column, step: float) -> Column:
    """Cells in a row of the grid: they tile the circle evenly and none is narrower than the step."""
    south = row * F.lit(step) - F.lit(90.0)
    widest = F.least(F.lit(90.0), F.greatest(F.abs(south), F.abs(south + F.lit(step))))
    return F.greatest(F.lit(1), _floor(F.lit(360.0 / step) * F.cos(F.radians(widest))))


def _cell_id(row: Column, column: Column) -> Column:
    return row * F.lit(1 << 32) + column


def grid_step(radius_km: float) -> float:
    return min(180.0, math.degrees(radius_km / EARTH_RADIUS_KM + _SLACK_RADIANS))


def cell_of(lat, lon, step: float) -> Column:
    """The grid cell that holds a point."""
    flat, flon = on_globe(F.col(lat) if isinstance(lat, str) else lat, F.col(lon) if isinstance(lon, str) else lon)
    row = _row_of(flat, step)
    n = _columns_in(row, step)
    return _cell_id(row, F.least(n - 1, _floor(flon * n / F.lit(360.0))))


def with_cells_within(df: DataFrame, lat: str, lon: str, radius_km: float, name: str) -> DataFrame:
    """One row per grid cell of `grid_step(radius_km)` that can hold a point within the radius.

    Covers the cells over the date line and around the poles; no cell comes twice for a row.
    """
    step, reach = grid_step(radius_km), radius_km / EARTH_RADIUS_KM + _SLACK_RADIANS
    flat, flon = on_globe(F.col(lat), F.col(lon))
    spans_pole = F.abs(flat) + F.lit(math.degrees(reach)) >= F.lit(90.0)
    # Widest difference in longitude on a circle around a point that does not hold a pole.
    widest = F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(reach, math.pi / 2))) / F.cos(F.radians(flat))))
    half = F.when(spans_pole, F.lit(360.0)).otherwise(F.degrees(widest) + F.lit(math.degrees(_SLACK_RADIANS)))
    rows = df.withColumns({"_flon": flon, "_half": half, "_row0": _row_of(flat, step)})
    rows = rows.select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_up"))
    rows = rows.withColumn("_row", F.col("_row0") + F.col("_up"))
    rows = rows.filter(F.col("_row").between(0, math.floor(180.0 / step))).withColumn("_n", _columns_in(F.col("_row"), step))
    n, around = F.col("_n"), F.col("_half") * F.lit(2.0) + F.lit(360.0) / F.col("_n") >= F.lit(360.0)
    first = F.when(around, F.lit(0)).otherwise(_floor((F.col("_flon") - F.col("_half")) * n / F.lit(360.0)))
    last = F.when(around, n - 1).otherwise(_floor((F.col("_flon") + F.col("_half")) * n / F.lit(360.0)))
    rows = rows.withColumn("_column", F.explode(F.sequence(first, last)))
    return rows.select(*df.columns, _cell_id(F.col("_row"), F.pmod("_column", n)).alias(name))


def unit_vector(lat, lon) -> list[Column]:
    """The point on a sphere of radius 1; straight distances between such points are cheap to compare."""
    p, m = F.radians(lat), F.radians(lon)
    return [F.cos(p) * F.cos(m), F.cos(p) * F.sin(m), F.sin(p)]


def chord(a, b) -> Column:
    return F.sqrt(chord_squared(a, b))


def chord_squared(a, b) -> Column:
    dx, dy, dz = (u - v for u, v in zip(a, b))
    return dx * dx + dy * dy + dz * dz


def chord_of_km(km: float) -> float:
    """Straight distance, on the sphere of radius 1, between points that many kilometres apart."""
    return 2.0 * math.sin(min(km / (2.0 * EARTH_RADIUS_KM), math.pi / 2.0))

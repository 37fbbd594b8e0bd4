"""Points stored along a curve that keeps neighbours together, so that a circle reads few of the rows.

A cell of a grid over the globe gets a number whose bits come from its row and its column in turn. Squares of the grid
are then runs of numbers, a circle is a few runs, and files sorted by the number are skipped by their statistics.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgewise.functions.geo import EARTH_RADIUS_KM, has_position, haversine_km, on_globe

CURVE, ZONE = "curve", "zone"
_BITS = 24  # of each axis
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(value: Column) -> Column:
    """The bits of a number with a free place between any two."""
    for by, mask in _SPREAD:
        value = F.shiftleft(value, by).bitwiseOR(value).bitwiseAND(F.lit(mask))
    return value


def curve_key(lat, lon) -> Column:
    """The number of the cell of a point; null without a position. Longitudes count round the globe."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    cells = 1 << _BITS
    flat, flon = on_globe(lat, lon)
    y, x = F.floor((flat + 90.0) / 180.0 * F.lit(float(cells))), F.floor(flon / 360.0 * F.lit(float(cells)))
    inside = [F.greatest(F.lit(0), F.least(F.lit(cells - 1), v.cast("long"))) for v in (y, x)]
    return F.when(has_position(lat, lon), F.shiftleft(_spread(inside[0]), 1).bitwiseOR(_spread(inside[1])))


def write_clustered(df: DataFrame, path: str, at=("latitude", "longitude"), files: int | None = None, zone_bits: int = 4, row_group_bytes: int = 8 << 20) -> str:
    """Write points with their `curve` number, in ranges of it, sorted, below folders of `zone` (its first bits per axis).

    A crowded place is cut into as many files as its rows need, since ranges follow the rows and not the map. Rows without
    a position are kept in a zone of their own.
    """
    shift = 2 * (_BITS - zone_bits)
    keyed = df.withColumn(CURVE, curve_key(*at)).withColumn(ZONE, F.coalesce(F.shiftright(CURVE, shift), F.lit(-1)).cast("int"))
    spread = [F.col(ZONE), F.col(CURVE)]
    ranged = keyed.repartitionByRange(files, *spread) if files else keyed.repartitionByRange(*spread)
    ranged.sortWithinPartitions(ZONE, CURVE).write.mode("overwrite").option("parquet.block.size", row_group_bytes).partitionBy(ZONE).parquet(path)
    return path


def _touches(box: tuple[int, int, int], lat: float, lon: float, radius_km: float) -> bool:
    """Whether a square (level, row, column) may hold points of a circle."""
    level, row, column = box
    high, wide = 180.0 / (1 << level), 360.0 / (1 << level)
    south, west = row * high - 90.0, column * wide - 180.0
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) + 1e-6
    if south > lat + reach or south + high < lat - reach:
        return False
    if abs(lat) + reach >= 90.0:
        return True  # the circle holds a pole: every longitude
    half = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(lat))))) + 1e-6
    gap = (west - (lon - half)) % 360.0
    return gap <= 2 * half or gap + wide >= 360.0


def circle_ranges(lat: float, lon: float, radius_km: float, most: int = 64) -> list[tuple[int, int]]:
    """Runs of curve numbers (first, last) that hold every point of a circle; at most `most`, the finer the better."""
    squares = [(0, 0, 0)]
    for level in range(1, _BITS + 1):
        finer = [(level, 2 * r + i, 2 * c + j) for _, r, c in squares for i in (0, 1) for j in (0, 1)]
        finer = [b for b in finer if _touches(b, lat, lon, radius_km)]
        if len(_runs(finer)) > most:
            break
        squares = finer
        if math.radians(180.0 / (1 << level)) * EARTH_RADIUS_KM < radius_km / 16:
            break  # finer squares would follow the outline and save little
    return _runs(squares)


def _runs(squares: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for level, row, column in squares:
        number = sum((row >> i & 1) << (2 * i + 1) | (column >> i & 1) << (2 * i) for i in range(level))
        size = 1 << 2 * (_BITS - level)
        out.append((number * size, (number + 1) * size - 1))
    merged: list[tuple[int, int]] = []
    for first, last in sorted(out):
        if merged and first == merged[-1][1] + 1:
            merged[-1] = merged[-1][0], last
        else:
            merged.append((first, last))
    return merged


def read_within(spark: SparkSession, path: str, lat: float, lon: float, radius_km: float, at=("latitude", "longitude"),
                distance: str = "distance_km", zone_bits: int = 4, most: int = 64) -> DataFrame:
    """The stored points within a distance of a place (inclusive), with that distance.

    Folders outside the circle are never opened; of the others, the runs of the circle are pushed down to the
    statistics of row groups and pages. The exact distance decides.
    """
    runs, shift = circle_ranges(lat, lon, radius_km, most), 2 * (_BITS - zone_bits)
    zones = sorted({z for first, last in runs for z in range(first >> shift, (last >> shift) + 1)})
    stored = spark.read.parquet(path)
    wanted = F.lit(False)
    for first, last in runs:
        wanted = wanted | F.col(CURVE).between(first, last)
    near = stored.filter(F.col(ZONE).isin(zones)).filter(wanted)
    km = haversine_km(F.col(at[0]), F.col(at[1]), F.lit(float(lat)), F.lit(float(lon)))
    return near.drop(CURVE, ZONE).withColumn(distance, km).filter(F.col(distance) <= F.lit(float(radius_km)))


def read_around(spark: SparkSession, path: str, places: dict[str, tuple[float, float]], radius_km: float, name: str = "place", **options) -> DataFrame:
    """`read_within` for a few named places; a point within reach of several comes once for each."""
    out = None
    for label, (lat, lon) in places.items():
        rows = read_within(spark, path, lat, lon, radius_km, **options).withColumn(name, F.lit(label))
        out = rows if out is None else out.unionByName(rows)
    return out

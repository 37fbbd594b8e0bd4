"""Joins, counts and nearest neighbours by great-circle distance.

`radius_join` gives pairs. `count_within` and `nearest` never form the pairs: they walk down a tree
of grid nodes over the distinct target positions and open only the nodes that are cut by the circle.
The positions of an opened node meet its spots in one task (`leaves`), which again tests them one by
one only at the circle's outline, so a crowded spot costs its outline and not its area.
"""

import functools
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodgewise.functions.geo import (
    cell_of, chord, chord_of_km, chord_squared, grid_step, has_position, haversine_km, unit_vector, with_cells_within,
)
from lodgewise.operators.crowds import cell_totals
from lodgewise.operators.leaves import count_leaf, nearest_leaf
from lodgewise.operators.skew import evenly, few_rows, meet, split_hot_keys, tasks
from lodgewise.session import cut

COORDINATES = ("latitude", "longitude")
# Slack for straight distances on the unit sphere, about 6 mm on the ground; it only adds candidates.
_ROUNDING = 1e-9


def standard_points(df: DataFrame, columns: dict[str, str], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rename to a common shape and keep rows with both coordinates; `columns` maps output to input names."""
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()]).dropna(subset=[lat, lon])


def union_all(frames) -> DataFrame:
    """All rows of all frames, duplicates kept, matched by column name."""
    return functools.reduce(DataFrame.unionByName, list(frames))


_BLOCK_ROWS, _BLOCK_PAIRS = 100_000, 1_000_000_000  # of a cell: right rows a task holds, pairs it goes through


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    left_at=COORDINATES,
    right_at=("attr_latitude", "attr_longitude"),
    inclusive: bool = True,
    distance: str = "distance_km",
    condition: Column | None = None,
    pieces: tuple[str, str] | tuple[Column, Column] | None = None,
    totals: tuple[tuple[str, ...], tuple[str, ...]] | None = None,
    keep: Callable | None = None,
) -> DataFrame:
    """All pairs within a distance, as an equi-join on grid cells and an exact filter.

    Each right row is in one cell and each left row names every cell it can reach once, so a pair
    meets once. Cells with many rows on either side are split into blocks. `pieces` names an array
    on each side: only rows that share an element meet, once for each they share. `totals` names
    columns of each side: per values of them, the number of pairs (`pairs`) and the sum of their
    distances come out in place of the pairs, which crowded cells then go through in numpy. `keep`
    chooses pairs of a crowded cell: given the tables of both sides it gives the row numbers of the
    pairs that go on, and of the others none need to; cells whose rows share few pieces are joined
    by these. `pieces` that are expressions leave much: they are worked out for other cells only.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    if totals:
        if condition is not None or pieces:
            raise ValueError("totals are of all pairs")
        left = left.select(*totals[0], *[F.col(c).alias(n) for c, n in zip(left_at, ("_lat", "_lon"))])
        right = right.select(*totals[1], *[F.col(c).alias(n) for c, n in zip(right_at, ("_attr_lat", "_attr_lon"))])
        left_at, right_at = ("_lat", "_lon"), ("_attr_lat", "_attr_lon")
    step = grid_step(radius_km)
    a = left.filter(has_position(F.col(left_at[0]), F.col(left_at[1])))
    a = with_cells_within(_with_vector(a, left_at, "_a"), *left_at, radius_km, "_cell")
    b = right.filter(has_position(F.col(right_at[0]), F.col(right_at[1])))
    b = _with_vector(b, right_at, "_b").withColumn("_cell", cell_of(*right_at, step))
    parts, made = [], [p for p in pieces or () if isinstance(p, str)]
    if keep and not (made and _RARE * _met_pairs(*_by_piece(a, b, pieces)) < _met_pairs(a, b)):
        (a, b), crowded = _crowds_apart(a, b)
        parts = [_crowd_pairs(*(df.drop(*made) for df in crowded), left.columns, right.columns, keep)]
    if pieces:
        a, b = _by_piece(a, b, pieces)
        a, b = (a, b) if made else (cut(a), cut(b))  # read twice
    if totals:
        (a, b), crowded = _crowds_apart(a, b)
        parts = [_crowd_totals(*crowded, radius_km, inclusive, totals)]
    # Pairs that cost more than their distance go in small blocks to more tasks.
    a, b, keys = split_hot_keys(a, b, "_cell") if condition is not None else split_hot_keys(a, b, "_cell", _BLOCK_ROWS, _BLOCK_PAIRS)
    d = haversine_km(F.col(left_at[0]), F.col(left_at[1]), F.col(right_at[0]), F.col(right_at[1]))
    # The straight distance is cheap and leaves few pairs to the exact formula.
    pairs = meet(a, b, keys).filter(chord_squared(_vector("_a"), _vector("_b")) <= (chord_of_km(radius_km) + _ROUNDING) ** 2)
    if condition is not None:
        pairs = pairs.filter(condition)
    pairs = pairs.withColumn(distance, d)
    near = F.col(distance) <= F.lit(float(radius_km)) if inclusive else F.col(distance) < F.lit(float(radius_km))
    if totals:
        own = [*totals[0], *totals[1]]
        parts.append(pairs.filter(near).groupBy(*own).agg(F.count(F.lit(1)).alias("_pairs"), F.sum(distance).alias("_km")))
        return union_all(parts).groupBy(*own).agg(F.sum("_pairs").alias("pairs"), F.sum("_km").alias(distance))
    columns = [c for c in (*left.columns, *right.columns) if c not in made]
    return union_all(df.filter(near).select(*columns, distance) for df in (pairs, *(df.withColumn(distance, d) for df in parts)))


def _by_piece(a: DataFrame, b: DataFrame, pieces) -> tuple[DataFrame, ...]:
    """The cells of both sides cut up by piece."""
    return tuple(df.withColumn("_piece", F.explode(p)).withColumn("_cell", F.xxhash64("_cell", "_piece")).drop("_piece", *[p] * isinstance(p, str)) for df, p in zip((a, b), pieces))


def _sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(_cell, _na, _nb): rows of cells that have some of both sides."""
    sizes = [df.groupBy("_cell").agg(F.count(F.lit(1)).alias(n)) for df, n in ((a, "_na"), (b, "_nb"))]
    return sizes[0].join(sizes[1], "_cell")


def _met_pairs(a: DataFrame, b: DataFrame) -> float:
    return _sizes(a, b).agg(F.sum(F.col("_na").cast("double") * F.col("_nb"))).first()[0] or 0.0


_RARE = 10  # pieces are of use where they leave one pair of so many
_CROWD_PAIRS = 20_000  # of a cell: with more, a task of its own pays
_CROWD_ROWS = 50_000  # of a side of a cell that a task holds


def _crowds_apart(a: DataFrame, b: DataFrame) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """Both sides without and with the rows of cells of many pairs."""
    many = _sizes(a, b).filter(F.col("_na").cast("double") * F.col("_nb") > _CROWD_PAIRS)
    many = few_rows(cut(many.select("_cell")))
    return tuple(tuple(df.join(many, "_cell", kind) for df in (a, b)) for kind in ("left_anti", "left_semi"))


def _crowd_totals(a: DataFrame, b: DataFrame, radius_km: float, inclusive: bool, totals) -> DataFrame:
    """(columns of `totals`, _pairs, _km) of each crowded cell."""
    at = [[F.col(c).cast("double").alias(n) for c, n in zip(cs, ("_lat", "_lon"))] for cs in (("_lat", "_lon"), ("_attr_lat", "_attr_lon"))]
    a, b = (df.select("_cell", *of, *xy) for df, of, xy in zip((a, b), totals, at))
    schema = T.StructType([df.schema[c] for df, of in zip((a, b), totals) for c in of]).add("_pairs", "long").add("_km", "double")
    return _in_crowds(a, b, cell_totals(radius_km, inclusive, [list(of) for of in totals]), schema)


def _crowd_pairs(a: DataFrame, b: DataFrame, left: list[str], right: list[str], keep: Callable) -> DataFrame:
    """The pairs of each crowded cell that `keep` chooses, with the columns of both sides."""
    own = [c for c in left if c in a.columns], [c for c in right if c in b.columns]
    a, b = (df.select("_cell", *of) for df, of in zip((a, b), own))

    def work(l: pa.Table, r: pa.Table) -> pa.Table:
        i, j = keep(l, r)
        return pa.table([t.column(c).take(pa.array(at)) for t, of, at in ((l, own[0], i), (r, own[1], j)) for c in of], [*own[0], *own[1]])

    return _in_crowds(a, b, work, T.StructType([df.schema[c] for df, of in zip((a, b), own) for c in of]))


def _in_crowds(a: DataFrame, b: DataFrame, work: Callable, schema: T.StructType) -> DataFrame:
    """Both sides of each cell brought together; large ones in blocks."""
    a, b, keys = split_hot_keys(a, b, "_cell", _CROWD_ROWS)
    n = tasks(a)
    return a.repartition(n, *keys).groupBy(*keys).cogroup(b.repartition(n, *keys).groupBy(*keys)).applyInArrow(work, schema)


def _vector(prefix: str) -> list[Column]:
    return [F.col(prefix + axis) for axis in "xyz"]


def _with_vector(df: DataFrame, at, prefix: str) -> DataFrame:
    return df.withColumns(dict(zip([prefix + axis for axis in "xyz"], unit_vector(F.col(at[0]), F.col(at[1])))))


# --- the tree of grid nodes -------------------------------------------------------------------

_FINEST = 24
_LEVELS = tuple(range(3, _FINEST + 1, 3))
_MAX_ROOTS = 64
# Sites of a node that are counted, or compared with each spot, in one task.
_COUNTED_SITES, _COMPARED_SITES = 32_768, 2_048
_LEAF_ROWS = 200_000  # spots or sites of a node that a task takes at once
_FEW_PAIRS = 20_000_000  # of spots and sites in neighbouring cells: joined directly


def _axis(value: Column, span: float) -> Column:
    cells = 1 << _FINEST
    return F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor(value * F.lit(cells / span)).cast("bigint")))


def _placed(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the finest cell along each axis."""
    north, east = F.col(lat) + F.lit(90.0), F.pmod(F.col(lon) + F.lit(180.0), F.lit(360.0))
    return df.withColumns({"site_y": _axis(north, 180.0), "site_x": _axis(east, 360.0)})


def _site_node(level: int) -> Column:
    """Node of a site at a level: the globe halved `level` times along each axis. Nodes nest."""
    up = _FINEST - level
    return F.expr(f"shiftright(site_y, {up}) * {1 << 32}L + shiftright(site_x, {up})")


def _centre(node: Column, level: int) -> list[Column]:
    cells = float(1 << level)
    y, x = F.shiftright(node, 32), node.bitwiseAND(F.lit((1 << 32) - 1))
    lat = (y + F.lit(0.5)) * F.lit(180.0 / cells) - F.lit(90.0)
    return unit_vector(lat, (x + F.lit(0.5)) * F.lit(360.0 / cells) - F.lit(180.0))


def _sites(targets: DataFrame, at, label: str | None = None) -> DataFrame:
    """Distinct target positions and how many targets are at each."""
    lat, lon = F.col(at[0]).cast("double"), F.col(at[1]).cast("double")
    named = [F.min(label).alias("label")] if label else []
    sites = targets.filter(has_position(lat, lon)).groupBy(lat.alias("site_lat"), lon.alias("site_lon"))
    return _with_vector(sites.agg(F.count(F.lit(1)).alias("n"), *named), ("site_lat", "site_lon"), "s")


class _Tree:
    """Target positions summarised by node: how many, and how far they lie from the node's centre.

    All distances in the tree are straight ones on the unit sphere, where d(a, c) <= d(a, b) + d(b, c),
    so "centre +- reach" is a true bound everywhere on the globe.
    """

    def __init__(self, sites: DataFrame, leaf_sites: int):
        # Written out once: read for every level below.
        self.sites = cut(_placed(sites, "site_lat", "site_lon"))
        self.leaf_sites = leaf_sites
        nodes = [F.struct(F.lit(m).alias("m"), _site_node(m).alias("q")) for m in _LEVELS]
        stats = (
            self.sites.select(F.explode(F.array(*nodes)).alias("s"))
            .groupBy("s.m", "s.q").agg(F.count(F.lit(1)).alias("sites"))
            .groupBy("m").agg(F.count(F.lit(1)).alias("nodes"), F.max("sites").alias("most"))
            .collect()  # one row per level
        )
        self.empty = not stats
        if self.empty:
            return
        by_level = {r["m"]: r for r in stats}
        first = max((m for m in _LEVELS if by_level[m]["nodes"] <= _MAX_ROOTS), default=_LEVELS[0])
        below = [m for m in _LEVELS if m >= first]
        leaf = next((m for m in below if by_level[m]["most"] <= leaf_sites), _FINEST)
        self.levels = [m for m in below if m <= leaf]

    def nodes(self, level: int) -> DataFrame:
        placed = self.sites.withColumn("node", _site_node(level))
        away = chord(_vector("s"), _centre(F.col("node"), level))
        grouped = placed.select("node", "n", away.alias("away")).groupBy("node").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("sites"), (F.max("away") + F.lit(_ROUNDING)).alias("reach")
        )
        return grouped.withColumns(dict(zip(("cx", "cy", "cz"), _centre(F.col("node"), level))))

    def children(self, level: int) -> DataFrame:
        parent = F.expr(f"shiftright(shiftright(node, 32), 3) * {1 << 32}L + shiftright(node & {(1 << 32) - 1}L, 3)")
        return self.nodes(level).withColumn("parent", parent)

    def roots(self) -> Column:
        """At most 64 nodes, as a literal array."""
        rows = [r.asDict() for r in self.nodes(self.levels[0]).collect()]
        kinds = "array<struct<node:bigint,n:bigint,sites:bigint,reach:double,cx:double,cy:double,cz:double>>"
        return F.from_json(F.lit(json.dumps(rows)), kinds)

    def members(self, level: int) -> DataFrame:
        return self.sites.withColumn("node", _site_node(level)).drop("site_y", "site_x", "sx", "sy", "sz")

    @property
    def deep(self) -> bool:
        return len(self.levels) > 3

    def kept(self, front: DataFrame) -> DataFrame:
        """In a deep tree the front is read twice per level: written out rather than worked out again."""
        return cut(front) if self.deep else front

    def opened(self, front: DataFrame, level: int) -> tuple[DataFrame | None, DataFrame | None]:
        """Front rows of a level whose nodes are opened there, and those to go down with.

        Nodes of few sites end early in a deep tree; in a shallow one all go down to the last level.
        """
        last = level == self.levels[-1]
        if not last and not self.deep:
            return None, front.withColumnRenamed("node", "parent").drop("n", "sites")
        few = front if last else front.filter(F.col("sites") <= self.leaf_sites)
        crowded = None if last else front.filter(F.col("sites") > self.leaf_sites)
        return few.drop("n", "sites"), crowded.withColumnRenamed("node", "parent").drop("n", "sites") if crowded else None

    def in_leaves(self, rows: DataFrame, level: int, work, schema: str) -> DataFrame:
        """The rows and the sites of each node of a level, brought together; crowded nodes in blocks."""
        a, b, keys = split_hot_keys(rows, self.members(level), "node", _LEAF_ROWS)
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(work, schema)


def _spots(points: DataFrame, at) -> DataFrame:
    """Distinct positions with their vectors."""
    lat, lon = F.col(at[0]).cast("double"), F.col(at[1]).cast("double")
    spots = points.filter(has_position(lat, lon)).select(lat.alias("lat"), lon.alias("lon")).distinct()
    return _with_vector(evenly(spots), ("lat", "lon"), "p")


def _to_root(t: Column) -> Column:
    return chord(_vector("p"), [t["cx"], t["cy"], t["cz"]])


def count_within(
    points: DataFrame, targets: DataFrame, radii: dict[str, float], at=COORDINATES, target_at=COORDINATES,
    minus: int = 0, crowd: int = 5_000,
) -> DataFrame:
    """Add, per name in `radii`, how many targets lie within that many kilometres (inclusive).

    Zero when there is none; null when the point has no position. `minus` is taken off each count
    (1 when the points are among the targets and shall not count themselves). Where targets are
    sparse, positions are joined directly; past `crowd` positions per cell, or many pairs in all,
    the tree is used.
    """
    names = list(radii)
    known = has_position(F.col(at[0]), F.col(at[1]))
    limits = [float(radii[k]) for k in names]
    sites, spots = _sites(targets, target_at), _spots(points, at)
    per_cell = sites.groupBy(cell_of("site_lat", "site_lon", grid_step(max(limits)))).agg(F.count(F.lit(1)).alias("sites"))
    most = per_cell.agg(F.max("sites").alias("most")).first()["most"]
    if most is None:
        return points.select("*", *[F.when(known, F.lit(0)).cast("bigint").alias(k) for k in names])
    # Nine cells can hold a spot's sites; points are counted with their copies, which is more.
    direct = most <= crowd and points.count() * most * 9 <= _FEW_PAIRS
    counts = _direct_counts(spots, sites, limits) if direct else _tree_counts(spots, _Tree(sites, _COUNTED_SITES), limits)
    out = _attach(points, counts, at)
    filled = [
        F.when(known, F.greatest(F.lit(0), F.coalesce(F.col(f"_n{i}"), F.lit(0)) - minus)).cast("bigint").alias(k)
        for i, k in enumerate(names)
    ]
    return out.select(*points.columns, *filled)


def _direct_counts(spots: DataFrame, sites: DataFrame, limits: list[float]) -> DataFrame:
    pairs = radius_join(
        spots.select("lat", "lon"), sites.select("site_lat", "site_lon", "n"), max(limits),
        ("lat", "lon"), ("site_lat", "site_lon"), distance="km",
    )
    return pairs.groupBy("lat", "lon").agg(
        *[F.sum(F.when(F.col("km") <= r, F.col("n"))).alias(f"_n{i}") for i, r in enumerate(limits)]
    )


def _tree_counts(spots: DataFrame, tree: _Tree, limits: list[float]) -> DataFrame:
    circle = [F.struct(F.lit(i).alias("i"), F.lit(r).alias("km"), F.lit(chord_of_km(r)).alias("c")) for i, r in enumerate(limits)]
    spot = ["lat", "lon", "px", "py", "pz", "i", "km", "c"]
    rows = spots.withColumn("r", F.explode(F.array(*circle))).select(*spot[:5], "r.*")
    touched = F.filter(tree.roots(), lambda t: _to_root(t) - t["reach"] <= F.col("c"))
    d = chord(_vector("p"), _vector("c"))
    found = ["node", "n", "sites", "reach", "d"]
    front = rows.withColumn("t", F.explode(touched)).select(*spot, "t.*").withColumn("d", d).select(*spot, *found)
    parts = []
    for level, deeper in zip(tree.levels, [*tree.levels[1:], None]):
        inside = F.col("d") + F.col("reach") <= F.col("c") - F.lit(_ROUNDING)
        parts.append(front.filter(inside).select("lat", "lon", "i", "n"))
        opened, crowded = tree.opened(front.filter(~inside).drop("reach", "d"), level)
        if opened is not None:
            parts.append(tree.in_leaves(opened.drop("px", "py", "pz"), level, count_leaf, "lat double, lon double, i int, n bigint"))
        if deeper is not None:
            front = crowded.join(tree.children(deeper), "parent").withColumn("d", d).select(*spot, *found)
            front = tree.kept(front.filter(F.col("d") - F.col("reach") <= F.col("c")))
    return union_all(parts).groupBy("lat", "lon").agg(
        *[F.sum(F.when(F.col("i") == i, F.col("n"))).alias(f"_n{i}") for i in range(len(limits))]
    )


def nearest(
    points: DataFrame, targets: DataFrame, distance: str = "nearest_km", at=COORDINATES, target_at=COORDINATES,
    label: str | None = None, label_name: str = "nearest",
) -> DataFrame:
    """Add the distance to the closest target, however far, and its label (the smallest one at that spot).

    Of targets equally near, the label comes from the one with the smallest coordinates.
    """
    extra = [label_name] if label else []
    tree = _Tree(_sites(targets, target_at, label), _COMPARED_SITES)
    if tree.empty:
        nothing = [F.lit(None).cast("double").alias(distance), *[F.lit(None).cast("string").alias(e) for e in extra]]
        return points.select("*", *nothing)
    pair = ["lat", "lon", "site_lat", "site_lon", *(["label"] if label else [])]
    kinds = ", ".join(f"{c} {k}" for c, k in [*((c, "double") for c in pair[:4]), *((c, k) for c, k in tree.sites.dtypes if c == "label")])
    # First the own node of each spot: what is found there bounds the search among the others.
    home = tree.levels[-1]
    spots = _placed(_spots(points, at), "lat", "lon").withColumn("home", _site_node(home)).drop("site_y", "site_x")
    own = cut(tree.in_leaves(spots.select(F.col("home").alias("node"), "lat", "lon", F.lit(2.0).alias("bound")), home, nearest_leaf, kinds))
    away = chord(unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("site_lat"), F.col("site_lon")))
    bounds = own.groupBy(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).agg((F.min(away) + F.lit(_ROUNDING)).alias("own"))
    spots = spots.join(bounds, (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon")), "left").drop("_lat", "_lon")
    spot = ["lat", "lon", "px", "py", "pz", "home", "own", "bound"]
    roots = tree.roots()
    farthest = F.array_min(F.transform(roots, lambda t: _to_root(t) + t["reach"])) + F.lit(_ROUNDING)
    front = spots.withColumn("bound", F.coalesce("own", farthest))
    front = front.withColumn("t", F.explode(F.filter(roots, lambda t: _to_root(t) - t["reach"] <= F.col("bound"))))
    front = front.select(*spot, "t.node", "t.sites", F.lit(0).alias("n"))
    parts = [own]
    for level, deeper in zip(tree.levels, [*tree.levels[1:], None]):
        opened, crowded = tree.opened(front, level)
        if opened is not None:
            if level == home:
                opened = opened.filter(F.col("own").isNull() | (F.col("node") != F.col("home")))
            parts.append(tree.in_leaves(opened.select("node", "lat", "lon", "bound"), level, nearest_leaf, kinds))
        if deeper is not None:
            front = crowded.join(tree.children(deeper), "parent").withColumn("d", chord(_vector("p"), _vector("c")))
            front = cut(front.filter(F.col("d") - F.col("reach") <= F.col("bound")))
            # Spots with nothing in their own node: the farthest end of the closest node bounds them.
            lost = front.filter(F.col("own").isNull())
            tighter = F.min(F.col("d") + F.col("reach") + F.lit(_ROUNDING)).over(Window.partitionBy("lat", "lon"))
            lost = lost.withColumn("bound", F.least(F.col("bound"), tighter))
            lost = lost.filter(F.col("d") - F.col("reach") <= F.col("bound"))
            front = tree.kept(union_all([df.select(*spot, "node", "sites", "n") for df in (front.filter(F.col("own").isNotNull()), lost)]))
    exact = union_all(parts)
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    best = F.min(F.struct(km.alias("km"), "site_lat", "site_lon", *(["label"] if label else []))).alias("_best")
    found = exact.groupBy("lat", "lon").agg(best)
    found = found.select("lat", "lon", F.col("_best.km").alias(distance), *[F.col("_best.label").alias(e) for e in extra])
    return _attach(points, found, at).select(*points.columns, distance, *extra)


def _attach(points: DataFrame, facts: DataFrame, at) -> DataFrame:
    """Left join by position; facts hold one row per position."""
    here = (F.col(at[0]).cast("double") == F.col("_lat")) & (F.col(at[1]).cast("double") == F.col("_lon"))
    return points.join(facts.withColumnsRenamed({"lat": "_lat", "lon": "_lon"}), here, "left")


def landmark_distances(df: DataFrame, landmarks: dict[str, tuple[float, float]], at=COORDINATES) -> DataFrame:
    """Add one distance column per landmark; the landmarks are plain parameters, so nothing is joined."""
    here = F.col(at[0]), F.col(at[1])
    return df.withColumns({k: haversine_km(*here, F.lit(float(p[0])), F.lit(float(p[1]))) for k, p in landmarks.items()})


def area_cell(lat="latitude", lon="longitude", size_km: float = 5.0) -> Column:
    """Grid cell used as the area of a place; null without a position."""
    position = has_position(F.col(lat), F.col(lon))
    return F.when(position, cell_of(lat, lon, grid_step(size_km)))



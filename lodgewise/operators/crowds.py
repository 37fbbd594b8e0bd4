"""What a task does with a crowded cell of `spatial.radius_join`: its pairs are added up or compared without becoming rows."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodgewise.functions.geo import EARTH_RADIUS_KM, chord_of_km
from lodgewise.operators.edits import Edits, similarity
from lodgewise.operators.leaves import _ROUNDING, _haversine_km, _numbers, _vectors

_TILE = 256  # rows of either side that are compared at once
_CLOSE = 1e-7  # of the squared size of a cell: squares of distances below that are worked out again without loss
_SMALL = 0.02  # chords below that are made arcs by a series
_KEPT = 1 << 20  # totals that are kept before equal labels are added up; pairs, before worse ones go
_CELLS = 1 << 18  # pairs of rows that are compared at once
_TABLE = 1 << 24  # of distances between distinct names, if they are far fewer than the pairs of rows
_TIE_KM = 1e-9  # left to Spark's formula


class _Tiles:
    """Points of a cell in tiles of neighbours, sorted by label within each tile."""

    def __init__(self, place: np.ndarray, label: np.ndarray):
        n = len(place)
        strips = max(1, int(np.ceil(np.sqrt(n / _TILE))))
        wide, other = np.argsort(np.ptp(place, axis=0))[::-1][:2]
        strip = np.empty(n, np.int64)
        strip[np.argsort(place[:, wide], kind="stable")] = np.arange(n) * strips // n
        order = np.lexsort((place[:, other], strip))
        ends = np.searchsorted(strip[order], np.arange(strips), side="right")
        starts = np.concatenate([[0], ends[:-1]])
        tile = np.concatenate([np.arange(e - s) * strips // max(1, e - s) + k * strips for k, (s, e) in enumerate(zip(starts, ends))])
        order = order[np.lexsort((label[order], tile))]
        cuts = np.flatnonzero(np.diff(tile)) + 1
        self.starts, self.ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [n]])
        self.order, self.place, self.label = order, place[order], label[order]
        new = np.concatenate([[True], (np.diff(tile) != 0) | (np.diff(self.label) != 0)])
        self.runs = np.flatnonzero(new)  # of one label within a tile
        self.first_run = np.searchsorted(self.runs, self.starts)
        self.last_run = np.searchsorted(self.runs, self.ends)
        low, high = (f.reduceat(self.place, self.starts) for f in (np.minimum, np.maximum))
        self.centre = (low + high) / 2.0
        away = np.sqrt(((self.place - np.repeat(self.centre, self.ends - self.starts, axis=0)) ** 2).sum(axis=1))
        self.reach = np.maximum.reduceat(away, self.starts)

    def tile(self, k: int) -> tuple[slice, np.ndarray, np.ndarray]:
        """Its rows, where the runs of labels begin among them, and the labels."""
        runs = self.runs[self.first_run[k] : self.last_run[k]]
        return slice(self.starts[k], self.ends[k]), runs - self.starts[k], self.label[runs]


def _meeting(a: _Tiles, b: _Tiles, chord: float) -> Iterator[tuple[int, int, bool]]:
    """Pairs of tiles that a circle can join, and whether all their points are within it."""
    for k in range(len(a.starts)):
        away = np.sqrt(((b.centre - a.centre[k]) ** 2).sum(axis=1))
        reach = a.reach[k] + b.reach
        for j in np.flatnonzero(away - reach <= chord + _ROUNDING):
            yield k, int(j), bool(away[j] + reach[j] <= chord - _ROUNDING)


def _labels(table: pa.Table, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the label of each row, and a row of each label. Nulls are values too."""
    codes = [table.column(n).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() for n in names]
    if not codes:
        return np.zeros(table.num_rows, np.int64), np.zeros(1, np.int64)
    _, rows, label = np.unique(np.stack(codes, axis=1), axis=0, return_index=True, return_inverse=True)
    return label.reshape(-1).astype(np.int64), rows


def _arcs(chords: np.ndarray, squares: np.ndarray, small: bool) -> np.ndarray:
    """Angles of chords on the sphere of radius 1."""
    if not small:
        return 2.0 * np.arcsin(np.minimum(chords / 2.0, 1.0))
    more = squares * (3.0 / 640.0)
    more += 1.0 / 24.0
    more *= squares
    more += 1.0
    more *= chords
    return more


class _Near:
    """Straight distances between the points of the two sides of a cell, and which are within a radius."""

    def __init__(self, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], radius_km: float, inclusive: bool):
        self.at, self.km, self.inclusive, self.chord = (left, right), radius_km, inclusive, chord_of_km(radius_km)
        there = _vectors(*right)
        middle = there.mean(axis=0)  # differences from it lose less than differences of points of the globe
        self.order = [np.arange(len(side[0])) for side in (left, right)]
        self.set(_vectors(*left) - middle, there - middle)

    def set(self, a: np.ndarray, b: np.ndarray) -> None:
        self.places = a, b
        sizes = [(v * v).sum(axis=1) for v in (a, b)]
        self.rows = np.column_stack([a, sizes[0], np.ones(len(a))])
        self.columns = np.column_stack([-2.0 * b, np.ones(len(b)), sizes[1]]).T.copy()
        self.close = _CLOSE * float(max(s.max() for s in sizes))

    def tiled(self, labels: tuple[np.ndarray, np.ndarray]) -> list[_Tiles]:
        tiles = [_Tiles(v, label) for v, label in zip(self.places, labels)]
        self.order = [t.order for t in tiles]
        self.set(*(t.place for t in tiles))
        return tiles

    def squares(self, i: slice, j: slice) -> np.ndarray:
        """Of the straight distances on the sphere of radius 1."""
        out = self.rows[i] @ self.columns[:, j]
        if out.min() < self.close:
            x, y = np.nonzero(out < self.close)
            out[x, y] = ((self.places[0][i][x] - self.places[1][j][y]) ** 2).sum(axis=1)
        return out

    def exact_km(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        p, q = self.order[0][p], self.order[1][q]
        return _haversine_km(self.at[0][0][p], self.at[0][1][p], self.at[1][0][q], self.at[1][1][q])

    def within(self, i: slice, j: slice, squares: np.ndarray) -> np.ndarray:
        """Which pairs are within the circle; those at its edge by the exact formula."""
        low, high = max(0.0, self.chord - _ROUNDING) ** 2, (self.chord + _ROUNDING) ** 2
        near = squares < low
        edge = squares <= high
        if np.count_nonzero(edge) > np.count_nonzero(near):
            x, y = np.nonzero(edge & ~near)
            km = self.exact_km(x + (i.start or 0), y + (j.start or 0))
            near[x, y] = km <= self.km if self.inclusive else km < self.km
        return near


def cell_totals(radius_km: float, inclusive: bool, names: tuple[list[str], list[str]]) -> Callable:
    """(labels of both sides, _pairs, _km): how many pairs of a cell are within the radius, and the sum of their distances."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [_labels(t, n) for t, n in zip((left, right), names)]
        keys, counts, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]

        def added_up() -> None:
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            n, total = np.zeros(len(key), np.int64), np.zeros(len(key))
            np.add.at(n, place, np.concatenate(counts))
            np.add.at(total, place, np.concatenate(sums))
            keys[:], counts[:], sums[:] = [key], [n], [total]

        kept = 0
        if left.num_rows and right.num_rows:
            near = _Near(*(_numbers(t, "_lat", "_lon") for t in (left, right)), radius_km, inclusive)
            tiles = near.tiled((found[0][0], found[1][0]))
            small, others = near.chord < _SMALL, len(found[1][1])
            for a, b, whole in _meeting(*tiles, near.chord):
                (i, i_runs, i_labels), (j, j_runs, j_labels) = tiles[0].tile(a), tiles[1].tile(b)
                squares = near.squares(i, j)
                arcs = _arcs(np.sqrt(squares), squares, small)
                if whole:
                    n = np.outer(np.diff([*i_runs, i.stop - i.start]), np.diff([*j_runs, j.stop - j.start]))
                else:
                    inside = near.within(i, j, squares)
                    arcs *= inside
                    n = np.add.reduceat(np.add.reduceat(inside, j_runs, axis=1, dtype=np.int64), i_runs, axis=0)
                keys.append((i_labels[:, None] * others + j_labels).ravel())
                counts.append(n.ravel())
                sums.append(np.add.reduceat(np.add.reduceat(arcs, j_runs, axis=1), i_runs, axis=0).ravel())
                kept += len(keys[-1])
                if kept > _KEPT:
                    added_up()
                    kept = 0
        added_up()
        some = np.flatnonzero(counts[0])
        key, rows = keys[0][some], []
        for t, n, of, (_, first) in zip((left, right), names, (key // len(found[1][1]), key % len(found[1][1])), found):
            rows += [t.column(c).take(pa.array(first[of])) for c in n]
        return pa.table([*rows, pa.array(counts[0][some]), pa.array(sums[0][some] * EARTH_RADIUS_KM)], names=[*names[0], *names[1], "_pairs", "_km"])

    return work


def best_pairs(radius_km: float, floor: float, left_columns: tuple[str, ...], right_columns: tuple[str, ...]) -> Callable:
    """Given the tables of a cell, with columns for id, name and position: the row numbers of pairs nearer than the radius and
    alike enough that are the best of either row in it, the most alike, then the nearest, then the smallest id. Of rows at
    one place, those of the smallest id; others as near but for rounding stay too."""

    def keep(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        if not (left.num_rows and right.num_rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sorted_by_id = [pc.sort_indices(t, [(c[0], "ascending")]).to_numpy() for t, c in ((left, left_columns), (right, right_columns))]
        left, right = left.take(pa.array(sorted_by_id[0])), right.take(pa.array(sorted_by_id[1]))
        ats = [[t.column(n).cast(pa.float64()).to_numpy() for n in c[2:]] for t, c in ((left, left_columns), (right, right_columns))]
        near, spots = _Near(*ats, radius_km, False), [_spot(*at) for at in ats]
        names = [t.column(c[1]).combine_chunks().dictionary_encode() for t, c in ((left, left_columns), (right, right_columns))]
        edits, (own, other) = Edits(*(n.dictionary.to_pylist() for n in names)), (n.indices.to_numpy().astype(np.int64) for n in names)
        n, m = left.num_rows, right.num_rows
        kind = _kind(edits)
        table = _all_codes(edits, floor, kind) if len(edits.left) * len(edits.right) <= min(_TABLE, n * m // 4) else None
        most_alike, nearest = np.zeros(m, kind), np.full(m, np.inf)
        of_left, of_right = [], [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0))]
        at_once = max(1, _CELLS // m)
        for k in range(0, n, at_once):
            rows = slice(k, min(n, k + at_once))
            inside = near.within(rows, slice(0, m), near.squares(rows, slice(0, m)))
            if table is None:
                i, j = np.nonzero(inside)
                alike = np.zeros(inside.shape, kind)
                alike[i, j] = _codes(edits, own[i + k], other[j], floor, kind)
            else:
                alike = np.take(table[own[rows]], other, axis=1)
                alike *= inside
            best = alike.max(axis=1)
            i, j = np.nonzero((alike == best[:, None]) & (best > 0)[:, None])
            km = near.exact_km(i + k, j)
            least = np.full(len(best), np.inf)
            np.minimum.at(least, i, km)
            of_left.append(_first(i + k, j, spots[1][j], km <= least[i] + _TIE_KM))
            best = alike.max(axis=0)
            better = best > most_alike
            most_alike[better], nearest[better] = best[better], np.inf
            some = np.flatnonzero((best == most_alike) & (best > 0))
            i, j = np.nonzero(alike[:, some] == best[some])
            j = some[j]
            km = near.exact_km(i + k, j)
            np.minimum.at(nearest, j, km)
            fit = np.flatnonzero(km <= nearest[j] + _TIE_KM)
            of_right.append((i[fit] + k, j[fit], alike[i[fit], j[fit]], km[fit]))
            if sum(len(p[0]) for p in of_right) > _KEPT or k + at_once >= n:
                i, j, alike, km = (np.concatenate(c) for c in zip(*of_right))
                still = (alike == most_alike[j]) & (km <= nearest[j] + _TIE_KM)
                j_at, i_at = _first(j, i, spots[0][i], still)
                places = np.searchsorted(_key(j, i, n), _key(j_at, i_at, n), sorter=(order := np.argsort(_key(j, i, n), kind="stable")))
                of_right = [tuple(c[order[places]] for c in (i, j, alike, km))]
        i, j = (np.concatenate(c) for c in zip(*of_left, of_right[0][:2]))
        both = np.unique(_key(i, j, m))
        return sorted_by_id[0][both // m], sorted_by_id[1][both % m]

    return keep


def _key(i: np.ndarray, j: np.ndarray, m: int) -> np.ndarray:
    return i * m + j


def _spot(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """A number for each position."""
    return np.unique(np.stack([lat, lon], axis=1), axis=0, return_inverse=True)[1].reshape(-1)


def _first(i: np.ndarray, j: np.ndarray, spot: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of some pairs (i, j): per i and spot the one with the smallest j."""
    i, j, spot = i[some], j[some], spot[some]
    order = np.lexsort((j, spot, i))
    i, j, spot = i[order], j[order], spot[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (spot[1:] != spot[:-1])
    return i[new], j[new]


def _kind(edits: Edits) -> np.dtype:
    """Numbers that tell all similarities of the names apart: two of them differ by one over the product of two lengths at least."""
    longest = max(edits.left.max(initial=0), edits.right.max(initial=0))
    return np.dtype(np.uint16 if longest <= 128 else np.uint32 if longest <= 30_000 else np.float64)


def _codes(edits: Edits, i: np.ndarray, j: np.ndarray, floor: float, kind: np.dtype) -> np.ndarray:
    """The similarities of pairs of names as numbers above zero in the same order; zero for those below the floor."""
    longer, shorter = np.maximum(edits.left[i], edits.right[j]), np.minimum(edits.left[i], edits.right[j])
    out = np.zeros(len(i), kind)
    some = np.flatnonzero(shorter >= longer * (floor - 1e-9))
    alike = similarity(edits.of(i[some], j[some]), longer[some])
    code = alike + 1.0 if kind.kind == "f" else np.rint(alike * (np.iinfo(kind).max - 1)) + 1
    out[some] = np.where(alike >= floor, code, 0)
    return out


def _all_codes(edits: Edits, floor: float, kind: np.dtype) -> np.ndarray:
    n, m = len(edits.left), len(edits.right)
    out = np.empty((n, m), kind)
    for k in range(0, n, at_once := max(1, _CELLS // m)):
        i, j = np.divmod(np.arange(min(at_once, n - k) * m), m)
        out[k : k + at_once] = _codes(edits, i + k, j, floor, kind).reshape(-1, m)
    return out

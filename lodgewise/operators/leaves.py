"""What a task does with one leaf of the tree of `spatial`: spots and sites of a node, counted or compared."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lodgewise.functions.geo import EARTH_RADIUS_KM

_ROUNDING = 1e-9  # as in `spatial`: straight distances closer than that are decided by the exact formula
_AT_ONCE = 1 << 18
_STEEP = 1.2  # radians from the middle of a node: beyond, the flat picture says nothing of what is inside


def _vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, m = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(p) * np.cos(m), np.cos(p) * np.sin(m), np.sin(p)], axis=1)


def _haversine_km(lat1, lon1, lat2, lon2) -> np.ndarray:
    p1, p2 = np.radians(lat1), np.radians(lat2)
    dlat, dlon = np.sin((p2 - p1) / 2.0), np.sin((np.radians(lon2) - np.radians(lon1)) / 2.0)
    return 2.0 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(1.0, dlat * dlat + np.cos(p1) * np.cos(p2) * dlon * dlon)))


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def _seen_from_above(spots: np.ndarray, sites: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Both as (x, y) on the plane that touches the sphere in the middle of the sites, and how much longer a straight
    distance can be than it looks there (infinite if the picture is too steep to tell)."""
    up = sites.mean(axis=0)
    up = up / np.linalg.norm(up) if np.linalg.norm(up) > 1e-3 else np.array([1.0, 0.0, 0.0])
    east = np.cross([0.0, 0.0, 1.0] if abs(up[2]) < 0.9 else [1.0, 0.0, 0.0], up)
    east /= np.linalg.norm(east)
    plane = np.stack([east, np.cross(up, east)], axis=1)
    steepest = min(float((sites @ up).min()), float((spots @ up).min()))
    angle = np.arccos(np.clip(steepest, -1.0, 1.0))
    return spots @ plane, sites @ plane, 1.0 / np.cos(angle) if angle < _STEEP else np.inf


def _pieces(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(range, place) of all places in the ranges, a bounded number at once."""
    lengths = stops - starts
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    for a in range(0, total, 4 * _AT_ONCE):
        flat = np.arange(a, min(total, a + 4 * _AT_ONCE))
        owner = np.searchsorted(ends, flat, side="right")
        yield owner, starts[owner] + flat - (ends[owner] - lengths[owner])


class _Strips:
    """Sites in strips of the plane, sorted along each strip: a circle holds a whole stretch of every strip it crosses,
    and only the sites at the ends of the stretches are tested one by one."""

    def __init__(self, flat: np.ndarray, weight: np.ndarray, margin: float):
        low, high = flat.min(axis=0), flat.max(axis=0)
        wide, tall = high - low
        self.low_y = low[1]
        self.n = int(np.clip(np.ceil(tall / max(np.sqrt(2.0 * wide * tall / len(flat)), tall / 4096.0, 1e-8)), 1, 4096))
        self.height = tall / self.n + 1e-12
        self.origin, self.width = low[0] - margin, wide + 2.0 * margin
        strip = np.clip(np.floor((flat[:, 1] - self.low_y) / self.height).astype(np.int64), 0, self.n - 1)
        key = strip * self.width + (flat[:, 0] - self.origin)
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        self.before = np.concatenate([[0], np.cumsum(weight[self.order])])

    def stretches(self, flat: np.ndarray, chord: float, stretch: float):
        """Per spot: weight surely within the straight distance, and ranges of sorted sites that may be."""
        per_spot = min(self.n, int(np.ceil(2.0 * chord / self.height)) + 3)
        first = np.floor((flat[:, 1] - chord - self.low_y) / self.height).astype(np.int64) - 1
        strip = np.clip(first, 0, self.n - per_spot)[:, None] + np.arange(per_spot)
        bottom = self.low_y + strip * self.height
        down, up = bottom - flat[:, 1:], bottom + self.height - flat[:, 1:]
        nearest = np.maximum(np.maximum(down, -up), 0.0) - _ROUNDING
        farthest = np.maximum(np.abs(down), np.abs(up)) + _ROUNDING
        reached = nearest <= chord + _ROUNDING
        outer = np.sqrt(np.maximum((chord + _ROUNDING) ** 2 - np.maximum(nearest, 0.0) ** 2, 0.0)) + _ROUNDING
        inside = (max(chord - 2 * _ROUNDING, 0.0) / stretch) ** 2 - farthest**2
        inner = np.sqrt(np.maximum(inside, 0.0)) - _ROUNDING
        whole = reached & (inside > 0.0) & (inner > 0.0)

        def place(x: np.ndarray, side: str) -> np.ndarray:
            return np.searchsorted(self.key, strip * self.width + np.clip(x - self.origin, 0.0, self.width), side)

        x = flat[:, :1]
        a, d = place(x - outer, "left"), place(x + outer, "right")
        d = np.where(reached, d, a)
        b, c = np.where(whole, place(x - inner, "left"), a), np.where(whole, place(x + inner, "right"), a)
        sure = (self.before[c] - self.before[b]).sum(axis=1)
        owner = np.repeat(np.arange(len(flat)), 2 * per_spot)
        return sure, owner, np.stack([a, c], axis=2).ravel(), np.stack([b, d], axis=2).ravel()


def count_leaf(spots: pa.Table, sites: pa.Table) -> pa.Table:
    """(lat, lon, i, n): how many of the sites, each `n` targets, lie within `km` (`c` straight) of each spot."""
    if not (len(spots) and len(sites)):
        return pa.table({"lat": pa.array([], pa.float64()), "lon": pa.array([], pa.float64()), "i": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    lat, lon, circle, km, chord = _numbers(spots, "lat", "lon", "i", "km", "c")
    site_lat, site_lon, weight = _numbers(sites, "site_lat", "site_lon", "n")
    here, there = _vectors(lat, lon), _vectors(site_lat, site_lon)
    flat, flat_sites, stretch = _seen_from_above(here, there)
    strips = _Strips(flat_sites, weight, 1e-6)
    site_order = strips.order
    counts = np.zeros(len(lat), np.int64)
    for i in np.unique(circle):
        of_circle = np.flatnonzero(circle == i)
        c, r = float(chord[of_circle[0]]), float(km[of_circle[0]])
        at_once = max(1, _AT_ONCE // min(strips.n, int(2.0 * c / strips.height) + 4))
        for k in range(0, len(of_circle), at_once):
            rows = of_circle[k : k + at_once]
            sure, owner, starts, stops = strips.stretches(flat[rows], c, stretch)
            found = sure
            for which, place in _pieces(starts, stops):
                own, site = rows[owner[which]], site_order[place]
                away = np.sqrt(((here[own] - there[site]) ** 2).sum(axis=1))
                near = away <= c - _ROUNDING
                edge = np.flatnonzero(~near & (away <= c + _ROUNDING))
                near[edge] = _haversine_km(lat[own[edge]], lon[own[edge]], site_lat[site[edge]], site_lon[site[edge]]) <= r
                np.add.at(found, owner[which[near]], weight[site[near]])
            counts[rows] = found
    return pa.table({"lat": lat, "lon": lon, "i": pa.array(circle, pa.int32()), "n": counts})


def _labels(sites: pa.Table, place: np.ndarray) -> dict:
    return {"label": sites.column("label").take(pa.array(place))} if "label" in sites.column_names else {}


def nearest_leaf(spots: pa.Table, sites: pa.Table) -> pa.Table:
    """(lat, lon, site_lat, site_lon, label if there is one): per spot the nearest of the sites, and those as near but for
    rounding; none where all are farther than `bound`, in straight distance."""
    lat, lon, bound = _numbers(spots, "lat", "lon", "bound")
    site_lat, site_lon = _numbers(sites, "site_lat", "site_lon")
    own, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(lat) and len(site_lat):
        there = _vectors(site_lat, site_lon).T
        reach = 1.0 - np.minimum(bound, 2.0) ** 2 / 2.0
        at_once = max(1, 8 * _AT_ONCE // len(site_lat))
        for k in range(0, len(lat), at_once):
            alike = _vectors(lat[k : k + at_once], lon[k : k + at_once]) @ there
            least = np.maximum(alike.max(axis=1), reach[k : k + at_once]) - 1e-14
            a, b = np.nonzero(alike >= least[:, None])
            own.append(a + k)
            place.append(b)
    own, place = np.concatenate(own), np.concatenate(place)
    return pa.table({"lat": lat[own], "lon": lon[own], "site_lat": site_lat[place], "site_lon": site_lon[place], **_labels(sites, place)})

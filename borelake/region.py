"""One query footprint, checked on the driver."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from math import floor

import numpy as np

Box = tuple[float, float, float, float]
Ring = tuple[tuple[float, float], ...]
Polygon = tuple[Ring, ...]

_KEY_SCALE = 1_000_000


def _ring(points: Sequence) -> Ring:
    ring = tuple((float(p[0]), float(p[1])) for p in points)
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring = ring[:-1]
    if len(set(ring)) < 3:
        raise ValueError("A region ring needs at least three different vertices.")
    return ring


def _area(ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


class _Edges:
    """All edges of a footprint in whole micro-degrees, bucketed by rows of the axis that splits them best.

    The rules and the arithmetic, which is exact, are those of ``operators.validity`` for tables.
    """

    def __init__(self, polygons: Sequence[Polygon]):
        rings = [(p, r, _grid(ring)) for p, rings in enumerate(polygons) for r, ring in enumerate(rings)]
        self.part = np.repeat([p for p, _, _ in rings], [len(g) for *_, g in rings])
        self.ring = np.repeat([r for _, r, _ in rings], [len(g) for *_, g in rings])
        self.who = np.repeat(np.arange(len(rings)), [len(g) for *_, g in rings])
        self.n = np.repeat([len(g) for *_, g in rings], [len(g) for *_, g in rings])
        self.i = np.concatenate([np.arange(len(g)) for *_, g in rings])
        self.start = np.concatenate([g for *_, g in rings])
        self.end = np.concatenate([np.roll(g, -1, axis=0) for *_, g in rings])
        spans = np.abs(self.end - self.start).sum(axis=0)
        low, high = self.start.min(axis=0), self.start.max(axis=0)
        counts = np.maximum(1, np.minimum(len(self.i) // 4 + 1, 3 * len(self.i) * (high - low) // np.maximum(spans, 1)))
        if counts[0] > counts[1]:  # columns of longitude: x and y change places
            self.start, self.end, low, high, counts = (v[..., ::-1] for v in (self.start, self.end, low, high, counts))
        self.least, self.height = int(low[1]), max(1, -int(-(high[1] - low[1]) // counts[1]))
        self.first = (np.minimum(self.start[:, 1], self.end[:, 1]) - self.least) // self.height
        self.last = (np.maximum(self.start[:, 1], self.end[:, 1]) - self.least) // self.height
        times = self.last - self.first + 1
        edge = np.repeat(np.arange(len(times)), times)
        row = np.arange(len(edge)) - np.repeat(np.cumsum(times) - times, times) + self.first[edge]
        order = np.argsort(row, kind="stable")
        self.rows = dict(_groups(row[order], edge[order]))

    def meeting(self):
        """Pairs of edges that share a point, once each, and which ends lie on the other edge."""
        for row, edges in self.rows.items():
            for at in range(0, len(edges), _BLOCK):
                a, b = (x.ravel() for x in np.meshgrid(edges[at : at + _BLOCK], edges[at:], indexing="ij"))
                once = (a < b) & (np.maximum(self.first[a], self.first[b]) == row)
                a, b = a[once], b[once]
                near = np.ones(len(a), bool)
                for k in (0, 1):
                    near &= np.minimum(self.start[a, k], self.end[a, k]) <= np.maximum(self.start[b, k], self.end[b, k])
                    near &= np.minimum(self.start[b, k], self.end[b, k]) <= np.maximum(self.start[a, k], self.end[a, k])
                a, b = a[near], b[near]
                ends = [(a, self.start[b]), (a, self.end[b]), (b, self.start[a]), (b, self.end[a])]
                sides = [_side(self.start[e], self.end[e], p) for e, p in ends]
                on = [(s == 0) & _between(self.start[e], self.end[e], p) for (e, p), s in zip(ends, sides, strict=True)]
                sign = [np.sign(s) for s in sides]
                cross = (sign[0] * sign[1] < 0) & (sign[2] * sign[3] < 0)
                kept = cross | on[0] | on[1] | on[2] | on[3]
                yield a[kept], b[kept], cross[kept], [o[kept] for o in on]

    def check(self) -> None:
        """Raises ``ValueError`` for a ring that meets itself and for rings that are misplaced."""
        splits: dict[int, set] = {}
        for a, b, cross, on in self.meeting():
            follows, closes = self.i[b] == self.i[a] + 1, (self.i[a] == 0) & (self.i[b] == self.n[a] - 1)
            one = self.who[a] == self.who[b]
            folded = np.where(follows, on[1] | on[2], np.where(closes, on[0] | on[3], True))
            if (one & folded).any():
                raise ValueError("A ring of the region crosses or touches itself.")
            if (~one & cross).any():
                raise ValueError("Two rings of the region cross.")
            for edge, point, touched in ((a, self.start[b], on[0]), (a, self.end[b], on[1]), (b, self.start[a], on[2]), (b, self.end[a], on[3])):
                for e, p in zip(edge[touched & ~one].tolist(), point[touched & ~one].tolist(), strict=True):
                    splits.setdefault(e, set()).add(tuple(p))
        if self.who[-1]:
            self._check_places(splits)

    def _check_places(self, splits: dict[int, set]) -> None:
        whole = np.array([e not in splits for e in range(len(self.i))])
        owner, middle = [np.flatnonzero(whole)], [(self.start + self.end)[whole]]  # in half micro-degrees
        for e, touches in splits.items():
            points = np.array(sorted({*touches, tuple(self.start[e].tolist()), tuple(self.end[e].tolist())}))
            owner.append(np.full(len(points) - 1, e))
            middle.append(points[1:] + points[:-1])
        owner, middle = np.concatenate(owner), np.concatenate(middle)
        n_rings = int(self.who[-1]) + 1
        pieces = np.bincount(self.who[owner], minlength=n_rings)
        inside: Counter = Counter()
        touching: Counter = Counter()
        row = (middle[:, 1] - 2 * self.least) // (2 * self.height)
        order = np.argsort(row, kind="stable")
        for r, probes in _groups(row[order], order):
            edges = self.rows.get(r, np.empty(0, int))
            for at in range(0, len(probes), _BLOCK):
                self._place(owner, middle, probes[at : at + _BLOCK], edges, inside, touching)
        part, ring = (dict(zip(self.who.tolist(), v.tolist(), strict=True)) for v in (self.part, self.ring))
        within: dict[int, set[int]] = {w: set() for w in range(n_rings)}
        for a, b in {*inside, *touching}:
            n_in, n_on = inside[a, b], touching[a, b]
            fills = n_on == pieces[a] and ring[a] == 0 and ring[b] > 0  # a part that is just another's hole
            if n_on == pieces[a] and not fills or n_in and n_in + n_on < pieces[a]:
                raise ValueError("Two rings of the region overlap.")
            if n_in or fills:
                within[a].add(b)
        for a, others in within.items():
            if ring[a]:
                if not any(ring[b] == 0 for b in others):
                    raise ValueError("A hole of the region is not within its outer ring.")
                if any(ring[b] for b in others):
                    raise ValueError("Two holes of the region overlap.")
            elif {part[b] for b in others if ring[b] == 0} - {part[b] for b in others if ring[b]}:
                raise ValueError("Two polygons of the region overlap.")

    def _place(self, owner, middle, probes, edges, inside: Counter, touching: Counter) -> None:
        """Counts, for pieces and the rings of one row, where the pieces lie."""
        p, e = (x.ravel() for x in np.meshgrid(probes, edges, indexing="ij"))
        own = owner[p]
        hole = self.ring[own] > 0
        asked = np.where(hole, (self.part[own] == self.part[e]) & (self.ring[own] != self.ring[e]), self.part[own] != self.part[e])
        p, e = p[asked], e[asked]
        start, end, at = 2 * self.start[e], 2 * self.end[e], middle[p]
        side = _side(start, end, at)
        crossed = ((start[:, 1] > at[:, 1]) != (end[:, 1] > at[:, 1])) & ((side > 0) == (end[:, 1] > start[:, 1]))
        on = (side == 0) & _between(start, end, at)
        pairs = np.stack([p, self.who[e]], axis=1)
        touched = {tuple(x) for x in pairs[on].tolist()}
        found, times = np.unique(pairs[crossed], axis=0, return_counts=True)
        touching.update((int(self.who[owner[q]]), b) for q, b in touched)
        inside.update(
            (int(self.who[owner[q]]), b) for (q, b), n in zip(found.tolist(), times.tolist(), strict=True)
            if n % 2 and (q, b) not in touched
        )


# Edges or pieces compared with a row's edges at a time.
_BLOCK = 256


def _grid(ring: Ring) -> np.ndarray:
    """Whole micro-degrees without repeated neighbours."""
    points = np.array(ring, float)
    if not (np.abs(points) <= 360).all():
        raise ValueError("The region has coordinates that are no longitude and latitude.")
    grid = np.floor(points * _KEY_SCALE + 0.5).astype(np.int64)
    grid = grid[(grid != np.roll(grid, 1, axis=0)).any(axis=1)]
    if len(grid) < 3 or _area([tuple(p) for p in grid.tolist()]) == 0:
        raise ValueError("A ring of the region has no area.")
    return grid


def _groups(keys: np.ndarray, values: np.ndarray):
    """Sorted keys with their values."""
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
    return zip([int(keys[c]) for c in cuts], np.split(values, cuts[1:]), strict=True) if len(keys) else []


def _side(start: np.ndarray, end: np.ndarray, point: np.ndarray) -> np.ndarray:
    d, f = end - start, point - start
    return d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0]


def _between(start: np.ndarray, end: np.ndarray, point: np.ndarray) -> np.ndarray:
    return ((np.minimum(start, end) <= point) & (point <= np.maximum(start, end))).all(axis=1)


@dataclass(frozen=True)
class Region:
    """Polygons of rings in lon/lat; the first ring of a polygon is its outer one."""

    polygons: tuple[Polygon, ...]

    @classmethod
    def from_bbox(cls, min_lon: float, min_lat: float, max_lon: float, max_lat: float) -> Region:
        if not (min_lon < max_lon and min_lat < max_lat):
            raise ValueError(
                f"The box {(min_lon, min_lat, max_lon, max_lat)} has no area: "
                "its west and south sides must come before its east and north sides."
            )
        return cls(((_ring([(min_lon, min_lat), (max_lon, min_lat), (max_lon, max_lat), (min_lon, max_lat)]),),))

    @classmethod
    def from_polygon(cls, outer: Sequence, holes: Sequence[Sequence] = ()) -> Region:
        return cls.from_polygons([[outer, *holes]])

    @classmethod
    def from_polygons(cls, polygons: Sequence[Sequence[Sequence]]) -> Region:
        if not polygons or not all(polygons):
            raise ValueError("A region needs at least one ring.")
        made = tuple(tuple(_ring(r) for r in rings) for rings in polygons)
        _Edges(made).check()
        return cls(made)

    @classmethod
    def from_geojson(cls, geometry: dict) -> Region:
        kind, coordinates = geometry.get("type"), geometry.get("coordinates")
        if kind == "Polygon":
            return cls.from_polygons([coordinates])
        if kind == "MultiPolygon":
            return cls.from_polygons(coordinates)
        raise ValueError(f"Region geometry must be a Polygon or MultiPolygon, not {kind!r}.")

    @classmethod
    def resolve(cls, region=None, bbox: Box | None = None) -> Region:
        """Exactly one of ``region`` (a Region, GeoJSON dict or box) and ``bbox``."""
        if region is not None and bbox is not None:
            raise ValueError("Give one of region= and bbox=; both were given.")
        if bbox is not None:
            return cls.from_bbox(*bbox)
        if region is None:
            raise ValueError("Give one of region= and bbox=; neither was given.")
        if isinstance(region, Region):
            return region
        if isinstance(region, dict):
            return cls.from_geojson(region)
        return cls.from_bbox(*region)

    @property
    def bounds(self) -> Box:
        points = [p for rings in self.polygons for ring in rings for p in ring]
        xs, ys = zip(*points, strict=True)
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def is_box(self) -> bool:
        """True when the region equals its own envelope."""
        if len(self.polygons) != 1 or len(self.polygons[0]) != 1:
            return False
        ring = self.polygons[0][0]
        x0, y0, x1, y1 = self.bounds
        box_area = 2 * (x1 - x0) * (y1 - y0)
        on_envelope = all(
            (a[0] == b[0] and a[0] in (x0, x1)) or (a[1] == b[1] and a[1] in (y0, y1))
            for a, b in zip(ring, ring[1:] + ring[:1], strict=True)
        )
        return on_envelope and abs(abs(_area(ring)) - box_area) <= 1e-9 * box_area

    @property
    def part_edges(self) -> list[list[list[tuple[float, float, float, float]]]]:
        """Edges by polygon and ring."""
        return [[[(*a, *b) for a, b in zip(r, r[1:] + r[:1], strict=True)] for r in rings] for rings in self.polygons]

    @property
    def edges(self) -> list[tuple[float, float, float, float]]:
        return [edge for rings in self.part_edges for ring in rings for edge in ring]

    def shape(self) -> list:
        """The region as a value of the ``shape`` column type."""
        return [[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in self.polygons]

    def key(self) -> str:
        """The same digest as the ``region_key`` column expression gives."""

        def ring_text(ring):
            grid = [(floor(x * _KEY_SCALE + 0.5), floor(y * _KEY_SCALE + 0.5)) for x, y in ring]
            grid = [p for i, p in enumerate(grid) if p != grid[i - 1]] or grid[:1]
            if _area(grid) < 0:
                grid.reverse()
            first = grid.index(min(grid))
            return ",".join(f"{x} {y}" for x, y in grid[first:] + grid[:first])

        polygons = [
            ";".join([ring_text(rings[0]), *sorted(ring_text(r) for r in rings[1:])])
            for rings in self.polygons
        ]
        return hashlib.sha256("|".join(sorted(polygons)).encode()).hexdigest()

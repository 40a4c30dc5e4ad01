"""Sums over circles: a tree of blocks over the points of one group, walked for many places at once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cinderfield.contract import EARTH_RADIUS_M

LEAF = 128  # points of a block that is not divided
CELLS = 1 << 21  # sums held at once: places times distinct steps
MOST_PLACES = 4_096  # walked at once
NEVER = np.iinfo(np.int64).min
COLUMNS = "_plat double, _plon double, _t long, _n long, _at long"


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], 1)


def distance_m(lat: np.ndarray, lon: np.ndarray, plat: np.ndarray, plon: np.ndarray) -> np.ndarray:
    a = np.sin(np.radians(plat - lat) / 2) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(plat)) * np.sin(np.radians(plon - lon) / 2) ** 2
    return 2.0 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


class BlockTree:
    """Points (lat, lon, step, n, at) in blocks halved along their widest side; a block's sums per step are taken when first asked for."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, step: np.ndarray, n: np.ndarray, at: np.ndarray, radius_m: float, leaf: int = LEAF):
        self.radius_m, self.leaf, self.tested = radius_m, leaf, 0
        half = min(radius_m / (2.0 * EARTH_RADIUS_M), math.pi / 2.0)
        self.chord = 2.0 * math.sin(half)
        xyz, order = unit_vectors(lat, lon), np.arange(len(lat))
        self.nodes: list[tuple] = []
        self._split(xyz, order, step, 0, len(order))
        self.xyz = np.ascontiguousarray(xyz[order].T)
        self.lat, self.lon, self.step, self.n, self.at = lat[order], lon[order], step[order], n[order], at[order]
        self.sums: dict[int, tuple] = {}

    def _split(self, xyz: np.ndarray, order: np.ndarray, step: np.ndarray, low: int, high: int) -> int:
        part = xyz[order[low:high]]
        least, most = part.min(0), part.max(0)
        middle = (least + most) / 2
        number, children = len(self.nodes), None
        self.nodes.append(())
        if high - low > self.leaf:
            half = (high - low) // 2
            order[low:high] = order[low:high][np.argpartition(part[:, np.argmax(most - least)], half)]
            children = self._split(xyz, order, step, low, low + half), self._split(xyz, order, step, low + half, high)
        else:
            order[low:high] = order[low:high][np.argsort(step[order[low:high]], kind="stable")]
        self.nodes[number] = low, high, middle, math.sqrt(((part - middle) ** 2).sum(1).max()), children
        return number

    def _sums(self, number: int) -> tuple:
        """Steps of a block, and their sums and largest times."""
        if number not in self.sums:
            low, high = self.nodes[number][:2]
            order = low + np.argsort(self.step[low:high], kind="stable")
            steps, first = np.unique(self.step[order], return_index=True)
            self.sums[number] = steps, np.add.reduceat(self.n[order], first), np.maximum.reduceat(self.at[order], first)
        return self.sums[number]

    def fold(self, lat: np.ndarray, lon: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Per place and step: the sum of n and the largest ``at`` of the points within the radius."""
        places = unit_vectors(lat, lon)
        n, at = np.zeros((len(lat), steps), np.int64), np.full((len(lat), steps), NEVER)
        todo = [(0, np.arange(len(lat)))]
        while todo:
            number, near = todo.pop()
            low, high, middle, extent, children = self.nodes[number]
            away = np.sqrt(((places[near] - middle) ** 2).sum(1))
            inside = away + extent <= self.chord * (1 - 1e-6) - 1e-12
            if inside.any():
                own, sums, latest = self._sums(number)
                cells = np.ix_(near[inside], own)
                n[cells] += sums
                at[cells] = np.maximum(at[cells], latest)
            rim = near[~inside & (away - extent <= self.chord * (1 + 1e-6) + 1e-12)]
            if not len(rim):
                continue
            if children:
                todo += [(child, rim) for child in children]
                continue
            within = self._within(places[rim], lat[rim], lon[rim], low, high)
            own, first = np.unique(self.step[low:high], return_index=True)
            cells = np.ix_(rim, own)
            n[cells] += np.add.reduceat(np.where(within, self.n[low:high], 0), first, axis=1)
            at[cells] = np.maximum(at[cells], np.maximum.reduceat(np.where(within, self.at[low:high], NEVER), first, axis=1))
        return n, at

    def _within(self, places: np.ndarray, lat: np.ndarray, lon: np.ndarray, low: int, high: int) -> np.ndarray:
        """Distance <= radius, inclusive: the squared chord decides all but a sliver, the distance itself the rest."""
        self.tested += len(places) * (high - low)
        chord2 = np.zeros((len(places), high - low))
        for axis in range(3):
            gap = places[:, axis, None] - self.xyz[axis, low:high]
            chord2 += gap * gap
        limit = self.chord * self.chord
        within = chord2 <= limit * (1 - 1e-6) - 1e-15
        place, point = np.nonzero((chord2 <= limit * (1 + 1e-6) + 1e-15) & ~within)
        if len(place):
            within[place, point] = distance_m(lat[place], lon[place], self.lat[low + point], self.lon[low + point]) <= self.radius_m
        return within


def _groups(
    batches: Iterator[pa.RecordBatch], radius_m: float, leaf: int, width: int, ends: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Of a group of places and points (which have ``_n, _ever`` and, without ``ends``, ``_t``): places, the times of the
    points, and sums and largest ``_ever`` per place and time, for some places at once; a place takes at least ``width``
    cells. With ``ends``, rising, a point's time is the first of them at or after ``_ever``; points after all go."""
    table = pa.Table.from_batches(batches)
    isplace = table.column("_ever").is_null()
    places = table.filter(isplace)
    points = table.filter(pa.compute.invert(isplace))
    if not len(places) or not len(points):
        return
    plat, plon, n, at = (points.column(c).to_numpy() for c in ("_plat", "_plon", "_n", "_ever"))
    if ends is None:
        t = points.column("_t").to_numpy()
    else:
        place = np.searchsorted(ends, at)
        early = place < len(ends)
        if not early.any():
            return
        plat, plon, n, at, t = plat[early], plon[early], n[early], at[early], ends[place[early]]
    times, step = np.unique(t, return_inverse=True)
    tree = BlockTree(plat, plon, step, n, at, radius_m, leaf)
    lat, lon = (places.column(c).to_numpy() for c in ("_plat", "_plon"))
    some = max(1, min(MOST_PLACES, CELLS // max(len(times), width)))
    for low in range(0, len(lat), some):
        a, b = lat[low : low + some], lon[low : low + some]
        yield a, b, times, *tree.fold(a, b, len(times))


def folded(radius_m: float, leaf: int):
    """For groups of places and points: rows (place, _t, _n, _at) of points within the radius."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lat, lon, times, sums, latest in _groups(batches, radius_m, leaf, 1):
            place, at_step = np.nonzero(sums)
            last = latest[place, at_step]
            columns = [pa.array(x) for x in (lat[place], lon[place], times[at_step], sums[place, at_step])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(last, mask=last == NEVER)], names=["_plat", "_plon", "_t", "_n", "_at"])

    return fold


WINDOWS = "_plat double, _plon double, _ahead array<boolean>, _past array<long>, _last array<long>"


def windowed(radius_m: float, leaf: int, ends: np.ndarray):
    """For groups of places and points: a row per place with an element per observation date.

    ``ends`` has a row of four times per date: up to which points lie ahead, which of these do not, which lie in the past,
    which of these do not. ``_ahead``: whether there is a point ahead; ``_past``: how many in the past; ``_last``: the
    largest ``_at`` up to the end of the past, or ``NEVER``. Places that meet no point give no row. Points between two
    of these times are alike and fold to one.
    """
    edges = np.unique(ends)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lat, lon, times, sums, latest in _groups(batches, radius_m, leaf, 3 * len(ends), edges):
            first = np.zeros((len(lat), 1), np.int64)
            seen = np.hstack([first, np.cumsum(sums, 1)])
            ever = np.hstack([first + NEVER, np.maximum.accumulate(latest, 1)])
            upto = np.searchsorted(times, ends, side="right")
            ahead = seen[:, upto[:, 0]] > seen[:, upto[:, 1]]
            past = seen[:, upto[:, 2]] - seen[:, upto[:, 3]]
            last = ever[:, upto[:, 2]]
            met = (ahead | (past > 0) | (last != NEVER)).any(1)
            offsets = np.arange(met.sum() + 1, dtype=np.int32) * len(ends)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[met].ravel())) for x in (ahead, past, last)]
            yield pa.RecordBatch.from_arrays([pa.array(lat[met]), pa.array(lon[met]), *lists], names=["_plat", "_plon", "_ahead", "_past", "_last"])

    return fold

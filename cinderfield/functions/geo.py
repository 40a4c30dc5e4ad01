"""Distances on the sphere and the equal-radius bins that turn them into equi-joins.

Formulas here are SQL text over column names: one parsed expression instead of
dozens of Column calls.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderfield.contract import EARTH_RADIUS_M

# Slack that keeps bins a hair wider than the radius, so rounding loses no pair.
_SLACK = 1.0 + 1e-9


def _d(x: float) -> str:
    return f"{float(x)!r}D"


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in metres between two pairs of coordinate columns."""
    a = (
        f"pow(sin(radians({lat2} - {lat1}) / 2D), 2D) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2D), 2D)"
    )
    return F.expr(f"{_d(2.0 * EARTH_RADIUS_M)} * asin(sqrt(least({a}, 1D)))")


def checked_coordinate(name: str, what: str) -> Column:
    """The column as double; a null or NaN coordinate fails the job instead of vanishing."""
    x = f"cast({name} as double)"
    failure = f"cast(raise_error('{what} holds a null or NaN coordinate') as double)"
    return F.expr(f"case when isnull({x}) or isnan({x}) then {failure} else {x} end")


@dataclass(frozen=True)
class RadiusBins:
    """Latitude bands one radius high, each cut into longitude bins at least one radius wide.

    The number of bins shrinks with the cosine of the band's latitude and wraps
    at 180 degrees, so the same expressions hold at the poles and across the
    antimeridian. A point is in exactly one bin; ``with_reach`` lists, without
    repeats, every bin that can hold a point within the radius.
    """

    radius_m: float

    #: Bits of a bin's number along its band: enough for bins of three metres.
    COLUMN_BITS: ClassVar[int] = 24

    @property
    def height_deg(self) -> float:
        return math.degrees(self.radius_m / EARTH_RADIUS_M) * _SLACK

    def _band(self, lat: str) -> str:
        return f"floor(({lat} + 90D) / {_d(self.height_deg)})"

    def _bins_in_band(self, band: str) -> str:
        h = _d(self.height_deg)
        widest = f"least(greatest(abs({band} * {h} - 90D), abs(({band} + 1) * {h} - 90D)), 90D)"
        return f"greatest(floor(cos(radians({widest})) * 360D / {h}), 1L)"

    def _column(self, lon: str, bins: str) -> str:
        return f"pmod(floor(({lon} + 180D) / 360D * {bins}), {bins})"

    @staticmethod
    def _key(band: str, column: str) -> str:
        return f"(shiftleft({band}, 32) + {column})"

    def home(self, lat: str, lon: str) -> Column:
        """The one bin a point lies in."""
        band = self._band(lat)
        return F.expr(self._key(band, self._column(lon, self._bins_in_band(band))))

    def centre(self, lat: str, lon: str) -> tuple[Column, Column]:
        """Latitude and longitude of the middle of the bin a point lies in."""
        band = self._band(lat)
        bins = self._bins_in_band(band)
        return (
            F.expr(f"({band} + 0.5D) * {_d(self.height_deg)} - 90D"),
            F.expr(f"({self._column(lon, bins)} + 0.5D) * 360D / {bins} - 180D"),
        )

    def nested(self, lat: str, lon: str, depth: int) -> tuple[Column, Column, Column]:
        """The bin a point lies in as one small number, and its row and column among the bin's 2^depth by 2^depth parts."""
        band, parts = self._band(lat), 1 << depth
        bins = self._bins_in_band(band)
        up = f"(({lat} + 90D) / {_d(self.height_deg)} - {band})"
        along = f"(({lon} + 180D) / 360D * {bins} - floor(({lon} + 180D) / 360D * {bins}))"
        return (
            F.expr(f"shiftleft({band}, {self.COLUMN_BITS}) + {self._column(lon, bins)}"),
            F.expr(f"cast(least(floor({up} * {parts}), {parts - 1}) as int)"),
            F.expr(f"cast(least(floor({along} * {parts}), {parts - 1}) as int)"),
        )

    def part_centre(self, bin_: str, row: str, column: str, parts: str) -> tuple[Column, Column]:
        """Latitude and longitude of the middle of one of ``parts`` by ``parts`` equal parts of a bin from ``nested``."""
        band, col = f"shiftright({bin_}, {self.COLUMN_BITS})", f"({bin_} & {(1 << self.COLUMN_BITS) - 1}L)"
        bins = self._bins_in_band(band)
        return (
            F.expr(f"({band} + ({row} + 0.5D) / {parts}) * {_d(self.height_deg)} - 90D"),
            F.expr(f"({col} + ({column} + 0.5D) / {parts}) * 360D / {bins} - 180D"),
        )

    def with_reach(self, df: DataFrame, lat: str, lon: str, out: str, reach_m: float | None = None) -> DataFrame:
        """One row per (input row, bin within ``reach_m``); by default within one radius."""
        height = self.height_deg if reach_m is None else math.degrees(reach_m / EARTH_RADIUS_M) * _SLACK
        h = _d(height)
        reach_sine = _d(math.sin(math.radians(min(height, 90.0))))
        spread = f"degrees(asin(least({reach_sine} / cos(radians({lat})), 1D))) * {_d(_SLACK)}"
        first = f"greatest({self._band(f'{lat} - {h}')}, 0L)"
        last = f"least({self._band(f'{lat} + {h}')}, {self._band('90D')})"
        bins = self._bins_in_band("_band")
        west = f"floor(({lon} - _reach + 180D) / 360D * {bins})"
        east = f"floor(({lon} + _reach + 180D) / 360D * {bins})"
        reached = df.selectExpr(
            "*",
            f"case when abs({lat}) + {h} >= 90D then 180D else {spread} end as _reach",
            f"explode(sequence({first}, {last})) as _band",
        ).selectExpr("*", f"explode(sequence({west}, least({east}, {west} + {bins} - 1))) as _col")
        return reached.selectExpr(
            *df.columns, f"{self._key('_band', f'pmod(_col, {bins})')} as {out}"
        )

"""Fuel-dryness formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cinderfield.functions.scalars import clamp


# The published saturation pressure (Tetens) and fine-fuel moisture step
# (Van Wagner 1987): equilibrium moisture, drying rate by wind in km/h, and the code.
SATURATION = (0.6112, 17.67, 243.5)
EQUILIBRIUM = (0.942, 0.679, 11.0, 100.0, 10.0, 0.18, 21.1, 0.115)
DRYING = 0.0365
CODE = (59.5, 250.0, 147.2, 101.0)
KMH = 3.6


def vpd(temp_c: Column, rh_pct: Column) -> Column:
    """Vapour-pressure deficit in kPa, clipped to [0, 10]."""
    base, slope, offset = SATURATION
    saturation = F.exp(temp_c * slope / (temp_c + offset)) * base
    return clamp(saturation * (F.lit(1.0) - rh_pct / 100.0), 0.0, 10.0)


def ffmc(temp_c: Column, rh_pct: Column, wind_ms: Column, previous: float = 85.0) -> Column:
    """Fine-fuel moisture code after one drying step, in [0, 101]."""
    a, b, c, d, e, f, g, h = EQUILIBRIUM
    scale, top, middle, most = CODE
    rh = clamp(rh_pct, 5.0, 100.0)
    equilibrium = a * F.pow(rh, F.lit(b)) + c * F.exp((rh - d) / e) + f * (F.lit(g) - temp_c) * (F.lit(1.0) - F.exp(-h * rh))
    before = middle * (most - previous) / (scale + previous)
    drying = F.exp(F.lit(-1.0) - DRYING * wind_ms * KMH)
    moisture = equilibrium + (F.lit(before) - equilibrium) * drying
    return clamp(scale * (F.lit(top) - moisture) / (F.lit(middle) + moisture), 0.0, 101.0)

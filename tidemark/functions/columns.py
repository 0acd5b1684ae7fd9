"""Column expressions shared by batch and streaming plans."""

from __future__ import annotations

import math
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.vocabulary import PSI_DRIFT, PSI_EPS, PSI_MODERATE, Z_95


def guarded_z(value: Column, mean: Column, std: Column) -> Column:
    """Standard score; 0.0 where the deviation is missing or not positive."""
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage, 0.0 for an empty whole."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def mean_ci_bounds(mean: Column, std: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    half = F.lit(z) * std / F.sqrt(n)
    return mean - half, mean + half


def label(key: Column, mapping: dict) -> Column:
    """Literal map lookup; NULL for a missing or NULL key."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.create_map(*pairs)[key]


def psi_term(current: Column, base: Column, eps: float = PSI_EPS) -> Column:
    c, b = current + F.lit(eps), base + F.lit(eps)
    return (c - b) * F.ln(c / b)


def verdict(value: Column, moderate: float = PSI_MODERATE, drift: float = PSI_DRIFT) -> Column:
    """NULL for a NULL value: without a baseline there is no verdict."""
    return F.when(value < moderate, "stable").when(value < drift, "moderate").when(value >= drift, "drift")


def safe_std(std: Column) -> Column:
    """Divisor for standardising: 1.0 for a missing or zero deviation, never below 1e-6."""
    return F.greatest(F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0)), F.lit(1e-6))


def squared_distance(features: list[str], centre: list[float]) -> str:
    """SQL text of the squared Euclidean distance to a fixed centre."""
    gaps = [f"(`{f}` - ({float(x)!r}D))" for f, x in zip(features, centre, strict=True)]
    return " + ".join(f"{g} * {g}" for g in gaps)


def nearest(features: list[str], centres: list[list[float]]) -> Column:
    """Struct of squared distance and id of the closest centre; the lowest id wins a tie.

    Built as one SQL text: k-means rebuilds it in every pass.
    """
    options = [
        f"named_struct('distance2', {squared_distance(features, c)}, 'cluster', {i})" for i, c in enumerate(centres)
    ]
    return F.expr(options[0] if len(options) == 1 else f"least({', '.join(options)})")


def zorder_key(ranks: list[str], bits: int) -> Column:
    """Interleave the low ``bits`` bits of integer rank columns, first column lowest."""
    if bits * len(ranks) > 62:
        raise ValueError("bits * columns must stay within 62")
    parts = [
        f"shiftleft(shiftright(CAST(`{r}` AS BIGINT), {bit}) & 1L, {bit * len(ranks) + at})"
        for bit in range(bits)
        for at, r in enumerate(ranks)
    ]
    return F.expr(" | ".join(parts))


def seconds(duration: str) -> int:
    """Seconds in a plain duration such as ``10 minutes``."""
    # Unit lengths in seconds.
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    amount, unit = duration.split()
    total = float(amount) * units[unit.rstrip("s")]
    if not math.isclose(total, round(total)) or total <= 0:
        raise ValueError(f"not a positive whole number of seconds: {duration}")
    return round(total)

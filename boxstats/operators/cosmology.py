"""Tables of scale factors, transfer functions and smoothing scales."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.functions.scalars import expansion, redshift


def timeline(scales: DataFrame, om: float, ol: float) -> DataFrame:
    """Scale factors with their redshift and E(z)."""
    with_z = scales.withColumn("z", redshift(F.col("scale")))
    return with_z.withColumn("ez", expansion(F.col("z"), om, ol))


def transfer(table: DataFrame, *keep: str) -> DataFrame:
    """(k, p) to (log10 k, log10 of k^3 P / 2 pi^2)."""
    k = F.col("k")
    return table.select(*keep, F.log10(k).alias("log10_k"), F.log10(k * k * k * F.col("p") / (2 * math.pi**2)).alias("log10_delta2"))


def radius_of(mass: float, om: float) -> float:
    """A comoving radius of 200 times the mean density, Mpc/h."""
    return 0.894 * (mass / 6.4173e13 * 0.276 / om) ** (1 / 3)


def ladder(box: float, grid: int, om: float, steps: int = 30) -> list[float]:
    """Smoothing scales between the mesh's resolution and the largest object's."""
    low = 0.325 * (box / 300) * (0.2 / 8) ** (1 / 3) * (512 / grid)
    high = 5 * radius_of(3e15, om)
    return [low * (high / low) ** (i / (steps - 1)) for i in range(steps)]

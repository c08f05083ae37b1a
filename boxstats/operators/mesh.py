"""Fields on a mesh, as sparse tables (ix, iy, iz, value) until every cell is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.functions.scalars import TINY

CELL = ("ix", "iy", "iz")


def cell(axis: str, grid: int, box: float) -> Column:
    return F.pmod(F.floor(F.col(axis) / (box / grid)), F.lit(grid)).cast("int")


def cells(spark: SparkSession, grid: int) -> DataFrame:
    """Every cell, in the order of its flat index."""
    i = F.col("id")
    return spark.range(grid**3).select((i % grid).cast("int").alias("ix"), (F.floor(i / grid) % grid).cast("int").alias("iy"), F.floor(i / (grid * grid)).cast("int").alias("iz"))


def flat(grid: int) -> Column:
    return (F.col("ix") + grid * F.col("iy") + grid * grid * F.col("iz")).cast("long")


def nearest_cell(points: DataFrame, grid: int, box: float, weight: str | None = None) -> DataFrame:
    """Number or weight of points by cell: one aggregation, combined before its shuffle."""
    value = F.sum(F.col(weight)) if weight else F.count("*").cast("double")
    return points.groupBy(*(cell(a, grid, box).alias(c) for a, c in zip("xyz", CELL, strict=True))).agg(value.alias("value"))


def cloud_in_cell(points: DataFrame, grid: int, box: float, weight: str | None = None) -> DataFrame:
    """Each point shared among the eight cells around it, by their overlap with a cell-sized cube
    that begins at its own cell. The corners come from a generator, and are summed before the
    shuffle."""
    parts = points
    for a in "xyz":
        scaled = F.col(a) / (box / grid)
        parts = parts.withColumns({f"__i{a}": F.floor(scaled), f"__d{a}": scaled - F.floor(scaled)})
    parts = parts.withColumn("__corner", F.explode(F.sequence(F.lit(0), F.lit(7))))
    share, where = F.col(weight) if weight else F.lit(1.0), []
    for n, a in enumerate("xyz"):
        bit = F.shiftright("__corner", n).bitwiseAND(1)
        share = share * F.when(bit == 1, F.col(f"__d{a}")).otherwise(1 - F.col(f"__d{a}"))
        where.append(F.pmod(F.col(f"__i{a}") + bit, F.lit(grid)).cast("int").alias(CELL[n]))
    return parts.select(*where, share.alias("__share")).groupBy(*CELL).agg(F.sum("__share").alias("value"))


def filled(field: DataFrame, grid: int, value: float = 0.0) -> DataFrame:
    """Every cell, empty ones with ``value``."""
    return cells(field.sparkSession, grid).join(field, list(CELL), "left").fillna(value, ["value"])


def contrast(field: DataFrame, grid: int, total: float) -> DataFrame:
    """Density over its mean less one, of every cell."""
    return filled(field, grid).withColumn("value", F.col("value") * grid**3 / (total + TINY) - 1)


def coarsened(field: DataFrame, grid: int, factor: int) -> DataFrame:
    """Means over blocks of ``factor`` cells a side (absent cells count as zero)."""
    if grid % factor:
        raise ValueError("the factor must divide the grid")
    blocks = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in CELL]
    return field.groupBy(*blocks).agg((F.sum("value") / factor**3).alias("value"))


def cell_mean(points: DataFrame, grid: int, box: float, value: str) -> DataFrame:
    """Mean of a column over the points of each cell that has any, relative to the mean of those
    means: (d - m) / (1 + m)."""
    by = points.groupBy(*(cell(a, grid, box).alias(c) for a, c in zip("xyz", CELL, strict=True))).agg(F.avg(value).alias("d"))
    mean = by.agg(F.avg("d").alias("m"))
    return by.crossJoin(F.broadcast(mean)).select(*CELL, ((F.col("d") - F.col("m")) / (1 + F.col("m"))).alias("value"))


def gathered(points: DataFrame, field: DataFrame, grid: int, box: float) -> DataFrame:
    """Each point with the value of the mesh point nearest to it."""
    placed = points.withColumns({c: F.pmod(F.rint(F.col(a) * grid / box), F.lit(float(grid))).cast("int") for a, c in zip("xyz", CELL, strict=True)})
    return placed.join(field, list(CELL))

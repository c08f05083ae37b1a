"""Selections, projections and joins of object catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.functions.scalars import expansion, perfect_power, redshift, wrap


def least_particles(npart: int, grid: int) -> float:
    """The default resolution limit of a run of ``npart`` particles and a force grid."""
    return 200 * 0.2 * (npart / 1024**3) * (512 / grid) ** 3


def resolved(objects: DataFrame, mass: str, mpart: float, npmin: float) -> DataFrame:
    return objects.where(F.col(mass) >= mpart * npmin)


def relaxed(objects: DataFrame, qe: float | None, ratio: str = "tbyu") -> DataFrame:
    """Objects whose kinetic to potential energy is within ``qe`` of equilibrium (strictly)."""
    if qe is None:
        return objects
    return objects.where((F.col(ratio) > max(0.0, (1 - qe) / 2)) & (F.col(ratio) < (1 + qe) / 2))


def hosts(objects: DataFrame, parent: str = "pid") -> DataFrame:
    return objects.where(F.col(parent) == -1)


def prepared(objects: DataFrame, mass: str, mpart: float, npmin: float, box: float, qe: float | None = 0.5, keep_subs: bool = False) -> DataFrame:
    """Resolved, relaxed hosts with positions wrapped into the box."""
    found = relaxed(resolved(objects, mass, mpart, npmin), qe)
    return wrapped(found if keep_subs else hosts(found), box)


def wrapped(objects: DataFrame, box: float, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    return objects.withColumns({a: wrap(F.col(a), box) for a in axes})


def redshift_space(objects: DataFrame, box: float, scale: float, axis: str = "z", velocity: str = "vz", om: float | None = None, ol: float | None = None) -> DataFrame:
    """Positions shifted by the line-of-sight velocity: v / (100 a), and divided by E(z) if the
    densities are given."""
    shift = F.col(velocity) / (100 * scale)
    if om is not None:
        shift = shift / expansion(redshift(F.lit(scale)), om, 1 - om if ol is None else ol)
    return objects.withColumn(axis, wrap(F.col(axis) + shift, box))


def cropped(objects: DataFrame, centre: tuple[float, float, float], radius: float) -> DataFrame:
    squares = [(F.col(a) - c) * (F.col(a) - c) for a, c in zip("xyz", centre, strict=True)]
    return objects.where(squares[0] + squares[1] + squares[2] <= radius * radius)


def printable(objects: DataFrame, mpart: float, least: int, unbound: float, mass: str = "mvir", bound: str = "m200c") -> DataFrame:
    """Objects large enough, and bound enough, to be listed."""
    return objects.where((F.col(mass) >= least * mpart) & (F.col(mass) * unbound < F.col(bound)) & (F.col(bound) >= 1.5 * mpart))


def thinned(objects: DataFrame, every: int, key: str = "id") -> DataFrame:
    return objects.where(F.col(key) % every == 0)


def octant(box: float) -> Column:
    """0 to 7 by the half of each axis, halves being (low, high]."""
    half = F.lit(box / 2)
    return F.when(F.col("x") > half, 1).otherwise(0) + F.when(F.col("y") > half, 2).otherwise(0) + F.when(F.col("z") > half, 4).otherwise(0)


def region(njn: int, box: float) -> Column:
    """The jackknife region: the box is cut along three axes if ``njn`` is a cube, else along
    two if it is a square."""
    for p in (3, 2):
        if perfect_power(njn, p):
            n = round(njn ** (1 / p))
            label = F.lit(0).cast("long")
            for axis in "xyz"[:p]:
                label = label * n + F.pmod(F.floor(n * F.col(axis) / box), F.lit(n))
            return label.cast("int")
    raise ValueError("the number of regions must be a square or a cube")


def densest(objects: DataFrame, density: float, box: float, h: float, mass: str, mpart: float, key: str = "id", least: int = 100) -> DataFrame | None:
    """The most massive objects at a fixed number density (of (Mpc)^-3, in a box of Mpc/h);
    None if there aren't that many, they are too few or too small."""
    from boxstats.operators.statistics import least as lowest

    n = int(density * (box / h) ** 3)
    if n < least or objects.count() < n:
        return None
    top = lowest(objects, mass, n, [key], descending=True)
    if not top.agg(F.min(mass)).first()[0] > 40 * mpart:
        return None
    return top


def members(objects: DataFrame, ids: DataFrame, key: str = "id", inside: bool = True) -> DataFrame:
    return objects.join(ids, key, "left_semi" if inside else "left_anti")


def with_values(objects: DataFrame, values: DataFrame, key: str = "id", fill: float | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Value-added columns by key; ``fill`` for objects that have none."""
    joined = objects.join(values, key, "inner" if fill is None else "left")
    return joined if fill is None else joined.fillna(fill, list(columns))


def families(objects: DataFrame, basic: list[str], key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Basic columns, and the key with all others."""
    return objects.select(key, *basic), objects.drop(*basic)


def satellite_fraction(objects: DataFrame, parent: str = "pid") -> DataFrame:
    return objects.agg(F.avg((F.col(parent) != -1).cast("double")).alias("satellite_fraction"))


def mass_fraction(objects: DataFrame, mass: str, npart: int, mpart: float) -> DataFrame:
    return objects.agg((F.sum(mass) / (npart * mpart)).alias("mass_fraction"))


def matched_scale(snapshots: DataFrame, files: DataFrame, digits: int = 5) -> DataFrame:
    """Snapshots and files whose scale factors begin alike."""
    return snapshots.join(files, F.substring(snapshots["scale"], 1, digits) == F.substring(files["file_scale"], 1, digits))


def upper_masses(objects: DataFrame, masses: tuple[str, ...] = ("m200b", "mvir", "m200c")) -> DataFrame:
    """Mass definitions under the names they have in catalogues' headers: m200b is M200b there."""
    return objects.withColumnsRenamed({m: "M" + m[1:] for m in masses})

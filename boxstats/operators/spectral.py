"""Fourier transforms of meshes, power spectra, tensors and bias.

The transform is separable: along each axis in turn every cell is sent to all wave numbers of
that axis, rotated, and summed. A stage makes grid^4 rows, which are summed before its shuffle;
for larger grids :func:`forward_slabs` transforms slabs and then lines by FFT.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.functions.scalars import TINY, sinc
from boxstats.operators.mesh import CELL

MODE = ("kx", "ky", "kz")


def _axis(rows: DataFrame, at: str, to: str, others: Sequence[str], grid: int, sign: int, pairs: Sequence[tuple[str, str]], scale: float) -> DataFrame:
    waved = rows.withColumn(to, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    angle = F.pmod(F.col(at) * F.col(to), F.lit(grid)) * (sign * 2 * math.pi / grid)
    c, s = F.cos(angle), F.sin(angle)
    waved = waved.withColumns({"__c": c, "__s": s})
    sums = []
    for re, im in pairs:
        sums += [(F.sum(F.col(re) * F.col("__c") - F.col(im) * F.col("__s")) * scale).alias(re), (F.sum(F.col(re) * F.col("__s") + F.col(im) * F.col("__c")) * scale).alias(im)]
    return waved.groupBy(*others, to).agg(*sums)


def _transform(rows: DataFrame, froms: Sequence[str], tos: Sequence[str], grid: int, sign: int, pairs: Sequence[tuple[str, str]], scale: float) -> DataFrame:
    keys = list(froms)
    for n in range(3):
        others = [k for k in keys if k != froms[n]]
        rows = _axis(rows, froms[n], tos[n], others, grid, sign, pairs, scale)
        keys = [*others, tos[n]]
    return rows


def forward(field: DataFrame, grid: int, value: str = "value", by_cells: bool = True) -> DataFrame:
    """Modes (kx, ky, kz, re, im) with e^{+2 pi i k x / grid} and 1 / grid^3; absent cells are 0."""
    rows = field.select(*CELL, F.col(value).alias("re"), F.lit(0.0).alias("im"))
    return _transform(rows, CELL, MODE, grid, 1, [("re", "im")], 1.0 / grid)


def backward(modes: DataFrame, grid: int, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The inverse of :func:`forward`, of several fields at once; real parts under the names of
    the first of each pair."""
    rows = _transform(modes, MODE, CELL, grid, -1, pairs, 1.0)
    return rows.select(*CELL, *(re for re, _ in pairs))


def forward_slabs(field: DataFrame, grid: int, value: str = "value") -> DataFrame:
    """As :func:`forward`, by FFT: of each slab of constant iz, then along z of each block of
    lines. A task holds one slab of grid^2 cells, or the lines of one kx."""
    import numpy as np
    import pandas as pd

    def plane(pdf: pd.DataFrame) -> pd.DataFrame:
        mesh = np.zeros((grid, grid))
        np.add.at(mesh, (pdf["ix"], pdf["iy"]), pdf["value"])
        found = np.fft.ifft2(mesh)
        kx, ky = np.indices((grid, grid))
        return pd.DataFrame({"kx": kx.ravel(), "ky": ky.ravel(), "iz": int(pdf["iz"].iloc[0]), "re": found.real.ravel(), "im": found.imag.ravel()})

    def lines(pdf: pd.DataFrame) -> pd.DataFrame:
        mesh = np.zeros((grid, grid), complex)
        mesh[pdf["ky"], pdf["iz"]] = pdf["re"] + 1j * pdf["im"]
        found = np.fft.ifft(mesh, axis=1)
        ky, kz = np.indices((grid, grid))
        return pd.DataFrame({"kx": int(pdf["kx"].iloc[0]), "ky": ky.ravel(), "kz": kz.ravel(), "re": found.real.ravel(), "im": found.imag.ravel()})

    slabs = field.select(*CELL, F.col(value).cast("double").alias("value")).groupBy("iz").applyInPandas(plane, "kx int, ky int, iz int, re double, im double")
    return slabs.groupBy("kx").applyInPandas(lines, "kx int, ky int, kz int, re double, im double")


def signed(k: str, grid: int) -> Column:
    """The mode number, negative from half the grid on."""
    return F.when(F.col(k) >= grid // 2, F.col(k) - grid).otherwise(F.col(k))


def square(grid: int) -> Column:
    x, y, z = (signed(k, grid) for k in MODE)
    return x * x + y * y + z * z


def deconvolved(modes: DataFrame, grid: int, power: int = 2) -> DataFrame:
    """Modes over the mesh window of cloud-in-cell."""
    window = None
    for k in MODE:
        w = sinc(signed(k, grid) / float(grid))
        window = w if window is None else window * w
    window = F.pow(window, F.lit(float(power)))
    return modes.withColumns({"re": F.col("re") / window, "im": F.col("im") / window})


def contrast_modes(field: DataFrame, grid: int, total: float, window: bool = True) -> DataFrame:
    """Modes of the density contrast, without a row for every empty cell: those of the density
    over its mean, less one at the origin."""
    modes = forward(field, grid)
    origin = (F.col("kx") == 0) & (F.col("ky") == 0) & (F.col("kz") == 0)
    factor = grid**3 / (total + TINY)
    modes = modes.withColumns({"re": F.col("re") * factor - F.when(origin, 1.0).otherwise(0.0), "im": F.col("im") * factor})
    return deconvolved(modes, grid) if window else modes


def log_edges(grid: int, bins: int) -> list[float]:
    """Edges of shells in mode number, equal in log from 1 to half the grid."""
    top = math.log(grid / 2)
    return [math.exp(top * i / bins) for i in range(bins + 1)]


def linear_edges(grid: int, bins: int) -> list[float]:
    return [1 + (grid / 2 - 1) * i / bins for i in range(bins + 1)]


def mixed_edges(grid: int, linear: int, bins: int, split: float) -> list[float]:
    """Linear up to ``split``, then equal in log."""
    first = [1 + (split - 1) * i / linear for i in range(linear + 1)]
    return first + [split * (grid / 2 / split) ** (i / (bins - linear)) for i in range(1, bins - linear + 1)]


def shell(grid: int, edges: Sequence[float]) -> Column:
    """The shell of a mode: edges squared are [low, high); null beyond."""
    k2, found = square(grid), F.lit(None).cast("int")
    for n in range(len(edges) - 2, -1, -1):
        found = F.when((k2 >= edges[n] ** 2) & (k2 < edges[n + 1] ** 2), n).otherwise(found)
    return found


def power(modes: DataFrame, box: float, grid: int, edges: Sequence[float], other: DataFrame | None = None) -> DataFrame:
    """bin, k (geometric middle), n_modes and pk, auto or cross; every shell is there."""
    if other is None:
        product = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    else:
        modes = modes.join(other.select(*MODE, F.col("re").alias("re2"), F.col("im").alias("im2")), list(MODE))
        product = F.col("re") * F.col("re2") + F.col("im") * F.col("im2")
    by = modes.groupBy(shell(grid, edges).alias("bin")).agg(F.count("*").alias("n_modes"), F.sum(product).alias("p"))
    table = modes.sparkSession.createDataFrame([(n, 2 * math.pi / box * math.sqrt(a * b)) for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False))], "bin int, k double")
    found = table.join(by, "bin", "left").fillna(0, ["n_modes", "p"])
    return found.select("bin", "k", "n_modes", (F.col("p") * box**3 / (F.col("n_modes") + TINY)).alias("pk"))


def kernel(grid: int, radius: float, box: float) -> list[float]:
    """The 1-d factor of a Gaussian kernel: the transform of its samples, over its value at 0.
    (An exponential of a sum is a product, so the 3-d kernel is the product over the axes.)"""
    r = radius / box
    samples = [math.exp(-0.5 * (((i - grid) if i >= grid // 2 else i) / (grid * r)) ** 2) for i in range(grid)]
    waves = [sum(s * math.cos(2 * math.pi * i * k / grid) for i, s in enumerate(samples)) for k in range(grid)]
    return [w / waves[0] for w in waves]


def smoothed(modes: DataFrame, grid: int, radius: float, box: float) -> DataFrame:
    table = F.array(*map(F.lit, kernel(grid, radius, box)))
    factor = None
    for k in MODE:
        f = F.element_at(table, F.col(k).cast("int") + 1)
        factor = f if factor is None else factor * f
    return modes.withColumns({"re": F.col("re") * factor, "im": F.col("im") * factor})


_PAIRS = (("11", 0, 0), ("22", 1, 1), ("33", 2, 2), ("12", 0, 1), ("13", 0, 2), ("23", 1, 2))


def tensor(modes: DataFrame, grid: int, kind: str = "tidal") -> DataFrame:
    """Cells with t11, t22, t33, t12, t13, t23: of the tidal field (s_i s_j / s^2 times the
    contrast, s = sin(2 pi k / grid)) or of the density's Hessian (- s_i s_j). The modes given
    are not changed."""
    s = [F.sin(signed(k, grid) * (2 * math.pi / grid)) for k in MODE]
    norm = s[0] * s[0] + s[1] * s[1] + s[2] * s[2] + TINY
    columns = {}
    for name, i, j in _PAIRS:
        factor = s[i] * s[j] / norm if kind == "tidal" else -s[i] * s[j]
        columns |= {f"t{name}": F.col("re") * factor, f"u{name}": F.col("im") * factor}
    return backward(modes.select(*MODE, *(v.alias(k) for k, v in columns.items())), grid, [(f"t{n}", f"u{n}") for n, _, _ in _PAIRS])


def eigenvalues(rows: DataFrame, prefix: str = "t") -> DataFrame:
    """lam1 <= lam2 <= lam3 of the symmetric 3 x 3 matrix in six columns, in closed form."""
    a, b, c, d, e, f = (F.col(f"{prefix}{n}") for n, _, _ in _PAIRS)
    off = d * d + e * e + f * f
    q = (a + b + c) / 3
    p2 = (a - q) * (a - q) + (b - q) * (b - q) + (c - q) * (c - q) + 2 * off
    p = F.sqrt(p2 / 6)
    safe = F.when(p < 1e-300, 1.0).otherwise(p)
    x, y, z = (a - q) / safe, (b - q) / safe, (c - q) / safe
    u, v, w = d / safe, e / safe, f / safe
    r = (x * (y * z - w * w) - u * (u * z - w * v) + v * (u * w - y * v)) / 2
    phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))) / 3
    high = q + 2 * p * F.cos(phi)
    low = q + 2 * p * F.cos(phi + 2 * math.pi / 3)
    return rows.withColumns({"lam1": low, "lam2": 3 * q - low - high, "lam3": high})


def anisotropy(rows: DataFrame) -> DataFrame:
    """alpha: the shear of the eigenvalues lam1..3 over 1 + their sum."""
    a, b, c = F.col("lam1"), F.col("lam2"), F.col("lam3")
    shear = ((c - a) * (c - a) + (c - b) * (c - b) + (b - a) * (b - a)) / 2
    return rows.withColumn("alpha", F.sqrt(shear) / (1 + a + b + c))


def acceleration(modes: DataFrame, grid: int) -> DataFrame:
    """Cells with a1, a2, a3: the field whose divergence is minus the contrast (without a mean),
    i k / k^2 times its modes, with k = sin(2 pi k / grid)."""
    s = [F.sin(signed(k, grid) * (2 * math.pi / grid)) for k in MODE]
    norm = s[0] * s[0] + s[1] * s[1] + s[2] * s[2] + TINY
    columns = {}
    for n in range(3):
        columns |= {f"a{n + 1}": -F.col("im") * s[n] / norm, f"b{n + 1}": F.col("re") * s[n] / norm}
    return backward(modes.select(*MODE, *(v.alias(k) for k, v in columns.items())), grid, [(f"a{n}", f"b{n}") for n in (1, 2, 3)])


def bias(halos: DataFrame, modes: DataFrame, box: float, grid: int, edges: Sequence[float], key: str = "id") -> DataFrame:
    """key, bin, n_modes, pk and bk of each object and shell: L^3 Re<e^{-ikx} d> over the power.
    Modes of the shells are few and go to every task; each object meets them once."""
    inside = modes.withColumn("bin", shell(grid, edges)).where("bin is not null")
    spectrum = power(modes, box, grid, edges).select("bin", "n_modes", "pk")
    kx, ky, kz = (signed(k, grid) for k in MODE)
    waves = inside.select("bin", "re", "im", *(v.cast("double").alias(n) for v, n in zip((kx, ky, kz), ("qx", "qy", "qz"), strict=True)))
    angle = (F.col("qx") * F.col("x") + F.col("qy") * F.col("y") + F.col("qz") * F.col("z")) * (2 * math.pi / box)
    met = halos.select(key, "x", "y", "z").crossJoin(F.broadcast(waves))
    sums = met.groupBy(key, "bin").agg(F.sum(F.cos(angle) * F.col("re") + F.sin(angle) * F.col("im")).alias("s"))
    joined = sums.join(F.broadcast(spectrum), "bin")
    return joined.select(key, "bin", "n_modes", "pk", (F.col("s") / F.col("n_modes") * box**3 / (F.col("pk") + TINY)).alias("bk"))


def halo_bias(by_shell: DataFrame, key: str = "id") -> DataFrame:
    """b1 of each object: its bias by shell, weighted by modes times power."""
    w = F.col("n_modes") * F.col("pk")
    return by_shell.groupBy(key).agg((F.sum(w * F.col("bk")) / F.sum(w)).alias("b1"))


def bias_fit(by_shell: DataFrame, k_of: DataFrame, key: str = "id") -> DataFrame:
    """b10 and b11 of b(k) = b10 + b11 k^2, by weighted least squares in closed form."""
    w, k2 = F.col("n_modes") * F.col("pk"), F.col("k") * F.col("k")
    sums = by_shell.join(F.broadcast(k_of), "bin").groupBy(key).agg(F.sum(w).alias("f00"), F.sum(w * k2).alias("f02"), F.sum(w * k2 * k2).alias("f22"), F.sum(w * F.col("bk")).alias("g0"), F.sum(w * k2 * F.col("bk")).alias("g2"))
    det = F.col("f00") * F.col("f22") - F.col("f02") * F.col("f02")
    return sums.select(key, ((F.col("g0") * F.col("f22") - F.col("g2") * F.col("f02")) / det).alias("b10"), ((F.col("g2") * F.col("f00") - F.col("g0") * F.col("f02")) / det).alias("b11"))

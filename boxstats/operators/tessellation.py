"""Substructure by hulls, and the matter field of Voronoi cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.operators.mesh import nearest_cell
from boxstats.operators.neighbours import cut
from boxstats.operators.sampling import spheres

#: Points that a task looks for hulls around.
POINTS = 100_000
#: Tracers whose hulls are chosen at a time: the heaviest, one of so many that are left, but so many at least.
SHARE, LEAST = 64, 20_000


def _spread(m: int, box: float):
    """Hulls in each cell that they reach, with their centre from its corner."""
    width = box / m

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tid", "m", "x", "y", "z", "far", "h"]
        for batch in batches:
            at, far = [batch.column(a).to_numpy() for a in "xyz"], batch.column("far").to_numpy() * (1 + 1e-9)
            own = [np.floor(v / width) for v in at]
            for steps in product((-1, 0, 1) if m > 2 else range(m), repeat=3):
                if m > 2:
                    cells = [i + d for i, d in zip(own, steps, strict=True)]
                    local = [v - c * width for v, c in zip(at, cells, strict=True)]
                    good = np.flatnonzero(np.logical_and.reduce([(v >= -far) & (v <= width + far) for v in local]))
                else:  # a cell may be reached from both sides: all of its points are looked at
                    cells, local, good = [np.full(len(far), d) for d in steps], [np.full(len(far), np.nan)] * 3, np.arange(len(far))
                if len(good):
                    i, j, k = (c[good].astype(np.int64) % m for c in cells)
                    taken = dict(zip(names, (batch.column(c).take(pa.array(good)) for c in names), strict=True))
                    yield pa.RecordBatch.from_pydict({"cell": pa.array(((i * m + j) * m + k).astype(np.int32)), "tid": taken["tid"], "m": taken["m"], **{f"l{a}": pa.array(v[good]) for a, v in zip("xyz", local, strict=True)}, **{c: taken[c] for c in names[2:]}})

    return run


def _inside(width: float, box: float, directions: np.ndarray, fine: int = 10):
    """Of rows sorted by cell, part and kind (points, then hulls): the tracers of which a point lies in
    the hull of a more massive one."""
    mesh = width / fine
    corners = np.stack(np.meshgrid(*[np.arange(fine) * mesh] * 3, indexing="ij"), axis=-1).reshape(-1, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, points = None, [], None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("cell", "part", "kind")], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1, [len(place)])).tolist()
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                rows, to = batch.slice(s, e - s), tuple(place[s, :2].tolist())
                if to != here:
                    here, held, points = to, [], None
                at = np.stack([rows.column(c).to_numpy() for c in "xyz"], axis=1)
                tids, m = rows.column("tid").to_numpy(), rows.column("m").to_numpy()
                if not place[s, 2]:
                    held.append((at - np.floor(at / width) * width, at, tids, m))
                    continue
                local = np.stack([rows.column(c).to_numpy() for c in ("lx", "ly", "lz")], axis=1)
                if points is None:
                    local_, at_, tids_, m_ = map(np.concatenate, zip(*held, strict=True))
                    i = np.clip(local_ / mesh, 0, fine - 1).astype(np.int64)
                    fines = (i[:, 0] * fine + i[:, 1]) * fine + i[:, 2]
                    order = np.argsort(fines, kind="stable")
                    points, held = (np.searchsorted(fines[order], np.arange(fine**3 + 1)), at_[order], tids_[order], m_[order]), []
                starts, there, owners, masses = points
                far, planes, out = rows.column("far").to_numpy(), rows.column("h"), []
                planes = planes.values.to_numpy()[planes.offsets[0].as_py() : planes.offsets[-1].as_py()].reshape(len(far), -1)
                for n in range(len(far)):
                    apart = np.maximum(0.0, np.maximum(corners - local[n], local[n] - corners - mesh))
                    near = np.flatnonzero(~((apart * apart).sum(axis=1) > (far[n] * (1 + 1e-9)) ** 2))
                    sizes = starts[near + 1] - starts[near]
                    of = np.repeat(starts[near] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                    of = of[masses[of] < m[n]]
                    off = np.mod(there[of] - at[n] + box / 2, box) - box / 2
                    good = np.flatnonzero((off * off).sum(axis=1) <= far[n] ** 2 * (1 + 1e-12))
                    good = good[(off[good] @ directions.T <= planes[n]).all(axis=1)]
                    found, first = np.unique(owners[of[good]], return_index=True)
                    if len(found):
                        out.append((found, np.full(len(found), tids[n]), masses[of[good]][first], np.full(len(found), m[n])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], ["tid", "parent", "m", "pm"])

    return run


def _overlaps(points: DataFrame, hulls: DataFrame, box: float, directions: np.ndarray) -> DataFrame:
    """tid, parent, m and pm of the tracers that have one of the points in the hull of a more massive one, some
    of them several times. points: tid, m, x, y, z. hulls: tid, m, x, y, z, far, h."""
    reach = hulls.agg(F.max("far")).first()[0]
    m = max(1, min(64, int(box / (2.5 * max(reach or 0.0, 1e-9)))))
    i = [F.pmod(F.floor(F.col(a) / (box / m)), F.lit(m)).cast("int") for a in "xyz"]
    columns = ("tid", "m", "lx", "ly", "lz", "x", "y", "z", "far", "h")
    stars = points.select(((i[0] * m + i[1]) * m + i[2]).alias("cell"), "tid", "m", *(F.lit(0.0).alias(f"l{a}") for a in "xyz"), "x", "y", "z", F.lit(0.0).alias("far"), F.lit(None).cast("array<double>").alias("h"))
    parts = F.broadcast(stars.groupBy("cell").agg(F.ceil(F.count("*") / POINTS).cast("int").alias("parts")))  # at most 64^3 rows
    spread = hulls.mapInArrow(_spread(m, box), "cell int, tid long, m double, lx double, ly double, lz double, x double, y double, z double, far double, h array<double>")
    there = stars.join(parts, "cell").select("cell", F.pmod(F.xxhash64("x", "y", "z"), "parts").cast("int").alias("part"), F.lit(0).alias("kind"), *columns)
    here = spread.join(parts, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), *columns)
    rows = there.unionByName(here).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
    return rows.mapInArrow(_inside(box / m, box, directions), "tid long, parent long, m double, pm double")


def substructure(tracers: DataFrame, points: DataFrame | Callable[[DataFrame], DataFrame], box: float, facets: int = 32) -> DataFrame:
    """tid and parent of tracers of which a point lies in the hull of a more massive one's
    points; hulls are taken greedily, the most massive first, and a tracer swallowed has none.

    tracers: tid, x, y, z, m. points: tid, x, y, z (those of a tracer's cell), or what makes some tracers' points
    of them, with their columns m, cx, cy and cz (the centre). Hulls are bounded by
    ``facets`` support planes of fixed directions, which one aggregation finds. Hulls
    go to the cells they reach, points to their own, in parts if they are many; a task finds the points
    in each hull, so that only overlaps are rows.

    The heaviest tracers are settled first, then what their hulls that stand swallow among all others, then
    the heaviest of those left: overlaps of hulls that are swallowed anyway are never made. Of the overlaps of
    the tracers taken together, the greedy choice goes from those in nobody's hull inwards, a round for each
    level of nesting.
    """
    i = np.arange(facets) + 0.5
    mu, phi = 1 - 2 * i / facets, np.pi * (1 + 5**0.5) * i
    directions = np.stack([np.sqrt(1 - mu * mu) * np.cos(phi), np.sqrt(1 - mu * mu) * np.sin(phi), mu], axis=1)
    names = ("tid", "m", "cx", "cy", "cz")
    found: list[DataFrame] = []

    def owned(some: DataFrame) -> DataFrame:
        rows = points(some) if callable(points) else points.select("tid", *"xyz").join(some.select(*names).hint("merge"), "tid")
        return rows.select(F.col("tid").cast("long").alias("tid"), *(F.col(c).cast("double").alias(c) for c in (*names[1:], *"xyz"))).dropna()

    def offset(a: str) -> Column:
        return F.pmod(F.col(a) - F.col(f"c{a}") + box / 2, F.lit(box)) - box / 2

    def bodies(some: DataFrame) -> DataFrame:
        own = owned(some).select(*names, *(offset(a).alias(f"o{a}") for a in "xyz"))
        support = [F.max(d[0] * F.col("ox") + d[1] * F.col("oy") + d[2] * F.col("oz")).alias(f"h{n}") for n, d in enumerate(directions.tolist())]
        far = F.max(F.sqrt(F.col("ox") * F.col("ox") + F.col("oy") * F.col("oy") + F.col("oz") * F.col("oz"))).alias("far")
        return own.groupBy(*names).agg(*support, far).select("tid", "m", *(F.col(f"c{a}").alias(a) for a in "xyz"), "far", F.array(*(f"h{n}" for n in range(facets))).alias("h"))

    def outermost(pairs: DataFrame) -> DataFrame:
        return cut(pairs.groupBy("tid").agg(F.max_by("parent", F.struct("pm", -F.col("parent"))).alias("parent")))

    left = cut(tracers.withColumns({f"c{a}": F.col(a) for a in "xyz"}).dropna(subset=["m"]))
    while n := left.count():
        low = left.agg(F.percentile_approx("m", 1 - max(1 / SHARE, LEAST / n))).first()[0] if n > LEAST else None
        heavy, light = (left.where(F.col("m") >= low), left.where(F.col("m") < low)) if n > LEAST else (left, None)
        hulls = cut(bodies(heavy))
        pairs = cut(_overlaps(owned(heavy), hulls, box, directions).distinct())
        lost = _swallowed(pairs)
        if lost is not None:
            found.append(outermost(pairs.join(lost.hint("merge"), "tid", "left_semi").join(lost.withColumnRenamed("tid", "parent").hint("merge"), "parent", "left_anti")))
        if light is None:
            break
        standing = hulls if lost is None else cut(hulls.join(lost.hint("merge"), "tid", "left_anti"))
        found.append(outermost(_overlaps(owned(light), standing, box, directions)))
        left = cut(light.join(found[-1].hint("merge"), "tid", "left_anti"))
    return reduce(DataFrame.unionByName, found) if found else tracers.select(F.col("tid").cast("long").alias("tid"), F.col("tid").cast("long").alias("parent")).limit(0)


def _swallowed(pairs: DataFrame) -> DataFrame | None:
    """tid of those that the greedy choice swallows, of all overlaps (tid, parent); None: no one."""
    left, lost = pairs.select("tid", "parent"), None
    while not left.isEmpty():
        # a parent in nobody's hull stands; what it holds is swallowed, and is no parent
        standing = left.select("parent").distinct().join(left.select(F.col("tid").alias("parent")).distinct().hint("merge"), "parent", "left_anti")
        gone = cut(left.join(standing.hint("merge"), "parent", "left_semi").select("tid").distinct())
        lost = gone if lost is None else lost.union(gone)
        left = cut(left.join(gone.hint("merge"), "tid", "left_anti").join(gone.withColumnRenamed("tid", "parent").hint("merge"), "parent", "left_anti"))
    return lost


def split_cells(tracers: DataFrame, cells: DataFrame, radius: str, total: int, grid: int, box: float) -> DataFrame:
    """A matter field on a mesh: each tracer's over-density (tid, delta, of its Voronoi cell) is
    carried by random points in its ball, averaged by mesh cell, and clipped at -1."""
    carried = spheres(tracers, radius, total, box).join(cells.select("tid", "delta"), "tid")
    sums, counts = nearest_cell(carried, grid, box, "delta"), nearest_cell(carried, grid, box)
    both = sums.join(counts.withColumnRenamed("value", "n"), ["ix", "iy", "iz"])
    return both.select("ix", "iy", "iz", F.greatest(F.lit(-1.0), F.col("value") / F.col("n")).alias("value"))

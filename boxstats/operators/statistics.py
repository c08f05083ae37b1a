"""Histograms, percentiles, jackknives, interpolation and the like."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstats.functions.scalars import TINY


def histogram(rows: DataFrame, value: Column, low: float, width: float, bins: int) -> DataFrame:
    """bin and n of equal bins [low, high), the last one closed; every bin is there."""
    top = low + width * bins
    slot = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    inside = rows.where((value >= low) & (value <= top)).groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    return rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(inside, "bin", "left").fillna(0, ["n"])


def mass_function(objects: DataFrame, masses: Sequence[str], low: float, width: float, bins: int, box: float, h: float) -> DataFrame:
    """bin, mass (the bin's middle, Msun) and dn/dlnm of each mass definition (Mpc^-3), from
    masses in Msun/h and a box in Mpc/h. One aggregation for all definitions."""
    volume, step = (box / h) ** 3, width * math.log(10)
    each = objects.select(F.inline(F.array(*(F.struct(F.lit(m).alias("tag"), (F.col(m) / h).alias("m")) for m in masses))))
    lgm = F.log10("m")
    slot = F.least(F.floor((lgm - low) / width), F.lit(bins - 1)).cast("int")
    counted = each.where((lgm >= low) & (lgm <= low + width * bins)).groupBy(slot.alias("bin")).pivot("tag", list(masses)).agg(F.count("tag"))
    every = objects.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    mid = F.pow(F.lit(10.0), low + (F.col("bin") + 0.5) * width)
    rates = [(F.coalesce(F.col(m), F.lit(0)) / step / volume).alias(f"dndlnm_{m}") for m in masses]
    return every.join(counted, "bin", "left").select("bin", mid.alias("mass"), *rates)


def ranges(rows: DataFrame, value: str) -> Column:
    """The number of a row's range of values, of as many as there are shuffle partitions, between
    approximate quantiles."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = sorted(set(rows.approxQuantile(value, [i / n for i in range(1, n)], 0.5 / n))) if n > 1 else []
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(value))) if edges else F.lit(0)


def _by_range(rows: DataFrame, value: str) -> tuple[DataFrame, list[int]]:
    """Rows with their range (``__range``), and how many rows are before each range and in all."""
    placed = rows.withColumn("__range", ranges(rows, value))
    counts = dict(placed.groupBy("__range").count().collect())
    before = [0]
    for i in range(max(counts, default=-1) + 1):
        before.append(before[-1] + counts.get(i, 0))
    return placed, before


def least(rows: DataFrame, value: str, n: int, ties: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """The n rows of the least values (or largest; nulls not among them), of equal ones those of the
    least (largest) ``ties``. Ranges of values are counted; those on this side of the n-th row's are
    taken whole and only that one is put in order, so neither a task nor the driver sees all."""
    placed, before = _by_range(rows.where(F.col(value).isNotNull()), value)
    n = min(n, before[-1])
    if n <= 0:
        return rows.limit(0)
    wanted = before[-1] - n if descending else n
    edge = next(i for i in range(len(before) - 1) if (before[i] <= wanted < before[i + 1] if descending else before[i] < wanted <= before[i + 1]))
    rest = before[edge + 1] - wanted if descending else wanted - before[edge]
    turn = F.desc if descending else F.asc
    at = F.row_number().over(Window.partitionBy("__range").orderBy(*(turn(c) for c in (value, *ties))))
    beyond = F.col("__range") > edge if descending else F.col("__range") < edge
    border = placed.where(F.col("__range") == edge).withColumn("__n", at).where(F.col("__n") <= rest)
    return placed.where(beyond).unionByName(border.drop("__n")).drop("__range")


def percentiles(rows: DataFrame, value: str, at: Sequence[float], by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """perc and value, linear between ranks. Groups have one buffer each (``count``: rows that a row
    of a group stands for); all rows together are counted by ranges of the value, and only the ranges
    that hold the ranks are put in order."""
    if by:
        found = rows.groupBy(*by).agg(F.percentile(value, F.array(*map(F.lit, at)), F.col(count) if count else 1).alias("p"))
        return found.select(*by, F.posexplode("p").alias("n", "value")).select(*by, F.element_at(F.array(*(F.lit(100 * a) for a in at)), F.col("n") + 1).alias("perc"), "value")
    narrow = rows.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull()).persist()  # read four times
    placed, before = _by_range(narrow, "v")
    n = before[-1]
    if not n:
        return rows.sparkSession.range(0).select(F.lit(0.0).alias("perc"), F.lit(0.0).alias("value"))
    targets = [(a, math.floor(a * (n - 1)), math.ceil(a * (n - 1))) for a in at]
    ranks = sorted({r for _, low, high in targets for r in (low, high)})
    held = sorted({next(i for i in range(len(before) - 1) if before[i] <= r < before[i + 1]) for r in ranks})
    first = F.element_at(F.array(*(F.lit(x).cast("long") for x in before)), F.col("__range") + 1)
    at_ = first + F.row_number().over(Window.partitionBy("__range").orderBy("v")) - 1
    picked = placed.where(F.col("__range").isin(held)).withColumn("r", at_).where(F.col("r").isin(ranks))
    row = picked.agg(*(F.max(F.when(F.col("r") == r, F.col("v"))).alias(f"r{r}") for r in ranks))
    lines = [F.struct(F.lit(100 * a).alias("perc"), (F.col(f"r{low}") + (F.col(f"r{high}") - F.col(f"r{low}")) * (a * (n - 1) - low)).alias("value")) for a, low, high in targets]
    return row.select(F.inline(F.array(*lines)))


def weighted_percentile(rows: DataFrame, value: str, weight: str, at: Sequence[float]) -> DataFrame:
    """perc and the least value at which the running weight passes that share of all.

    Equal values are summed first; the running weight is made in two steps, over ranges of the
    value and within them, so no task sees all rows.
    """
    spread = rows.groupBy(value).agg(F.sum(weight).alias("w")).repartitionByRange(value).withColumn("part", F.spark_partition_id()).persist()
    parts = spread.groupBy("part").agg(F.sum("w").alias("pw"))
    before = parts.select("part", F.coalesce(F.sum("pw").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"))
    running = F.sum("w").over(Window.partitionBy("part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    cum = spread.join(F.broadcast(before), "part").withColumn("cum", running)
    total = parts.agg(F.sum("pw").alias("total"))
    picks = [F.min(F.when(F.col("cum") > p * F.col("total"), F.col(value))).alias(f"p{i}") for i, p in enumerate(at)]
    row = cum.crossJoin(F.broadcast(total)).agg(*picks)
    return row.select(F.inline(F.array(*(F.struct(F.lit(100 * p).alias("perc"), F.col(f"p{i}").alias("value")) for i, p in enumerate(at)))))


def jackknife(rows: DataFrame, region: str, regions: int, statistic: Callable[[DataFrame, Sequence[str]], DataFrame], value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and error of a statistic that is made anew without each region. Each row goes to all
    regions but its own (a generator), and the statistic groups by the region left out.

    Additive statistics should subtract instead (:func:`jackknife_sums`).
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(regions - 1)), lambda r: r != F.col(region))
    every = statistic(rows.withColumn("left_out", F.explode(others)), ["left_out"])
    scale = math.sqrt(regions - 1)
    return every.groupBy(*by).agg(F.avg(value).alias("mean"), (scale * F.stddev_pop(value)).alias("error"))


def jackknife_sums(rows: DataFrame, region: str, sums: dict[str, Column], ratio: tuple[str, str]) -> DataFrame:
    """Mean and error of a ratio of sums without each region: totals less the region's."""
    parts = rows.groupBy(region).agg(*(c.alias(k) for k, c in sums.items()))
    totals = parts.agg(F.count("*").alias("regions"), *(F.sum(k).alias(f"all_{k}") for k in sums))
    each = parts.crossJoin(F.broadcast(totals)).withColumn("v", (F.col(f"all_{ratio[0]}") - F.col(ratio[0])) / (F.col(f"all_{ratio[1]}") - F.col(ratio[1])))
    return each.agg(F.avg("v").alias("mean"), (F.sqrt(F.max("regions") - 1) * F.stddev_pop("v")).alias("error"))


def interpolated(rows: DataFrame, table: Sequence[tuple[float, float]], x: str, out: str) -> DataFrame:
    """Linear interpolation in a short table sorted by its first column; ends are held."""
    xs, ys = zip(*table, strict=True)
    col = F.col(x)
    value = F.when(col <= xs[0], ys[0])
    for (a, b), (c, d) in zip(table, table[1:], strict=False):
        value = value.when(col <= c, b + (col - a) * ((d - b) / (c - a)))
    return rows.withColumn(out, value.otherwise(ys[-1]))


def between(x: Column, knots: Sequence[tuple[float, Column]]) -> Column:
    """Linear between the values of a row's own knots, in ascending order; ends are held."""
    value = F.when(x <= knots[0][0], knots[0][1])
    for (a, b), (c, d) in zip(knots, knots[1:], strict=False):
        value = value.when(x < c, b + (x - a) * ((d - b) / (c - a)))
    return value.when(x >= knots[-1][0], knots[-1][1])


def aligned(rows: DataFrame, table: DataFrame, by: Sequence[str], x: str, y: str, logs: bool = False) -> DataFrame:
    """``rows`` (by, x) with y interpolated in ``table`` (by, x, y), ends held: both are put in
    one order, and each row takes the table's row before it and after it.

    The order is made within ranges of x, as many as there are shuffle partitions, between
    approximate quantiles of the table; each range also gets the last row of the table before it
    and the first behind it, so no task sees more than its range.
    """
    f = (lambda c: F.log(c)) if logs else (lambda c: c)
    slot, most = ranges(table, x), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = table.select(*by, F.col(x), slot.alias("__s"), F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).alias("__p"))
    held = points.groupBy(*by, "__s").agg(F.min("__p").alias("first"), F.max("__p").alias("last"))
    slots = rows.sparkSession.range(most).select(F.col("id").cast("int").alias("__s"))
    full = held.select(*by).distinct().crossJoin(F.broadcast(slots)).join(held, [*by, "__s"], "left")
    order = Window.partitionBy(*by).orderBy("__s")
    before = F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.last("first", ignorenulls=True).over(Window.partitionBy(*by).orderBy(F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1))
    full = full.select(*by, "__s", before.alias("__before"), behind.alias("__behind"))
    both = rows.withColumns({"__s": slot, "__p": F.lit(None).cast("struct<x:double,y:double>"), "__t": F.lit(1)}).unionByName(points.withColumn("__t", F.lit(0)), allowMissingColumns=True)
    within = Window.partitionBy(*by, "__s")
    # each of the windows runs forwards, from its first row on
    back = F.last("__p", ignorenulls=True).over(within.orderBy(x, "__t").rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.last("__p", ignorenulls=True).over(within.orderBy(F.desc(x), "__t").rowsBetween(Window.unboundedPreceding, 0))
    placed = both.withColumns({"__a": back, "__b": ahead}).where("__t = 1").join(full, [*by, "__s"], "left")
    placed = placed.withColumns({"__a": F.coalesce("__a", "__before"), "__b": F.coalesce("__b", "__behind")})
    a, b, at = F.col("__a"), F.col("__b"), f(F.col(x))
    slope = (f(b["y"]) - f(a["y"])) / (f(b["x"]) - f(a["x"]))
    line = f(a["y"]) + (at - f(a["x"])) * slope
    value = F.when(a.isNull(), b["y"]).when(b.isNull() | (a["x"] == b["x"]), a["y"]).otherwise(F.exp(line) if logs else line)
    return placed.withColumn(y, value).drop("__s", "__p", "__t", "__a", "__b", "__before", "__behind")


def five_point(rows: DataFrame, by: Sequence[str], order: str, value: str, step: float) -> DataFrame:
    """The derivative at the middle of five variations in order: (8 (p - m) - (pp - mm)) / 12h."""
    w = Window.partitionBy(*by).orderBy(order)
    slope = (8 * (F.lead(value, 1).over(w) - F.lag(value, 1).over(w)) - (F.lead(value, 2).over(w) - F.lag(value, 2).over(w))) / (12 * step)
    return rows.withColumn("derivative", slope).where(F.col("derivative").isNotNull())


def trapezoid(rows: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(x)
    part = (F.col(y) + F.lag(y).over(w)) / 2 * (F.col(x) - F.lag(x).over(w))
    return rows.withColumn("part", part).groupBy(*by).agg(F.sum("part").alias("integral"))


def moments(rows: DataFrame, weight: str, value: str) -> DataFrame:
    """Weighted mean and variance (weights are normalised): sum w d, sum w (d - m)^2 / (1 - sum w^2)."""
    sums = rows.agg(F.sum(weight).alias("w"), F.sum(F.col(weight) * F.col(weight)).alias("w2"), F.sum(F.col(weight) * F.col(value)).alias("wd"), F.sum(F.col(weight) * F.col(value) * F.col(value)).alias("wdd"))
    mean = F.col("wd") / F.col("w")
    return sums.select(mean.alias("mean"), ((F.col("wdd") / F.col("w") - mean * mean) / (1 - F.col("w2") / (F.col("w") * F.col("w")))).alias("variance"))


def mean_normalised(rows: DataFrame, weight: str) -> DataFrame:
    """Weights over their mean; negative ones are an error."""
    mean = rows.agg(F.avg(weight).alias("__mean"), F.min(weight).alias("__least"))
    fine = F.when(F.col("__least") < 0, F.raise_error(F.lit("weights must not be negative"))).otherwise(F.col(weight) / F.col("__mean"))
    return rows.crossJoin(F.broadcast(mean)).withColumn(weight, fine.cast("double")).drop("__mean", "__least")


def chi_square(rows: DataFrame, model: str, data: str) -> DataFrame:
    ratio = F.col(model) / F.col(data) - 1
    return rows.agg(F.sum(ratio * ratio).alias("chi2"))


def cumulative_above(counts: DataFrame, order: str, n: str) -> DataFrame:
    """Counts at and above each bin of a short table."""
    return counts.withColumn("above", F.sum(n).over(Window.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)))


def count_errors(rows: DataFrame, n: str) -> DataFrame:
    """Relative errors of counts: Poisson 1 / sqrt(n), Gaussian sqrt(2 / n); null for none."""
    c = F.when(F.col(n) > 0, F.col(n))
    return rows.withColumns({"poisson": 1 / F.sqrt(c), "gaussian": F.sqrt(2 / c)})


def voronoi(points: DataFrame, tracers: DataFrame, box: float, key: str = "qid") -> DataFrame:
    """tid, n (points nearest to it) and delta of every tracer: Monte-Carlo Voronoi volumes, by
    which the density is that of one tracer in the share of points."""
    from boxstats.operators.neighbours import nearest

    owned = nearest(points, tracers, box, key).groupBy("tid").agg(F.count("*").alias("n"))
    factor = points.agg((F.count("*").cast("double")).alias("np")).crossJoin(tracers.agg(F.count("*").alias("nt")))
    every = tracers.select("tid").join(owned, "tid", "left").fillna(0, ["n"]).crossJoin(F.broadcast(factor))
    return every.select("tid", "n", (F.col("np") / F.col("nt") / (F.col("n") + TINY) - 1).alias("delta"))


def volume(delta: Column) -> Column:
    """Relative volume of an over-density."""
    return 1 / (1 + delta + TINY)

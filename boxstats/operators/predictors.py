"""Matter densities of tracers by a user's predictor, and fits of a model's parameters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (parameters, log of 1 + delta, log of the tracer's weight) to the log of the weight of matter.
Predictor = Callable[[Sequence[float], pd.Series, pd.Series], pd.Series]


def predicted(cells: DataFrame, predictor: Predictor, parameters: Sequence[float], delta: str = "delta", weight: str = "w") -> DataFrame:
    """``cells`` with ``matter``, the predicted weight normalised to a mean of one. The predictor
    gets Arrow batches of the logarithms; cells without a positive argument get no weight."""
    fixed = tuple(parameters)

    @F.pandas_udf("double")
    def told(d: pd.Series, w: pd.Series) -> pd.Series:
        return predictor(fixed, d, w)

    raw = F.exp(told(F.log(1 + F.col(delta)), F.log(F.col(weight))))
    sized = cells.withColumn("__m", F.when((F.col(delta) > -1) & (F.col(weight) > 0), raw))
    mean = sized.agg(F.avg("__m").alias("__mean"))
    return sized.crossJoin(F.broadcast(mean)).withColumn("matter", F.coalesce(F.col("__m") / F.col("__mean"), F.lit(0.0))).drop("__m", "__mean")


def dust(weight: Column, delta: Column, volume: Column, by_mass: float, by_density: float) -> Column:
    """The weight of a cell's unbound matter: w^a (1 + delta)^b V."""
    return F.pow(weight, F.lit(by_mass)) * F.pow(1 + delta, F.lit(by_density)) * volume


def costs(rows: DataFrame, model: Callable[[Sequence[float]], Column], data: str, tried: Sequence[Sequence[float]]) -> list[float]:
    """The sum of squares of model / data - 1 for each set of parameters: one aggregation for all."""
    sums = [F.sum(F.pow(model(p) / F.col(data) - 1, F.lit(2.0))).alias(f"c{i}") for i, p in enumerate(tried)]
    return [float("inf") if c is None else c for c in rows.agg(*sums).first()]


def fitted(rows: DataFrame, model: Callable[[Sequence[float]], Column], data: str, start: Sequence[float], step: float = 0.5, least: float = 1e-3, rounds: int = 60) -> tuple[list[float], float]:
    """Parameters of the least cost and that cost, by pattern search: of the steps up and down in
    one or several parameters the best is taken, and the step halved if none is better. A round is
    one pass over the rows; the driver gets one number for each of the 3^n - 1 sets tried. Meant
    for few parameters that don't stand for each other."""
    best = list(start)
    lowest = costs(rows, model, data, [best])[0]
    for _ in range(rounds):
        tried = [[x + sign * step for x, sign in zip(best, signs, strict=True)] for signs in product((-1, 0, 1), repeat=len(best)) if any(signs)]
        found = costs(rows, model, data, tried)
        at = min(range(len(tried)), key=found.__getitem__)
        if found[at] < lowest:
            best, lowest = tried[at], found[at]
        elif (step := step / 2) < least:
            break
    return best, lowest

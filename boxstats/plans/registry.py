"""Queries by name, each with its oracle in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.operators.codec import MIX
from boxstats.sources import views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BOX = views.BOX
WITH = f"with h as ({views.HALOS}), p as ({views.PARTICLES}), q as ({views.POINTS})"


def query(sql: str | None = None, views_of: bool = True) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with DuckDB's SQL (over h: halos, p:
    particles, q: points, if ``views_of``)."""

    def add(made: Query) -> Query:
        QUERIES[made.__name__] = made
        if sql is not None:
            more = sql.lstrip().startswith(",")  # further views
            head = (WITH + (", " if more else " ")) if views_of else "with " if more else ""
            ORACLES[made.__name__] = head + sql.lstrip().removeprefix(",")
        return made

    return add


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def sql_round(value: str, digits: int = 6) -> str:
    return f"(round({value}, {digits}) + 0e0)"


def sql_side(d: str) -> str:
    return f"least(abs({d}), {BOX}e0 - abs({d}))".replace(".0e0", "e0")


def sql_distance(a: str, b: str) -> str:
    sides = [sql_side(f"({a}.{x} - {b}.{x})") for x in "xyz"]
    return "sqrt(" + " + ".join(f"{s} * {s}" for s in sides) + ")"


def sql_mod(x: str, n: str) -> str:
    """The remainder that is never negative."""
    return f"((({x}) % {n} + {n}) % {n})"


def sql_mixed(keys: tuple[str, ...], seed: int = 0) -> str:
    """The number that ``codec.mixed`` makes of keys."""
    found = f"{seed + 12_345}::bigint"
    for key in keys:
        found = f"(({found} * 48271 + {key} % {MIX}) % {MIX})"
    return f"(({found} * 69621) % {MIX})"

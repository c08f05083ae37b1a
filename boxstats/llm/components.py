"""Connected components of links between long ids, each named by its smallest id.

Alternating stars: each round hangs every id's larger neighbours on its smallest one, and then
does the same among the smaller ones, which ends, after a number of rounds that grows with the
logarithm of the size, in one star for each component. Rounds are aggregations and joins, so an
id with many links is combined before the shuffle and split by the join; nothing is collected
but a count, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstats.llm import store


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours hang on the smallest of an id and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours, and the id itself, hang on the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.union(least).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """id and component_id of every id that has a link to another one.

    Links are pairs in any order; links of an id to itself, repeated ones and null ends are
    left out.
    """
    now = store.keep(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    for _ in range(rounds):
        after = store.keep(_small(_large(now)), "links")
        store.forget(now)
        now, before = after, mark
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        mark = tuple(sums.first())
        if mark == before:
            break
    else:
        raise RuntimeError("links didn't settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(now.select("b", "b").distinct())

"""Particles, halos and query points in a box of 200, from the tables at hand.

Positions mix a row's keys in whole numbers and divide once, so that every engine gets the same
bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BOX = 200.0

PARTICLES = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
  cast((l_orderkey * 7919 + l_partkey * 6007 + l_suppkey * 9973 + l_linenumber * 104729) % 200000 as double) / cast(1000 as double) as x,
  cast((l_orderkey * 15487 + l_partkey * 7907 + l_suppkey * 104729 + l_linenumber * 6007) % 200000 as double) / cast(1000 as double) as y,
  cast((l_orderkey * 32453 + l_partkey * 9973 + l_suppkey * 7919 + l_linenumber * 61195) % 200000 as double) / cast(1000 as double) as z,
  l_quantity as w, (l_extendedprice - 5e4) / 2e1 as v, (l_discount - 5e-2) * 1e6 as phi
from lineitem"""

_SIZE = "cast(1 + ((p_partkey % 997) * (p_partkey % 997) * 17) % 997 as double)"

HALOS = f"""
select p_partkey as id,
  cast((p_partkey * 104729) % 200000 as double) / cast(1000 as double) as x,
  cast(((p_partkey % 200000) * (p_partkey % 200000) * 31 + p_partkey * 7919) % 200000 as double) / cast(1000 as double) as y,
  cast(((p_partkey % 200000) * (p_partkey % 200000) * (p_partkey % 200000) + p_partkey * 15485863) % 200000 as double) / cast(1000 as double) as z,
  p_retailprice * {_SIZE} * 1e9 as m200b, p_retailprice * {_SIZE} * 9e8 as mvir, p_retailprice * {_SIZE} * 8e8 as m200c,
  cast(p_size - 25 as double) * 2e1 as vz, cast(p_size as double) / cast(50 as double) as tbyu,
  case when p_partkey % 7 = 0 then p_partkey - 1 else cast(-1 as bigint) end as pid
from part"""

POINTS = """
select o_orderkey as qid,
  cast((o_orderkey * 7919 + o_custkey * 104729) % 200000 as double) / cast(1000 as double) as x,
  cast((o_orderkey * 15487 + o_custkey * 7907) % 200000 as double) / cast(1000 as double) as y,
  cast((o_orderkey * 32453 + o_custkey * 61195) % 200000 as double) / cast(1000 as double) as z
from orders"""


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"from {table}", "from {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", PARTICLES)


def halos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "part", HALOS)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", POINTS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")

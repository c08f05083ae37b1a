"""Queries on the snapshot codec and on snapshots over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.operators import codec
from boxstats.plans.registry import BOX, query, rounded, sql_mixed, sql_round
from boxstats.sources import views

VMAX, GRID = 5000.0, 400
_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_K = ", ".join(_KEYS)
_Q = "round_even(greatest(0e0, least(4095e0, (v / 5e3 + 1) * 2047)), 0)::int"


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.particles(spark, sf_dir).withColumn("code", codec.quantise(F.col("v"), VMAX))


@query(f"select {_K}, {_Q} as code from p")
def quantise_12bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select(*_KEYS, "code")


@query(f"select {_K}, {sql_round(f'({_Q} / 2047e0 - 1) * 5e3')} as v from p")
def dequantise_12bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select(*_KEYS, rounded(codec.dequantise(F.col("code"), VMAX)).alias("v"))


_ROWS = f"c as (select l_orderkey, {_Q} as q, row_number() over (partition by l_orderkey order by {_K}, {_Q}) - 1 as n, count(*) over (partition by l_orderkey) as m from p), e as (select l_orderkey, n // 2 as pair, max(q) filter (n % 2 = 0) as q0, max(q) filter (n % 2 = 1) as q1 from c where m % 2 = 0 group by 1, 2)"


@query(f", {_ROWS} select l_orderkey, pair::bigint as pair, (q0 & 255)::int as b0, (((q0 >> 8) & 15) | ((q1 & 15) << 4))::int as b1, (q1 >> 4)::int as b2 from e")
def pack_12bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _coded(spark, sf_dir)
    even = rows.groupBy("l_orderkey").count().where("count % 2 = 0").select("l_orderkey")
    return codec.packed_pairs(rows.join(even, "l_orderkey", "left_semi"), "code", [*_KEYS, "code"], ["l_orderkey"])


@query(f", {_ROWS} select sum(q0)::bigint as s0, sum(q1)::bigint as s1, count(*) as pairs from e")
def unpack_12bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    q0, q1 = codec.unpack(F.col("b0"), F.col("b1"), F.col("b2"))
    return pack_12bit(spark, sf_dir).agg(F.sum(q0).alias("s0"), F.sum(q1).alias("s1"), F.count("*").alias("pairs"))


def _part(a: str) -> str:
    return f"({a} / 5e-1 - floor({a} / 5e-1))"


@query(f"select {_K}, (floor(x / 5e-1)::bigint + 400 * floor(y / 5e-1)::bigint + 160000 * floor(z / 5e-1)::bigint)::bigint as cell, {', '.join(f'round_even({_part(a)} * 255, 0)::int as q{a}' for a in 'xyz')} from p")
def position_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.encode_positions(views.particles(spark, sf_dir), BOX, GRID).select(*_KEYS, "cell", "qx", "qy", "qz")


def _back(a: str) -> str:
    return f"((floor({a} / 5e-1) + round_even({_part(a)} * 255, 0) / 255) * 5e-1)"


@query(", e as (" + " union all ".join(f"select '{a}' as quantity, (({_back(a)} - {a} + 1e2) % 2e2 + 2e2) % 2e2 - 1e2 as e from p" for a in "xyz") + f" union all select 'v', ({_Q} / 2047e0 - 1) * 5e3 - v from p) select quantity, count(*) as n, {sql_round('avg(e)')} as mean, {sql_round('sqrt(avg(e * e))')} as rms, {sql_round('min(e)')} as least, {sql_round('max(e)')} as largest from e group by 1")
def codec_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = codec.decode_positions(codec.encode_positions(_coded(spark, sf_dir), BOX, GRID), BOX, GRID)
    errors = {a: codec.residual(F.col(f"d{a}"), F.col(a), BOX) for a in "xyz"} | {"v": codec.dequantise(F.col("code"), VMAX) - F.col("v")}
    found = codec.accuracy(both, errors)
    return found.select("quantity", "n", *(rounded(c).alias(c) for c in ("mean", "rms", "least", "largest")))


@query(f"select {_K}, least(l_partkey, 255)::bigint as packed, case when l_partkey > 255 then l_partkey end as overflow from lineitem", views_of=False)
def id_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.clipped(views.particles(spark, sf_dir), "l_partkey", 8).select(*_KEYS, "packed", "overflow")


@query(f"select {_K}, l_partkey as value from lineitem", views_of=False)
def id_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.unclipped(codec.clipped(views.particles(spark, sf_dir), "l_partkey", 8)).select(*_KEYS, "value")


_SIZES = " union all ".join(f"select {d} as depth, count(*) filter (l_partkey > {2 ** min(d, 63) - 1}) as n_over, count(*) * {d} / 8e0 + 16e0 * count(*) filter (l_partkey > {2 ** min(d, 63) - 1}) as bytes, count(*) as n from lineitem" for d in codec.DEPTHS)


@query(f"select depth, n_over, bytes from ({_SIZES}) where n_over <= 5e-2 * n order by bytes, depth limit 1", views_of=False)
def bit_depth_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.best_depth(views.particles(spark, sf_dir), "l_partkey")


@query("select (floor(x / 25e0)::bigint + 8 * floor(y / 25e0)::bigint + 64 * floor(z / 25e0)::bigint)::bigint as cell, count(*) as n from p group by 1")
def cell_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codec.encode_positions(views.particles(spark, sf_dir), BOX, 8)
    return coded.groupBy("cell").agg(F.count("*").alias("n"))


_PERCENTS = (1, 4, 5, 20, 30, 40)
_ENDS = [" + ".join(f"2 * ceil(m * {p} / 100e0 / 2)" for p in _PERCENTS[: n + 1]) for n in range(len(_PERCENTS) - 1)]
_SUBSAMPLE = f"case {' '.join(f'when n < {end} then {p}' for end, p in zip(_ENDS, _PERCENTS, strict=False))} else {_PERCENTS[-1]} end"


@query(f", r as (select l_partkey, row_number() over (order by {sql_mixed(_KEYS)}, {_K}) - 1 as n, count(*) over () as m from p) select ({_SUBSAMPLE})::int as subsample, count(*) as n, sum(l_partkey)::bigint as s from r group by 1")
def subsample_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codec.subsamples(views.particles(spark, sf_dir), _KEYS, _PERCENTS)
    return found.groupBy("subsample").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("s"))


_SNAPSHOT = f"s as (select {_K}, x, y, z, v as vx, w * 1e2 - 2500 as vy, 1e3 - v as vz, phi as potential from p)"


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.particles(spark, sf_dir).select(*_KEYS, F.col("l_orderkey").alias("id"), "x", "y", "z", F.col("v").alias("vx"), (F.col("w") * 100 - 2500).alias("vy"), (1000 - F.col("v")).alias("vz"), F.col("phi").alias("potential"))


def _sql_code(v: str, top: str) -> str:
    return f"round_even(greatest(0e0, least(4095e0, ({v} / {top} + 1) * 2047)), 0)::int"


@query(f", {_SNAPSHOT} select {_K}, l_orderkey as id, {', '.join(sql_round(f'({_sql_code(v, top)} / 2047e0 - 1) * {top}') + f' as {v}' for v, top in (('vx', '5e3'), ('vy', '5e3'), ('vz', '5e3'), ('potential', '1e5')))} from s")
def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities on three axes, the potential and the id through the whole codec."""
    coded = codec.encode_snapshot(_snapshot(spark, sf_dir), BOX, GRID, VMAX, 1e5)
    found = codec.decode_snapshot(coded, BOX, GRID, VMAX, 1e5)
    return found.select(*_KEYS, "id", *(rounded(c).alias(c) for c in ("vx", "vy", "vz", "potential")))


@query("select unnest(['L', 'Ngrid', 'vmax', 'Ndata']) as name, unnest(['200.0', '400', '5000.0', (select count(*) from lineitem)::varchar]) as value", views_of=False)
def codec_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxstats.sources import sinks

    rows = views.particles(spark, sf_dir).agg(F.count("*").cast("string").alias("n"))
    fixed = sinks.attributes({"L": BOX, "Ngrid": GRID, "vmax": VMAX})
    return rows.select(F.explode(F.map_concat(fixed, F.create_map(F.lit("Ndata"), "n"))).alias("name", "value"))


@query(f"""select (epoch_us(ts)::bigint // 86400000000)::bigint as snap, count(*) as n, {sql_round('avg(value)')} as mean, {sql_round('stddev_pop(value)')} as spread, min(value) as least, max(value) as largest from events group by 1""", views_of=False)
def snapshot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxstats.streaming.snapshots import summary

    found = summary(views.events(spark, sf_dir).withColumn("snap", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86400000000)), "snap", "value")
    return found.select("snap", "n", rounded("mean").alias("mean"), rounded("spread").alias("spread"), "least", "largest")

"""Queries on meshes, spectra, tensors and bias."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.operators import cosmology, mesh, neighbours, spectral, statistics
from boxstats.plans.registry import BOX, query, rounded, sql_round
from boxstats.sources import views

G = 8
#: Added before rounding: some modes are exact decimals that end in 5 behind the last digit kept, and
#: which way they go would follow the order of sums.
OFF_TIES = 33e-12
EDGES = spectral.log_edges(G, 4)
_SIDE = "25e0"  # of a cell


def _cell(a: str, g: int = G) -> str:
    return f"(floor({a} / {200 / g}e0)::bigint % {g})::int"


_IX = ", ".join(f"{_cell(a)} as i{a}" for a in "xyz")
_CELLS = f"cells as (select a::int as ix, b::int as iy, c::int as iz from range({G}) x(a), range({G}) y(b), range({G}) z(c))"
_CIC = f"""corners as (select c, c & 1 as cx, (c >> 1) & 1 as cy, (c >> 2) & 1 as cz from range(8) r(c)),
cic as (select {', '.join(f'((floor({a} / {_SIDE})::bigint + c{a}) % {G})::int as i{a}' for a in 'xyz')},
  sum({' * '.join(f'(case when c{a} = 1 then {a} / {_SIDE} - floor({a} / {_SIDE}) else 1 - ({a} / {_SIDE} - floor({a} / {_SIDE})) end)' for a in 'xyz')}) as value from p, corners group by 1, 2, 3),
n as (select count(*)::double as n from p)"""


def sql_transform(name: str, source: str, froms: str, tos: str, sign: int, pairs: list[tuple[str, str]], scale: str) -> str:
    """Three aggregations, an axis each."""
    steps, keys, at = [], [f"{froms}{a}" for a in "xyz"], source
    for n, a in enumerate("xyz"):
        here, to = f"{froms}{a}", f"{tos}{a}"
        others = [k for k in keys if k != here]
        angle = f"(({here} * {to}) % {G}) * ({sign}e0 * 2 * pi() / {G})"
        sums = ", ".join(f"sum({re} * cos({angle}) - {im} * sin({angle})) * {scale} as {re}, sum({re} * sin({angle}) + {im} * cos({angle})) * {scale} as {im}" for re, im in pairs)
        out = name if n == 2 else f"{name}{n}"
        steps.append(f"{out} as (select {', '.join(others)}, {to}, {sums} from {at}, (select k::int as {to} from range({G}) w(k)) group by all)")
        keys, at = [*others, to], out
    return ", ".join(steps)


def _signed(k: str) -> str:
    return f"(case when {k} >= {G // 2} then {k} - {G} else {k} end)"


_K2 = " + ".join(f"{_signed(k)} * {_signed(k)}" for k in ("kx", "ky", "kz"))
_SINC = " * ".join(f"(case when {k} = 0 then 1e0 else sin(pi() * ({_signed(k)} / {G}e0)) / (pi() * ({_signed(k)} / {G}e0)) end)" for k in ("kx", "ky", "kz"))
_SHELL = "case " + " ".join(f"when {_K2} >= {a ** 2!r}::double and {_K2} < {b ** 2!r}::double then {n}" for n, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False))) + " end"


def _modes(name: str, source: str, total: str) -> str:
    """The contrast's modes, without the mesh window."""
    raw = sql_transform(f"{name}_raw", f"(select ix, iy, iz, value as re, 0e0 as im from {source})", "i", "k", 1, [("re", "im")], "125e-3")
    factor = f"({G ** 3} / ({total} + 1e-15))"
    return f"""{raw}, {name} as (select kx, ky, kz, (re * {factor} - case when kx = 0 and ky = 0 and kz = 0 then 1e0 else 0e0 end) / pow({_SINC}, 2) as re, im * {factor} / pow({_SINC}, 2) as im from {name}_raw)"""


_MM = f"{_CIC}, {_modes('mm', 'cic', '(select n from n)')}"
_HCIC = _CIC.split("cic as", 1)[1].replace(" from p, ", " from h, ").replace("n as (select count(*)::double as n from p)", "hn as (select count(*)::double as n from h)")
_HH = f"hcic as{_HCIC}, {_modes('hh', 'hcic', '(select n from hn)')}"
_KTAB = "ktab as (select * from (values " + ", ".join(f"({n}, {2 * math.pi / BOX * math.sqrt(a * b)!r}::double)" for n, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False))) + ") t(bin, k))"


def _power(product: str, modes: str) -> str:
    return f"""sh as (select {_SHELL} as bin, count(*) as n_modes, sum({product}) as p from {modes} group by 1), pk as (select ktab.bin::int as bin, k, coalesce(n_modes, 0)::bigint as n_modes, coalesce(p, 0) * 8e6 / (coalesce(n_modes, 0) + 1e-15) as pk from ktab left join sh using (bin))"""


def _matter(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Modes of the particles' contrast (a few hundred rows: kept in memory for its many uses)."""
    particles = views.particles(spark, sf_dir)
    n = particles.count()
    return spectral.contrast_modes(mesh.cloud_in_cell(particles, G, BOX), G, n).persist(), n


def _tracers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    halos = views.halos(spark, sf_dir)
    n = halos.count()
    return spectral.contrast_modes(mesh.cloud_in_cell(halos, G, BOX), G, n).persist(), n


def _field(found: DataFrame, *values: str, digits: int = 6) -> DataFrame:
    return found.select("ix", "iy", "iz", *(rounded(v, digits).alias(v) for v in values or ("value",)))


@query(f"select {_IX}, count(*)::double as value from p group by 1, 2, 3")
def ngp_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.nearest_cell(views.particles(spark, sf_dir), G, BOX)


@query(f"select {_IX}, {sql_round('sum(w)')} as value from p group by 1, 2, 3")
def ngp_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(mesh.nearest_cell(views.particles(spark, sf_dir), G, BOX, "w"))


@query(f", {_CIC} select ix, iy, iz, {sql_round('value')} as value from cic")
def cic_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(mesh.cloud_in_cell(views.particles(spark, sf_dir), G, BOX))


@query(f", {_CIC}, {_CELLS} select ix, iy, iz, {sql_round(f'coalesce(value, 0) * {G ** 3} / ((select n from n) + 1e-15) - 1')} as value from cells left join cic using (ix, iy, iz)")
def density_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    particles = views.particles(spark, sf_dir)
    return _field(mesh.contrast(mesh.cloud_in_cell(particles, G, BOX), G, particles.count()))


@query(f", f as (select {_IX}, sum(w) as value from p group by 1, 2, 3) select (ix // 2)::int as ix, (iy // 2)::int as iy, (iz // 2)::int as iz, {sql_round('sum(value) / 8')} as value from f group by 1, 2, 3")
def coarsen_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(mesh.coarsened(mesh.nearest_cell(views.particles(spark, sf_dir), G, BOX, "w"), G, 2))


@query(f", f as (select {_IX}, avg(v) as d from p group by 1, 2, 3), m as (select avg(d) as m from f) select ix, iy, iz, {sql_round('(d - m) / (1 + m)', 4)} as value from f, m")
def cell_mean_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(mesh.cell_mean(views.particles(spark, sf_dir), G, BOX, "v"), digits=4)


@query(f", f as (select {_IX}, count(*)::double as value from p group by 1, 2, 3), a as (select id, {', '.join(f'(round_even({a} * {G} / 2e2, 0)::bigint % {G})::int as i{a}' for a in 'xyz')} from h) select id, value from a join f using (ix, iy, iz)")
def mesh_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = mesh.nearest_cell(views.particles(spark, sf_dir), G, BOX)
    return mesh.gathered(views.halos(spark, sf_dir), field, G, BOX).select("id", "value")


@query(f", {_CIC}, {sql_transform('m', '(select ix, iy, iz, value as re, 0e0 as im from cic)', 'i', 'k', 1, [('re', 'im')], '125e-3')} select kx, ky, kz, {sql_round('re + 33e-12')} as re, {sql_round('im + 33e-12')} as im from m")
def dft_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = spectral.forward(mesh.cloud_in_cell(views.particles(spark, sf_dir), G, BOX), G)
    return modes.select("kx", "ky", "kz", rounded(F.col("re") + OFF_TIES).alias("re"), rounded(F.col("im") + OFF_TIES).alias("im"))


@query(f", {_CIC}, {sql_transform('m', '(select ix, iy, iz, value as re, 0e0 as im from cic)', 'i', 'k', 1, [('re', 'im')], '125e-3')} select kx, ky, kz, {sql_round('re + 33e-12')} as re, {sql_round('im + 33e-12')} as im from m")
def fft_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = spectral.forward_slabs(mesh.cloud_in_cell(views.particles(spark, sf_dir), G, BOX), G)
    return modes.select("kx", "ky", "kz", rounded(F.col("re") + OFF_TIES).alias("re"), rounded(F.col("im") + OFF_TIES).alias("im"))


_PK = f"bin, {sql_round('k')} as k, n_modes, {sql_round('pk', 4)} as pk"


def _spectrum(found: DataFrame) -> DataFrame:
    return found.select("bin", rounded("k").alias("k"), "n_modes", rounded("pk", 4).alias("pk"))


@query(f", {_MM}, {_KTAB}, {_power('re * re + im * im', 'mm')} select {_PK} from pk")
def pk_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spectrum(spectral.power(_matter(spark, sf_dir)[0], BOX, G, EDGES))


@query(f", {_MM}, {_HH}, {_KTAB}, {_power('mm.re * hh.re + mm.im * hh.im', '(mm join hh using (kx, ky, kz))')} select {_PK} from pk")
def pk_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spectrum(spectral.power(_matter(spark, sf_dir)[0], BOX, G, EDGES, _tracers(spark, sf_dir)[0]))


@query(f", {_CIC}, {_HH}, {_KTAB}, {_power('re * re + im * im', 'hh')} select bin, {sql_round('k')} as k, n_modes, {sql_round('pk - 8e6 / (select n from hn)', 4)} as pk from pk")
def pk_shot_subtracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes, n = _tracers(spark, sf_dir)
    found = spectral.power(modes, BOX, G, EDGES)
    return _spectrum(found.withColumn("pk", F.col("pk") - BOX**3 / n))


def _kernel(k: str, radius: float) -> str:
    return "[" + ", ".join(f"{w!r}::double" for w in spectral.kernel(G, radius, BOX)) + f"][{k} + 1]"


_SMOOTH = " * ".join(_kernel(k, 20.0) for k in ("kx", "ky", "kz"))
_SMOOTHED = f"sm as (select kx, ky, kz, re * {_SMOOTH} as re, im * {_SMOOTH} as im from mm)"


@query(f", {_MM}, {_SMOOTHED}, {sql_transform('s', 'sm', 'k', 'i', -1, [('re', 'im')], '1e0')} select ix, iy, iz, {sql_round('re')} as value from s")
def gauss_smoothed_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = spectral.smoothed(_matter(spark, sf_dir)[0], G, 20.0, BOX)
    return _field(spectral.backward(modes, G, [("re", "im")]).withColumnRenamed("re", "value"))


def _tensor(kind: str) -> str:
    s = [f"sin({_signed(k)} * (2 * pi() / {G}))" for k in ("kx", "ky", "kz")]
    norm = "(" + " + ".join(f"{x} * {x}" for x in s) + " + 1e-15)"
    columns = []
    for name, i, j in (("11", 0, 0), ("22", 1, 1), ("33", 2, 2), ("12", 0, 1), ("13", 0, 2), ("23", 1, 2)):
        factor = f"{s[i]} * {s[j]} / {norm}" if kind == "tidal" else f"-{s[i]} * {s[j]}"
        columns += [f"re * ({factor}) as t{name}", f"im * ({factor}) as u{name}"]
    pairs = [(f"t{n}", f"u{n}") for n in _SIX]
    return f"td as (select kx, ky, kz, {', '.join(columns)} from sm), {sql_transform('ten', 'td', 'k', 'i', -1, pairs, '1e0')}"


_SIX = ("11", "22", "33", "12", "13", "23")
_TEN = ", ".join(f"{sql_round(f't{n}')} as t{n}" for n in _SIX)


def _tensors(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spectral.tensor(spectral.smoothed(_matter(spark, sf_dir)[0], G, 20.0, BOX), G, kind)


@query(f", {_MM}, {_SMOOTHED}, {_tensor('tidal')} select ix, iy, iz, {_TEN} from ten")
def tidal_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(_tensors(spark, sf_dir, "tidal"), *(f"t{n}" for n in _SIX))


@query(f", {_MM}, {_SMOOTHED}, {_tensor('hessian')} select ix, iy, iz, {_TEN} from ten")
def hessian_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(_tensors(spark, sf_dir, "hessian"), *(f"t{n}" for n in _SIX))


_EIG = """q1 as (select *, (t11 + t22 + t33) / 3 as q from {0}), q2 as (select *, sqrt((pow(t11 - q, 2) + pow(t22 - q, 2) + pow(t33 - q, 2) + 2 * (t12 * t12 + t13 * t13 + t23 * t23)) / 6) as p from q1),
q3 as (select *, ((t11 - q) * ((t22 - q) * (t33 - q) - t23 * t23) - t12 * (t12 * (t33 - q) - t23 * t13) + t13 * (t12 * t23 - (t22 - q) * t13)) / (2 * p * p * p) as r from q2),
q4 as (select *, acos(greatest(-1e0, least(1e0, r))) / 3 as phi from q3), eig as (select *, q + 2 * p * cos(phi + 2 * pi() / 3) as lam1, q + 2 * p * cos(phi) as lam3 from q4)"""


@query(f", {_MM}, {_SMOOTHED}, {_tensor('tidal')}, {_EIG.format('ten')} select ix, iy, iz, {sql_round('lam1')} as lam1, {sql_round('3 * q - lam1 - lam3')} as lam2, {sql_round('lam3')} as lam3 from eig")
def tidal_eigenvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spectral.eigenvalues(_tensors(spark, sf_dir, "tidal")), "lam1", "lam2", "lam3")


@query(f", {_MM}, {_SMOOTHED}, {_tensor('tidal')}, {_EIG.format('ten')}, l as (select ix, iy, iz, lam1, 3 * q - lam1 - lam3 as lam2, lam3 from eig) select ix, iy, iz, {sql_round('sqrt((pow(lam3 - lam1, 2) + pow(lam3 - lam2, 2) + pow(lam2 - lam1, 2)) / 2) / (1 + lam1 + lam2 + lam3)', 5)} as alpha from l")
def tidal_anisotropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spectral.anisotropy(spectral.eigenvalues(_tensors(spark, sf_dir, "tidal"))), "alpha", digits=5)


def _pull() -> str:
    s = [f"sin({_signed(k)} * (2 * pi() / {G}))" for k in ("kx", "ky", "kz")]
    norm = "(" + " + ".join(f"{x} * {x}" for x in s) + " + 1e-15)"
    columns = ", ".join(f"-im * {x} / {norm} as a{n}, re * {x} / {norm} as b{n}" for n, x in enumerate(s, 1))
    return f"ad as (select kx, ky, kz, {columns} from sm), {sql_transform('acc', 'ad', 'k', 'i', -1, [(f'a{n}', f'b{n}') for n in (1, 2, 3)], '1e0')}"


@query(f", {_MM}, {_SMOOTHED}, {_pull()} select ix, iy, iz, {', '.join(f'{sql_round(f"a{n}")} as a{n}' for n in (1, 2, 3))} from acc")
def acceleration_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes = spectral.smoothed(_matter(spark, sf_dir)[0], G, 20.0, BOX)
    return _field(spectral.acceleration(modes, G), "a1", "a2", "a3")


_RADII, _LAMS = (15.0, 25.0, 40.0), ("lam1", "lam2", "lam3")


@query()
def tidal_interp_r200b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each halo's eigenvalues at a multiple of its own radius, interpolated in log radius
    between fields smoothed on three scales."""
    modes, _ = _matter(spark, sf_dir)
    halos = views.halos(spark, sf_dir)
    fields = None
    for n, radius in enumerate(_RADII):
        field = spectral.eigenvalues(spectral.tensor(spectral.smoothed(modes, G, radius, BOX), G)).select(*mesh.CELL, *(F.col(lam).alias(f"{lam}_{n}") for lam in _LAMS))
        fields = field if fields is None else fields.join(field, list(mesh.CELL))
    lr = F.log10(20 * 0.894 * F.cbrt(F.col("m200b") / 6.4173e13))
    at = mesh.gathered(halos.select("id", "x", "y", "z", lr.alias("lr")), fields, G, BOX)
    knots = {lam: [(math.log10(radius), F.col(f"{lam}_{n}")) for n, radius in enumerate(_RADII)] for lam in _LAMS}
    return at.select("id", *(rounded(statistics.between(F.col("lr"), knots[lam])).alias(lam) for lam in _LAMS))


_BIAS = f"""waves as (select bin, re, im, {_signed('kx')}::double as qx, {_signed('ky')}::double as qy, {_signed('kz')}::double as qz from (select *, {_SHELL} as bin from mm) where bin is not null),
s as (select id, bin, sum(cos(a) * re + sin(a) * im) as s from (select id, bin, re, im, (qx * x + qy * y + qz * z) * (2 * pi() / 2e2) as a from h, waves) group by 1, 2),
b as (select id, bin, k, n_modes, pk, s / n_modes * 8e6 / (pk + 1e-15) as bk from s join pk using (bin))"""


def _by_shell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectral.bias(views.halos(spark, sf_dir), _matter(spark, sf_dir)[0], BOX, G, EDGES)


@query(f", {_MM}, {_KTAB}, {_power('re * re + im * im', 'mm')}, {_BIAS} select id, {sql_round('sum(n_modes * pk * bk) / sum(n_modes * pk)', 5)} as b1 from b group by 1")
def halo_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectral.halo_bias(_by_shell(spark, sf_dir)).select("id", rounded("b1", 5).alias("b1"))


@query(f", {_MM}, {_KTAB}, {_power('re * re + im * im', 'mm')}, {_BIAS} select bin::int as bin, {sql_round('avg(bk)', 5)} as b1 from b group by 1")
def mean_bias_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_shell(spark, sf_dir).groupBy("bin").agg(rounded(F.avg("bk"), 5).alias("b1"))


@query(f""", {_MM}, {_KTAB}, {_power('re * re + im * im', 'mm')}, {_BIAS}, f as (select id, sum(n_modes * pk) as f0, sum(n_modes * pk * k * k) as f2, sum(n_modes * pk * k * k * k * k) as f4, sum(n_modes * pk * bk) as g0, sum(n_modes * pk * k * k * bk) as g2 from b group by 1)
select id, {sql_round('(g0 * f4 - g2 * f2) / (f0 * f4 - f2 * f2)', 4)} as b10, {sql_round('(g2 * f0 - g0 * f2) / (f0 * f4 - f2 * f2)', 2)} as b11 from f""")
def bias_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    modes, _ = _matter(spark, sf_dir)
    ks = spectral.power(modes, BOX, G, EDGES).select("bin", "k")
    return spectral.bias_fit(_by_shell(spark, sf_dir), ks).select("id", rounded("b10", 4).alias("b10"), rounded("b11", 2).alias("b11"))


@query(f"select n::int as step, {sql_round('pow(1e1, log10(a) + (log10(b) - log10(a)) * n / 29e0)')} as radius from range(30) r(n), (select {cosmology.ladder(BOX, 64, 0.3)[0]!r}::double as a, {cosmology.ladder(BOX, 64, 0.3)[-1]!r}::double as b)", views_of=False)
def smoothing_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    scales = cosmology.ladder(BOX, 64, 0.3)
    return spark.createDataFrame(list(enumerate(scales)), "step int, radius double").select("step", rounded("radius").alias("radius"))


@query(f""", d as (select h.id, p.l_orderkey, p.w, {', '.join(f'((({f"p.{a} - h.{a} + 1e2"}) % 2e2 + 2e2) % 2e2) - 1e2 as d{a}' for a in 'xyz')} from h, p where {' and '.join(f'least(abs(p.{a} - h.{a}), 2e2 - abs(p.{a} - h.{a})) <= 1e1' for a in 'xyz')}),
r as (select *, sqrt(dx * dx + dy * dy + dz * dz) as r from d) select id, {', '.join(f'{sql_round(f"sum(w * d{a} / pow(r, 3))", 4)} as a{a}' for a in 'xyz')} from r where r >= 1 + id % 3 and r <= 1e1 group by id""")
def aext_shell(spark: SparkSession, sf_dir: str) -> DataFrame:
    halos = views.halos(spark, sf_dir).select("id", "x", "y", "z", (1 + F.col("id") % 3).cast("double").alias("low"))
    tracers = views.particles(spark, sf_dir).select(F.col("l_orderkey").alias("tid"), "x", "y", "z", "w")
    found = neighbours.shell_pull(halos, tracers, BOX, "low", 10.0, "w")
    return found.select("id", *(rounded(f"a{a}", 4).alias(f"a{a}") for a in "xyz"))

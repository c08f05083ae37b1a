"""Queries on catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.functions import scalars
from boxstats.operators import catalog, sampling, statistics
from boxstats.plans.registry import BOX, query, rounded, sql_mixed, sql_mod, sql_round
from boxstats.sources import views

H, MPART = 0.6736, 1e9
LOW, WIDTH, BINS = 11.0, 0.1, 48
_TAGS = ("mvir", "m200b", "m200c")
_HOSTS = "m200b >= 1e9 * 200 and tbyu > 25e-2 and tbyu < 75e-2 and pid = -1"
_LGM = "log10(m / 6736e-4)"
_VOLUME = "pow(2e2 / 6736e-4, 3)"


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.prepared(views.halos(spark, sf_dir), "m200b", MPART, 200, BOX, 0.5)


_MF = ", ".join(f"{sql_round(f'coalesce(n_{t}, 0) / (1e-1 * ln(1e1)) / {_VOLUME}', 12)} as dndlnm_{t}" for t in _TAGS)


@query(f""", hosts as (select * from h where {_HOSTS}),
each as (select tag, unnest_m as m from (select unnest(['mvir', 'm200b', 'm200c']) as tag, unnest([mvir, m200b, m200c]) as unnest_m from hosts)),
slots as (select tag, least(floor(({_LGM} - 11e0) / 1e-1), 47)::int as bin from each where {_LGM} >= 11e0 and {_LGM} <= 11e0 + 1e-1 * 48),
n as (select bin, count(*) filter (tag = 'mvir') as n_mvir, count(*) filter (tag = 'm200b') as n_m200b, count(*) filter (tag = 'm200c') as n_m200c from slots group by bin)
select r.b::int as bin, {sql_round('pow(1e1, 11e0 + (r.b + 5e-1) * 1e-1) / 1e9', 4)} as mass_1e9, {_MF}
from range(48) r(b) left join n on n.bin = r.b""")  # fmt: skip
def mass_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = statistics.mass_function(_prepared(spark, sf_dir), _TAGS, LOW, WIDTH, BINS, BOX, H)
    return found.select("bin", rounded(F.col("mass") / 1e9, 4).alias("mass_1e9"), *(rounded(f"dndlnm_{t}", 12).alias(f"dndlnm_{t}") for t in _TAGS))


@query(f"select id, tbyu from h where {_HOSTS}")
def relaxed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("id", "tbyu")


@query("select id from h where m200b >= 1e9 * 50000")
def massdef_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolved(views.halos(spark, sf_dir), "m200b", MPART, 50000).select("id")


@query(f"select id, {', '.join(f'{sql_round(sql_mod(f'{a} + {s}', '200e0'))} as {a}' for a, s in (('x', '15e1'), ('y', '-15e1'), ('z', '4e2')))} from h")
def periodic_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = views.halos(spark, sf_dir).withColumns({"x": F.col("x") + 150, "y": F.col("y") - 150, "z": F.col("z") + 400})
    return catalog.wrapped(moved, BOX).select("id", *(rounded(a).alias(a) for a in "xyz"))


@query(f"select id, {sql_round(sql_mod('z + vz / (1e2 * 5e-1)', '200e0'))} as z from h")
def rsd_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.redshift_space(views.halos(spark, sf_dir), BOX, 0.5).select("id", rounded("z").alias("z"))


@query(f"select id, {sql_round(sql_mod('z + vz / (1e2 * 5e-1) / sqrt(3e-1 * 8 + 7e-1)', '200e0'))} as z from h")
def rsd_shift_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.redshift_space(views.halos(spark, sf_dir), BOX, 0.5, om=0.3, ol=0.7).select("id", rounded("z").alias("z"))


@query("select id from h where (x - 1e2) * (x - 1e2) + (y - 1e2) * (y - 1e2) + (z - 1e2) * (z - 1e2) <= 6e1 * 6e1")
def radius_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cropped(views.halos(spark, sf_dir), (100.0, 100.0, 100.0), 60.0).select("id")


@query("select id from h where mvir >= 20 * 1e9 and mvir * 5e-1 < m200c and m200c >= 15e8")
def printable_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.printable(views.halos(spark, sf_dir), MPART, 20, 0.5).select("id")


@query("select id from h where id % 10 = 0")
def id_thinning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.thinned(views.halos(spark, sf_dir), 10).select("id")


@query("select (case when x > 1e2 then 1 else 0 end + case when y > 1e2 then 2 else 0 end + case when z > 1e2 then 4 else 0 end)::int as octant, count(*) as n from h group by 1")
def octant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.halos(spark, sf_dir).groupBy(catalog.octant(BOX).alias("octant")).agg(F.count("*").alias("n"))


@query(f"select {sql_round('avg(case when pid <> -1 then 1e0 else 0e0 end)', 9)} as satellite_fraction from h")
def satellite_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.satellite_fraction(views.halos(spark, sf_dir)).select(rounded("satellite_fraction", 9).alias("satellite_fraction"))


@query(f"select {sql_round('sum(m200b) / (16777216e0 * 4e10)', 9)} as mass_fraction from h")
def tracer_mass_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.mass_fraction(views.halos(spark, sf_dir), "m200b", 256**3, 4e10).select(rounded("mass_fraction", 9).alias("mass_fraction"))


@query("select id from (select id from h order by m200b desc, id desc limit 130)")
def topn_by_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    halos = views.halos(spark, sf_dir)
    found = catalog.densest(halos, 5e-6, BOX, H, "m200b", MPART)
    return (halos.limit(0) if found is None else found).select("id")


@query("select id from h where id in (select pid from h)")
def membership_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    halos = views.halos(spark, sf_dir)
    return catalog.members(halos, halos.select(F.col("pid").alias("id"))).select("id")


@query("select id from h where id not in (select pid from h)")
def membership_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    halos = views.halos(spark, sf_dir)
    return catalog.members(halos, halos.select(F.col("pid").alias("id")), inside=False).select("id")


@query("select id, x, tbyu, pid from h")
def column_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    basic, extended = catalog.families(views.halos(spark, sf_dir), ["x", "y", "z", "m200b"])
    return basic.join(extended, "id").select("id", "x", "tbyu", "pid")


@query(", v as (select l_partkey as id, sum(l_quantity) as mass_in from lineitem group by 1) select h.id, coalesce(v.mass_in, 0e0) as mass_in from h left join v using (id)")
def value_added_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = views.particles(spark, sf_dir).groupBy(F.col("l_partkey").alias("id")).agg(F.sum("w").alias("mass_in"))
    return catalog.with_values(views.halos(spark, sf_dir), values, fill=0.0, columns=("mass_in",)).select("id", "mass_in")


_REGION = "(" + " + ".join(f"{w} * (floor(4 * {a} / 2e2)::bigint % 4)" for a, w in (("x", 16), ("y", 4), ("z", 1))) + ")::int"


@query(f"select {_REGION} as region, count(*) as n from h group by 1")
def jackknife_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.halos(spark, sf_dir).groupBy(catalog.region(64, BOX).alias("region")).agg(F.count("*").alias("n"))


@query("select (5 * (floor(5 * x / 2e2)::bigint % 5) + floor(5 * y / 2e2)::bigint % 5)::int as region, count(*) as n from h group by 1")
def jackknife_labels_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.halos(spark, sf_dir).groupBy(catalog.region(25, BOX).alias("region")).agg(F.count("*").alias("n"))


@query(f""", r as (select {_REGION} as region, sum(m200b) as m, count(*) as n from h group by 1), t as (select sum(m) as am, sum(n) as an, count(*) as k from r),
v as (select (am - m) / (an - n) / 1e9 as v, k from r, t)
select {sql_round('avg(v)', 3)} as mean, {sql_round('sqrt(max(k) - 1) * stddev_pop(v)', 3)} as error from v""")
def jackknife_mean_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = views.halos(spark, sf_dir).withColumn("region", catalog.region(64, BOX))
    found = statistics.jackknife_sums(labelled, "region", {"m": F.sum("m200b"), "n": F.count("*")}, ("m", "n"))
    return found.select(rounded(F.col("mean") / 1e9, 3).alias("mean"), rounded(F.col("error") / 1e9, 3).alias("error"))


@query(f""", r as (select {_REGION} as region, tbyu from h), k as (select unnest(range(64))::int as left_out),
e as (select left_out, quantile_cont(tbyu, 5e-1) as v from k join r on r.region <> k.left_out group by 1)
select {sql_round('avg(v)', 6)} as mean, {sql_round('sqrt(63e0) * stddev_pop(v)', 6)} as error from e""")
def jackknife_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = views.halos(spark, sf_dir).withColumn("region", catalog.region(64, BOX))
    found = statistics.jackknife(labelled, "region", 64, lambda d, by: d.groupBy(*by).agg(F.percentile("tbyu", 0.5).alias("v")), "v")
    return found.select(rounded("mean").alias("mean"), rounded("error").alias("error"))


@query(f"select {sql_round('n * 2.5e1', 6)} as percent, {sql_round('v', 9)} as tbyu from (select unnest(range(5)) as n, unnest(quantile_cont(tbyu, [0e0, 25e-2, 5e-1, 75e-2, 1e0])) as v from h)")
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = statistics.percentiles(views.halos(spark, sf_dir), "tbyu", [0.0, 0.25, 0.5, 0.75, 1.0])
    return found.select(rounded("perc").alias("percent"), rounded("value", 9).alias("tbyu"))


@query(""", w as (select l_extendedprice as v, sum(l_quantity) as w from lineitem group by 1), c as (select v, sum(w) over (order by v) as cum, sum(w) over () as total from w)
select 16e0 as perc, min(v) filter (cum > 16e-2 * total) as value from c union all select 5e1, min(v) filter (cum > 5e-1 * total) from c union all select 84e0, min(v) filter (cum > 84e-2 * total) from c""", views_of=False)
def weighted_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return statistics.weighted_percentile(rows, "l_extendedprice", "l_quantity", [0.16, 0.5, 0.84])


@query(f""", m as (select p_size as b, sum(p_retailprice) as v from part group by 1), d as (select b, (8 * (lead(v, 1) over w - lag(v, 1) over w) - (lead(v, 2) over w - lag(v, 2) over w)) / 12e0 as d from m window w as (order by b))
select b, {sql_round('d', 4)} as derivative from d where d is not null""")
def five_point_derivative(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.col("p_size").alias("b")).agg(F.sum("p_retailprice").alias("v"))
    return statistics.five_point(sums.withColumn("g", F.lit(1)), ["g"], "b", "v", 1.0).select("b", rounded("derivative", 4).alias("derivative"))


@query(f""", t as (select l_linenumber as g, cast(l_quantity as bigint)::double as x, avg(l_extendedprice) as y from lineitem group by 1, 2),
d as (select g, (y + lag(y) over w) / 2 * (x - lag(x) over w) as a from t window w as (partition by g order by x))
select g, {sql_round('sum(a) / 1e3', 4)} as integral from d group by g""")
def trapezoid_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    curve = rows.groupBy(F.col("l_linenumber").alias("g"), F.col("l_quantity").cast("long").cast("double").alias("x")).agg(F.avg("l_extendedprice").alias("y"))
    return statistics.trapezoid(curve, ["g"], "x", "y").select("g", rounded(F.col("integral") / 1e3, 4).alias("integral"))


@query(f""", t as (select id, m200b as m, 25e-2 + tbyu as v from h where id % 7 = 0), a as (select h.id, h.m200b as m, (select max(m) from t where t.m <= h.m200b) as ma, (select min(m) from t where t.m >= h.m200b) as mb from h),
tv as (select m, min(v) as v from t group by m), b as (select a.*, ta.v as va, tb.v as vb from a left join tv ta on ta.m = a.ma left join tv tb on tb.m = a.mb)
select id, {sql_round('case when ma is null then vb when mb is null or ma = mb then va else exp(ln(va) + (ln(m) - ln(ma)) * (ln(vb) - ln(va)) / (ln(mb) - ln(ma))) end')} as v from b""")
def loglog_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    halos = views.halos(spark, sf_dir).withColumn("g", F.lit(0))
    table = catalog.thinned(halos, 7).groupBy("g", F.col("m200b").alias("m")).agg(F.min(0.25 + F.col("tbyu")).alias("v"))
    return statistics.aligned(halos.select("g", "id", F.col("m200b").alias("m")), table, ["g"], "m", "v", logs=True).select("id", rounded("v").alias("v"))


@query(f"select id, {sql_round('case when t <= 2e-1 then 1e0 when t <= 5e-1 then 1e0 + (t - 2e-1) * ((4e0 - 1e0) / (5e-1 - 2e-1)) when t <= 9e-1 then 4e0 + (t - 5e-1) * ((2e0 - 4e0) / (9e-1 - 5e-1)) else 2e0 end')} as v from (select id, tbyu as t from h)")
def table_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.interpolated(views.halos(spark, sf_dir), [(0.2, 1.0), (0.5, 4.0), (0.9, 2.0)], "tbyu", "v").select("id", rounded("v").alias("v"))


@query(f"select id, {sql_round('log10(m200b / 1e12)')} as log10_k, {sql_round('log10(pow(m200b / 1e12, 3) * tbyu / (2 * pi() * pi()))')} as log10_delta2 from h")
def transfer_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxstats.operators.cosmology import transfer

    rows = views.halos(spark, sf_dir).select("id", (F.col("m200b") / 1e12).alias("k"), F.col("tbyu").alias("p"))
    return transfer(rows, "id").select("id", rounded("log10_k").alias("log10_k"), rounded("log10_delta2").alias("log10_delta2"))


_EZ = "sqrt(3e-1 * pow(1 + z, 3) + 0e0 * pow(1 + z, 2) + 7e-1 * pow(a, -3 * (1 + w)))"


@query(f""", s as (select id, 1e-1 + tbyu * 8e-1 as a from h), t as (select id, a, 1 / a - 1 as z, -9e-1 + 1e-1 - 1e-1 * (a - 1) / ln(a) as w from s)
select id, {sql_round('z')} as z, {sql_round(_EZ)} as ez from t""")
def expansion_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.halos(spark, sf_dir).select("id", (0.1 + F.col("tbyu") * 0.8).alias("a"))
    z = scalars.redshift(F.col("a"))
    return rows.select("id", rounded(z).alias("z"), rounded(scalars.expansion(z, 0.3, 0.7, -0.9, 0.1)).alias("ez"))


@query(f"select {sql_round('sum(l_quantity * l_discount) / sum(l_quantity)', 9)} as mean, {sql_round('(sum(l_quantity * l_discount * l_discount) / sum(l_quantity) - pow(sum(l_quantity * l_discount) / sum(l_quantity), 2)) / (1 - sum(l_quantity * l_quantity) / pow(sum(l_quantity), 2))', 9)} as variance from lineitem", views_of=False)
def weighted_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = statistics.moments(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_quantity", "l_discount")
    return found.select(rounded("mean", 9).alias("mean"), rounded("variance", 9).alias("variance"))


@query(f"select id, {sql_round('tbyu / (select avg(tbyu) from h)', 9)} as tbyu from h")
def mean_normalised_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.mean_normalised(views.halos(spark, sf_dir), "tbyu").select("id", rounded("tbyu", 9).alias("tbyu"))


@query(f"select {sql_round('sum((m200c / mvir - 1) * (m200c / mvir - 1))')} as chi2 from h")
def chi_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.chi_square(views.halos(spark, sf_dir), "m200c", "mvir").select(rounded("chi2").alias("chi2"))


@query(f""", b as (select floor(log10(m200b) * 2)::int as bin, count(*) as n, quantile_cont(tbyu, 5e-1) as med, avg(tbyu) as mean from h where pid = -1 group by 1)
select bin, n, {sql_round('med')} as median, {sql_round('mean')} as mean, sum(n) over (order by bin desc)::bigint as above, {sql_round('1 / sqrt(n)')} as poisson, {sql_round('sqrt(2 / n)')} as gaussian from b""")
def mass_bin_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = catalog.hosts(views.halos(spark, sf_dir))
    by = hosts.groupBy(F.floor(F.log10("m200b") * 2).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.percentile("tbyu", 0.5).alias("median"), F.avg("tbyu").alias("mean"))
    found = statistics.count_errors(statistics.cumulative_above(by, "bin", "n"), "n")
    return found.select("bin", "n", "above", *(rounded(c).alias(c) for c in ("median", "mean", "poisson", "gaussian")))


@query("""select o_orderkey as id, substr(cast(o_orderkey % 1000 + 1000 as varchar), 1, 3) as prefix, count(*) as n from orders join (select unnest(range(1000, 2000)) as f) s on substr(cast(o_orderkey % 1000 + 1000 as varchar), 1, 3) = substr(cast(s.f as varchar), 1, 3) group by 1, 2""", views_of=False)
def scale_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 1000 + 1000).cast("string").alias("scale"))
    files = spark.range(1000, 2000).select(F.col("id").cast("string").alias("file_scale"))
    return catalog.matched_scale(snaps, files, 3).groupBy("id", F.substring("scale", 1, 3).alias("prefix")).agg(F.count("*").alias("n"))


@query(f"""select i as qid, {', '.join(f"{sql_round(f'(i * {s} + 500000) % 1000000 / 1e6 * 200e0')} as {a}" for a, s in zip('xyz', (819172, 671043, 549700)))} from (select o_orderkey as i from orders)""", views_of=False)
def sequence_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("qid"))
    top = keys.agg(F.max("qid")).first()[0]
    return sampling.sequence_points(spark, top + 1, BOX).join(keys, "qid").select("qid", *(rounded(a).alias(a) for a in "xyz"))


@query()
def uniform_randoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.randoms(spark, views.points(spark, sf_dir).count(), BOX)


@query()
def spherical_randoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracers = views.halos(spark, sf_dir).select(F.col("id").alias("tid"), "x", "y", "z", F.cbrt(F.col("m200b") / 1e13).alias("radius"))
    return sampling.spheres(tracers, "radius", 20 * tracers.count(), BOX)


@query()
def latin_hypercube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.latin_hypercube(spark, 128, 4, symmetric=True)


@query(f"select * from p order by {sql_mixed(('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber'), 7)}, l_orderkey, l_partkey, l_suppkey, l_linenumber limit 1000")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    particles = views.particles(spark, sf_dir)
    return sampling.chosen(particles, 1000, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@query("select id, m200b as \"M200b\", mvir as \"Mvir\", m200c as \"M200c\" from h")
def massdef_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.upper_masses(views.halos(spark, sf_dir)).select("id", "M200b", "Mvir", "M200c")


@query(f"select id, {sql_round('pow(m200b / 1e13, 7e-1) * pow(1 + tbyu, -3e-1) * 2')} as weight from h")
def dust_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxstats.operators import predictors

    weight = predictors.dust(F.col("m200b") / 1e13, F.col("tbyu"), F.lit(2.0), 0.7, -0.3)
    return views.halos(spark, sf_dir).select("id", rounded(weight).alias("weight"))


@query(f""", t as (select m200b / 1e13 as w, tbyu as d, pow(m200b / 1e13, 75e-2) * pow(1 + tbyu, -5e-1) * (1 + (id % 3 - 1) / 1e1) as data from h),
g as (select a / 4e0 as a, b / 4e0 as b from range(0, 7) x(a), range(-4, 3) y(b)), c as (select a, b, sum(pow(pow(w, a) * pow(1 + d, b) / data - 1, 2)) as c from t, g group by a, b)
select {sql_round('arg_min(a, c)', 3)} as by_mass, {sql_round('arg_min(b, c)', 3)} as by_density, {sql_round('min(c)', 3)} as cost from c""")
def dust_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the least cost, in steps of a quarter."""
    from boxstats.operators import predictors

    model = lambda p: predictors.dust(F.col("w"), F.col("tbyu"), F.lit(1.0), p[0], p[1])
    rows = views.halos(spark, sf_dir).withColumn("w", F.col("m200b") / 1e13)
    rows = rows.withColumn("data", model([0.75, -0.5]) * (1 + (F.col("id") % 3 - 1) / 10.0))
    (by_mass, by_density), cost = predictors.fitted(rows, model, "data", [0.5, 0.0], step=0.25, least=0.25)
    return spark.createDataFrame([(by_mass, by_density, cost)], "by_mass double, by_density double, cost double").select(*(rounded(c, 3).alias(c) for c in ("by_mass", "by_density", "cost")))

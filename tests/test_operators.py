"""Operators against brute force and closed forms."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxstats.functions import scalars
from boxstats.operators import catalog, codec, mesh, neighbours, pairs, sampling, spectral, statistics, tessellation
from boxstats.streaming import snapshots

BOX = 50.0


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    # a clump and a few far away, so that the first cells don't reach
    points = np.concatenate([rng.normal(10, 2, (150, 3)) % BOX, rng.uniform(0, BOX, (20, 3))])
    return points, spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "tid long, x double, y double, z double")


def distances(a, b, box=BOX):
    d = np.abs(a[:, None] - b[None])
    return np.sqrt((np.minimum(d, box - d) ** 2).sum(-1))


def test_knn_widens_until_sure(spark, cloud):
    points, tracers = cloud
    queries = np.random.default_rng(6).uniform(0, BOX, (60, 3))
    frame = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(queries)], "qid long, x double, y double, z double")
    found = {(r.qid, r.k): r.r for r in neighbours.nearest(frame, tracers, BOX, ks=(1, 2, 4)).collect()}
    expected = np.sort(distances(queries, points), axis=1)
    assert len(found) == 180
    for (q, k), r in found.items():
        assert abs(r - expected[q, k - 1]) < 1e-9


def test_pairs_and_cross(spark, cloud):
    points, tracers = cloud
    frame = tracers.withColumnRenamed("tid", "id")
    found = [r.pairs for r in pairs.isotropic(frame, BOX, 2.0, 6).orderBy("bin").collect()]
    d = distances(points, points)
    np.fill_diagonal(d, np.inf)
    assert found == [int(((d > 2 * b) & (d <= 2 * b + 2)).sum()) for b in range(6)]
    xi = pairs.cross_landy_szalay(frame, frame, frame, frame, BOX, 2.0, 6).collect()
    assert all(abs(r.xi) < 1e-9 for r in xi)


def test_pairs_without_periods_and_in_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 40)
    rng = np.random.default_rng(3)
    points = np.concatenate((rng.uniform(0, BOX, (150, 3)), rng.normal(3.0, 0.4, (200, 3)).clip(0, BOX)))
    frame = spark.createDataFrame([(i, *map(float, p), float(i % 5)) for i, p in enumerate(points)], "id long, x double, y double, z double, m double")
    side = np.abs(points[:, None] - points)
    for periodic in (False, True):
        d = np.sqrt(((np.minimum(side, BOX - side) if periodic else side) ** 2).sum(-1))
        np.fill_diagonal(d, np.inf)
        inside = [(d > 2 * b) & (d <= 2 * b + 2) for b in range(3)]
        found = pairs.isotropic(frame, BOX, 2.0, 3, mark="m", periodic=periodic).orderBy("bin").collect()
        assert [r.pairs for r in found] == [int(x.sum()) for x in inside]
        m = np.arange(len(points)) % 5 / np.mean(np.arange(len(points)) % 5)
        assert np.allclose([r.marked for r in found], [(np.outer(m, m) * x).sum() for x in inside])


def test_blocks_are_cut_once(monkeypatch):
    """A block that meets many others is cut into boxes once; places of as many points lie in boxes of their own."""
    rng = np.random.default_rng(23)
    blocks = []
    for k in range(6):
        points = np.zeros(400, pairs.POINT)
        for c in "xyz":
            points[c] = rng.uniform(0, 10, 400)
        points["n"] = 1 + np.arange(400) % 2
        blocks.append(points)
    cut, whole = [], pairs._split
    monkeypatch.setattr(pairs, "_split", lambda *of: cut.append(whole(*of)) or cut[-1])
    monkeypatch.setattr(pairs, "SIDE", 64)
    met = [(i, j) for i in range(6) for j in range(i, 6)]
    columns = [pa.array([i == j for i, j in met]), *(pa.array([blocks[m[k]].tobytes() for m in met], pa.binary()) for k in (0, 1))]
    found = list(pairs._count(pairs.Bins("r", 2.0, 3), None, True, False, 0)(iter([pa.RecordBatch.from_arrays(columns, ["same", "points", "others"])])))[0]
    assert len(cut) == 6 and all(box["each"] for boxes in cut for box in boxes)
    every = np.concatenate(blocks)
    at = np.stack([every[c] for c in "xyz"], axis=1)
    d = np.sqrt(((at[:, None] - at) ** 2).sum(-1))
    n = np.outer(every["n"], every["n"])
    wanted = [int(n[(d > 2 * b) & (d <= 2 * b + 2)].sum()) for b in range(3)]
    assert found.column("pairs").to_pylist() == wanted


def test_rounds_of_nearest_do_not_pile_up(spark):
    """Queries that need several rounds: no round's plan has the searches before it."""
    rng = np.random.default_rng(29)
    points = np.concatenate((rng.uniform(0, 2, (4000, 3)), rng.uniform(0, BOX, (40, 3))))
    tracers = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points[:4000])], "tid long, x double, y double, z double")
    queries = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points[3990:])], "qid long, x double, y double, z double")
    found = neighbours.nearest(queries, tracers, BOX)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftSemi" not in plan
    d = distances(points[3990:], points[:4000])
    assert {r.qid: r.tid for r in found.collect()} == dict(enumerate(d.argmin(axis=1).tolist()))


def test_friends(spark, cloud):
    points, tracers = cloud
    found = {r.id: r.group for r in neighbours.friends(tracers.withColumnRenamed("tid", "id"), BOX, 1.5).collect()}
    d = distances(points, points) <= 1.5
    group = list(range(len(points)))
    for _ in group:
        group = [min(group[j] for j in np.flatnonzero(d[i])) for i in range(len(points))]
    assert found == dict(enumerate(group))


def test_weighted_nearest_of_equal_weights(spark, cloud):
    _, tracers = cloud
    queries = tracers.withColumnRenamed("tid", "qid")
    found = neighbours.weighted_nearest(queries, tracers.withColumn("w", F.lit(2.0)), BOX, 3)
    assert found.where("qid <> tid or r > 0").isEmpty()


def test_slab_fft_and_round_trip(spark):
    rng = np.random.default_rng(1)
    g, values = 6, rng.normal(size=(6, 6, 6))
    field = spark.createDataFrame([(i, j, k, float(values[i, j, k])) for i in range(g) for j in range(g) for k in range(g)], "ix int, iy int, iz int, value double")
    expected = np.fft.ifftn(values)
    for modes in (spectral.forward(field, g), spectral.forward_slabs(field, g)):
        assert max(abs(complex(r.re, r.im) - expected[r.kx, r.ky, r.kz]) for r in modes.collect()) < 1e-12
    back = spectral.backward(spectral.forward(field, g), g, [("re", "im")])
    assert max(abs(r.re - values[r.ix, r.iy, r.iz]) for r in back.collect()) < 1e-12


def test_eigenvalues(spark):
    rng = np.random.default_rng(2)
    rows = [tuple(map(float, rng.normal(size=6))) for _ in range(40)] + [(1.0, 1.0, 1.0, 0.0, 0.0, 0.0), (2.0, 2.0, -1.0, 0.0, 0.0, 0.0)]
    frame = spark.createDataFrame(rows, ", ".join(f"t{n} double" for n in ("11", "22", "33", "12", "13", "23")))
    for r in spectral.eigenvalues(frame).collect():
        a, b, c, d, e, f = r[:6]
        assert np.allclose(np.linalg.eigvalsh([[a, d, e], [d, b, f], [e, f, c]]), [r.lam1, r.lam2, r.lam3], atol=1e-7)


def test_cic_conserves_and_coarsens(spark, cloud):
    _, tracers = cloud
    field = mesh.cloud_in_cell(tracers, 8, BOX)
    assert abs(field.agg(F.sum("value")).first()[0] - 170) < 1e-9
    assert mesh.contrast(field, 8, 170).count() == 512
    assert abs(mesh.contrast(field, 8, 170).agg(F.sum("value")).first()[0]) < 1e-6
    with pytest.raises(ValueError):
        mesh.coarsened(field, 8, 3)


@pytest.mark.parametrize("little", [True, False])
def test_codes_round_trip(spark, little):
    rows = spark.range(4096).select(F.col("id").cast("int").alias("q0"), ((F.col("id") * 7 + 5) % 4096).cast("int").alias("q1"))
    b = rows.select("q0", "q1", *(x.alias(f"b{i}") for i, x in enumerate(codec.pack(F.col("q0"), F.col("q1"), little))))
    a, c = codec.unpack(F.col("b0"), F.col("b1"), F.col("b2"), little)
    assert b.where((a != F.col("q0")) | (c != F.col("q1")) | (F.greatest("b0", "b1", "b2") > 255)).isEmpty()


def test_codec_edges(spark):
    rows = spark.createDataFrame([(-7000.0,), (-5000.0,), (0.0,), (5000.0,), (9000.0,)], "v double")
    assert [r[0] for r in rows.select(codec.quantise(F.col("v"), 5000.0)).collect()] == [0, 0, 2047, 4094, 4095]
    assert [r[0] for r in spark.range(1).select(codec.decode_integer(F.lit(5))).collect()] == [-2042]
    with pytest.raises(ValueError):
        codec.clipped(rows, "v", 24)
    with pytest.raises(ValueError):
        codec.split(rows, ["v"], [50, 40])


def test_odd_pairs_are_an_error(spark):
    rows = spark.createDataFrame([(1, 5, 0), (1, 6, 1), (1, 7, 2)], "g int, code int, o int")
    with pytest.raises(Exception, match="even"):
        codec.packed_pairs(rows, "code", ["o"], ["g"]).collect()


def test_jackknife_of_a_sum_agrees(spark):
    rows = spark.range(320).select((F.col("id") % 8).cast("int").alias("region"), (F.col("id") * F.col("id") % 97).cast("double").alias("v"))
    slow = statistics.jackknife(rows, "region", 8, lambda d, by: d.groupBy(*by).agg(F.avg("v").alias("s")), "s").first()
    fast = statistics.jackknife_sums(rows, "region", {"v": F.sum("v"), "n": F.count("*")}, ("v", "n")).first()
    assert np.allclose(slow, fast)


def test_regions_and_names():
    assert scalars.perfect_power(64, 3) and scalars.perfect_power(100, 2) and not scalars.perfect_power(100, 3)
    assert scalars.file_number(7e-4) == "7p00em4"
    assert scalars.template("snap_<snap>.<block>", snap=7) == "snap_7.<block>"
    assert catalog.least_particles(256**3, 256) == 5
    with pytest.raises(ValueError):
        catalog.region(50, BOX)


def test_stretch_and_window_functions(spark):
    row = spark.range(1).select(scalars.unstretch(scalars.stretch(F.lit(0.3))), scalars.sinc(F.lit(0.5)), scalars.heaviside(F.lit(0.0)), scalars.signed_min_image(F.lit(-30.0), 50.0)).first()
    assert np.allclose(row, (0.3, 2 / math.pi, 0.5, 20.0))


def test_too_few_objects(spark, cloud):
    _, tracers = cloud
    rows = tracers.withColumnRenamed("tid", "id").withColumn("m", F.lit(1e12))
    assert catalog.densest(rows, 1.0, BOX, 0.7, "m", 1e9) is None
    assert catalog.densest(rows, 120 / (BOX / 0.7) ** 3, BOX, 0.7, "m", 1e9).count() in (119, 120)
    assert catalog.densest(rows, 120 / (BOX / 0.7) ** 3, BOX, 0.7, "m", 1e11) is None


def test_negative_weights_are_an_error(spark):
    with pytest.raises(Exception, match="negative"):
        statistics.mean_normalised(spark.createDataFrame([(1.0,), (-1.0,)], "w double"), "w").collect()


def test_substructure_is_greedy(spark):
    tracers = spark.createDataFrame([(1, 25.0, 25.0, 25.0, 9.0, 6.0), (2, 27.0, 25.0, 25.0, 5.0, 4.0), (3, 45.0, 45.0, 45.0, 4.0, 1.0)], "tid long, x double, y double, z double, m double, radius double")
    owned = sampling.spheres(tracers, "radius", 900, BOX).drop("n")
    found = {r.tid: r.parent for r in tessellation.substructure(tracers, owned, BOX).collect()}
    assert found == {2: 1}


@pytest.mark.parametrize("wide", [1.0, 6.0])
def test_substructure_against_all_pairs(spark, monkeypatch, wide):
    """Hulls across the box's ends, and wider than half of it; points are never joined to hulls as rows."""
    monkeypatch.setattr(tessellation, "near", None, raising=False)
    monkeypatch.setattr(tessellation, "POINTS", 150, raising=False)
    rng = np.random.default_rng(21)
    at, mass = rng.uniform(0, BOX, (60, 3)), rng.permutation(60) + 1.0
    tracers = spark.createDataFrame([(i, *map(float, p), float(mass[i]), float(wide * mass[i] ** (1 / 3))) for i, p in enumerate(at)], "tid long, x double, y double, z double, m double, radius double")
    owned = sampling.spheres(tracers, "radius", 1500, BOX).drop("n").localCheckpoint()
    rows = owned.toPandas()
    points, of = rows[["x", "y", "z"]].to_numpy(), rows.tid.to_numpy()
    k = np.arange(32) + 0.5
    mu, phi = 1 - 2 * k / 32, np.pi * (1 + 5**0.5) * k
    d = np.stack([np.sqrt(1 - mu * mu) * np.cos(phi), np.sqrt(1 - mu * mu) * np.sin(phi), mu])
    held = {}
    for p in range(60):
        off = (points - at[p] + BOX / 2) % BOX - BOX / 2
        mine = of == p
        inside = ((off**2).sum(1) <= (off[mine] ** 2).sum(1).max()) & (off @ d <= (off[mine] @ d).max(0)).all(1)
        held[p] = {t for t in of[inside].tolist() if mass[t] < mass[p]}
    parent = {}
    standing = []
    for p in np.argsort(-mass).tolist():
        if not any(p in held[q] for q in standing):
            standing.append(p)
        else:
            parent[p] = max((q for q in standing if p in held[q]), key=lambda q: mass[q])
    assert parent and {r.tid: r.parent for r in tessellation.substructure(tracers, owned, BOX).collect()} == parent


def test_substructure_makes_few_overlaps(spark, monkeypatch):
    """Taken a few at a time, the heaviest first, tracers get the same parents; overlaps of hulls that are
    swallowed aren't made."""
    rows, whole = [], tessellation.cut

    def cut(df):
        out = whole(df)
        if "pm" in df.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(tessellation, "cut", cut)
    rng = np.random.default_rng(22)
    tracers = spark.createDataFrame([(i, *map(float, p), float(i // 2 + 1), float(4 * (i // 2 + 1) ** (1 / 3))) for i, p in enumerate(rng.uniform(0, BOX, (150, 3)))], "tid long, x double, y double, z double, m double, radius double")
    n, cubes = tracers.agg(F.count("*"), sampling.cubed("radius")).first()
    owned = sampling.spheres(tracers, "radius", 20 * n, BOX).drop("n")
    at_once = sorted(tessellation.substructure(tracers, owned, BOX).collect())
    made = sum(rows)
    rows.clear()
    monkeypatch.setattr(tessellation, "LEAST", 10)
    few = tessellation.substructure(tracers, lambda some: sampling.spheres(some, "radius", 20 * n, BOX, keep=("m", "cx", "cy", "cz"), cubes=cubes), BOX)
    assert sorted(few.collect()) == at_once and len(at_once) > 100
    assert sum(rows) < made / 4


def test_split_cells_clip(spark):
    tracers = spark.createDataFrame([(1, 25.0, 25.0, 25.0, 4.0)], "tid long, x double, y double, z double, radius double")
    cells = spark.createDataFrame([(1, -3.0)], "tid long, delta double")
    found = tessellation.split_cells(tracers, cells, "radius", 50, 8, BOX).collect()
    assert found and all(r.value == -1 for r in found)


def test_weighted_randoms(spark):
    points = sampling.randoms(spark, 2000, BOX)
    weights = spark.createDataFrame([(0, 0, 0, 1.0), (1, 0, 0, 0.0)], "ix int, iy int, iz int, value double")
    found = sampling.weighted_randoms(points, weights, 2, BOX).toPandas()
    assert 150 < len(found) < 350 and (found[["x", "y", "z"]] < 25).all().all()


def test_streamed_snapshots(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 4).alias("snap"), F.col("id").cast("double").alias("value"))
    rows.repartition(4, "snap").write.parquet(str(tmp_path / "in"))
    stream = snapshots.arrivals(spark, str(tmp_path / "in"), rows.schema)
    snapshots.for_each_snapshot(stream, "snap", lambda d: snapshots.summary(d, "snap", "value"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("snap").collect()
    assert [(r.snap, r.n, r["mean"]) for r in found] == [(k, 10, 18.0 + k) for k in range(4)]


def test_exact_subsamples(spark):
    frame = spark.range(1000).repartition(3)
    found = {r.subsample: r["count"] for r in codec.subsamples(frame, ["id"], [1, 4, 5, 20, 70]).groupBy("subsample").count().collect()}
    assert found == {1: 10, 4: 40, 5: 50, 20: 200, 70: 700}
    small = {r.subsample: r["count"] for r in codec.subsamples(spark.range(30), ["id"], [10, 15, 75]).groupBy("subsample").count().collect()}
    assert small == {10: 4, 15: 6, 75: 20}
    again = [codec.subsamples(frame.repartition(n), ["id"], [30, 70]).where("subsample = 30").agg({"id": "sum"}).first()[0] for n in (1, 5)]
    assert again[0] == again[1]
    assert codec.subsamples(frame.limit(0), ["id"], [30, 70]).count() == 0


def test_orders_by_cell_and_tracer(spark):
    frame = spark.createDataFrame([(i, (i * 7) % 5) for i in range(40)], "qid long, tid long").repartition(4)
    parts = neighbours.by_tracer(frame).rdd.glom().collect()
    flat = [(r.tid, r.qid) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 40
    cells = [r.cell for p in codec.by_cell(frame.withColumnRenamed("tid", "cell")).rdd.glom().collect() for r in p]
    assert cells == sorted(cells)


def test_predictor_and_fit(spark):
    from boxstats.operators import predictors

    cells = spark.createDataFrame([(i, 0.3 * (i * 7 % 10), 1.0 + i) for i in range(10)] + [(99, -1.0, 2.0)], "id long, delta double, w double")
    found = {r.id: r.matter for r in predictors.predicted(cells, lambda p, d, w: p[0] * d + w, [2.0]).collect()}
    raw = np.array([(1 + 0.3 * (i * 7 % 10)) ** 2 * (1.0 + i) for i in range(10)])
    assert np.allclose([found[i] for i in range(10)], raw / raw.mean()) and found[99] == 0
    model = lambda p: predictors.dust(F.col("w"), F.col("delta"), F.lit(1.0), p[0], p[1])
    best, cost = predictors.fitted(cells.where("delta > -1").withColumn("data", model([0.75, -0.5])), model, "data", [0.5, 0.0], step=0.25)
    assert np.allclose(best, [0.75, -0.5], atol=0.01) and cost < 1e-3


def test_pairs_at_the_edges_of_mu(spark, duck, compare):
    """Cosines of 0.6 and 0.8 between points at three decimals: the last bits decide the bin."""
    import random

    from boxstats.plans.registry import sql_distance

    rng, rows = random.Random(4), []
    for n in range(0, 600, 2):
        at = [rng.randrange(200_000) for _ in range(3)]
        by = rng.randint(500, 6000)
        side = rng.choice([(4, 0, 3), (0, 3, -4), (3, 0, 4), (-4, 0, -3)])
        rows += [(n, *(v / 1000 for v in at)), (n + 1, *((v + by * d) % 200_000 / 1000 for v, d in zip(at, side, strict=True)))]
    points = spark.createDataFrame(rows, "id long, x double, y double, z double")
    duck.register("edges", points.toPandas())
    pair = f"select {sql_distance('a', 'b')} as r, (((b.z - a.z + 1e2) % 2e2 + 2e2) % 2e2) - 1e2 as dz from edges a, edges b where a.id <> b.id"
    expected = duck.sql(f"select (ceil(r / 5e0) - 1)::int as bin, greatest(0, least(floor((dz / r + 1) / 2 * 10), 9))::int as mu_bin, count(*) as pairs from ({pair}) where r > 0 and r <= 4e1 group by 1, 2")
    compare(pairs.anisotropic(points, 200.0, 5.0, 8, 10).where("pairs > 0").toPandas(), expected.df())


def test_points_at_one_place_and_blocks_that_arent_collected(spark):
    """Copies at a place count as so many, and blocks of points are never broadcast."""
    rows = [(n, 1.0 + n % 2, 1.0, 1.0, 2.0, n % 2) for n in range(3000)]
    frame = spark.createDataFrame(rows, "id long, x double, y double, z double, m double, g int")
    found = pairs.counted(frame, pairs.Bins("r", 2.0, 3), BOX, mark="m", region="g", regions=2)
    assert sorted(map(tuple, found.collect())) == [(0, 0, 1500**2, 4.0 * 1500**2, 2 * 1500**2), (1, 0, 1500**2, 4.0 * 1500**2, 2 * 1500**2)]
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bins", [pairs.Bins("r", 5.0, 3), pairs.Bins("s_mu", 5.0, 3, 4), pairs.Bins("s_mu", 5.0, 3, 7), pairs.Bins("s_mu", 2.5, 6, 10), pairs.Bins("rp_pi", 5.0, 3, 3, 5.0)])
@pytest.mark.parametrize("periodic", [True, False])
def test_pairs_on_the_edges_of_bins(spark, monkeypatch, bins, periodic):
    """Places on a lattice lie on edges of all kinds; boxes that many pairs cross the box's ends of,
    with regions, marks and several points a place. Few pairs are looked at one by one."""
    seen = []
    whole = pairs._one_by_one
    monkeypatch.setattr(pairs, "_one_by_one", lambda *of: seen.append(len(of[4])) or whole(*of))
    monkeypatch.setattr(pairs, "SIDE", 32)
    rng = np.random.default_rng(17)
    points = rng.integers(0, 50, (700, 3)) * 1.0
    points[350:] += rng.uniform(0, 0.5, (350, 3)).round(3)
    region, mark = (points[:, 0] >= 25).astype(int), rng.integers(1, 5, 700) * 1.0
    tally = pairs._Tally(bins, 2)
    boxes = pairs._split({"x": points[:, 0].copy(), "y": points[:, 1].copy(), "z": points[:, 2].copy(), "n": np.where(np.arange(700) % 9, 1.0, 3.0), "mark": mark, "region": region.astype(np.int32)}, 32, 2)
    for i, a in enumerate(boxes):
        for b in boxes[i:]:
            pairs._between(bins, BOX if periodic else None, tally, a, b, a is b, True, True)
    x = {c: np.concatenate([v[c] for v in boxes]) for c in ("x", "y", "z", "n", "mark")}
    of = np.repeat([v["region"] for v in boxes], [len(v["x"]) for v in boxes])
    i, j = (v.ravel() for v in np.indices((700, 700)))
    slot = whole(bins, BOX if periodic else None, x, x, i, j, 1)
    good = slot >= 0
    i, j, slot = i[good], j[good], slot[good]
    n = x["n"][i] * x["n"][j]
    for r in range(2):
        part = slice(r * bins.size, (r + 1) * bins.size)
        begin, touch = of[i] == r, (of[i] == r) | (of[j] == r)
        assert (tally.pairs[part] == np.bincount(slot[begin], n[begin], bins.size)).all()
        assert (tally.touching[part] == np.bincount(slot[touch], n[touch], bins.size)).all()
        assert np.allclose(tally.marked[part], np.bincount(slot[begin], (x["mark"][i] * x["mark"][j])[begin], bins.size))
    assert periodic or sum(seen) < 700 * 700 / 4


def test_nearest_of_crowded_tracers(spark, monkeypatch):
    """Tracers at one place, ties to the smaller id, cells of many queries in parts; candidates are never rows of a join."""
    monkeypatch.setattr(neighbours, "QUERIES", 20, raising=False)
    rng = np.random.default_rng(8)
    points = np.concatenate((np.repeat(rng.uniform(0, BOX, (60, 3)).round(1), 5, axis=0), rng.normal(20, 0.5, (700, 3)), rng.uniform(0, BOX, (200, 3))))
    asked = np.concatenate((rng.uniform(0, BOX, (150, 3)), rng.normal(20, 1, (100, 3))))
    frames = [spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(of)], f"{key} long, x double, y double, z double") for of, key in ((points, "tid"), (asked, "qid"))]
    found = neighbours.nearest(frames[1], frames[0], BOX, ks=(1, 2, 3, 4))
    d = distances(asked, points)
    order = np.lexsort((np.broadcast_to(np.arange(len(points)), d.shape), d.round(12)), axis=1)
    assert {(r.qid, r.k): r.tid for r in found.collect()} == {(q, k + 1): int(order[q, k]) for q in range(len(asked)) for k in range(4)}
    assert "[ix#" not in found._jdf.queryExecution().optimizedPlan().toString().replace("(ix#", "[ix#")


def test_nearest_of_copies_and_with_further_columns(spark, monkeypatch):
    """Of tracers at one place no more go on than are asked for; what queries have besides comes back."""
    seen = []
    whole = neighbours._placed
    monkeypatch.setattr(neighbours, "_placed", lambda *of: seen.append(of) or whole(*of))
    rng = np.random.default_rng(4)
    places, asked = rng.uniform(0, BOX, (40, 3)), rng.uniform(0, BOX, (30, 3))
    tracers = spark.createDataFrame([(i, *map(float, places[i % 40])) for i in range(40 * 400)], "tid long, x double, y double, z double")
    frame = spark.createDataFrame([(i, f"n{i}", *map(float, p)) for i, p in enumerate(asked)], "qid long, name string, x double, y double, z double")
    d = distances(asked, places)
    for most in (1, 3):
        found = neighbours.nearest(frame, tracers, BOX, ks=tuple(range(1, most + 1)), keep=("name",)).collect()
        assert {(r.qid, r.name, r.k): r.tid for r in found} == {(q, f"n{q}", k + 1): int(d[q].argmin()) + 40 * k for q in range(30) for k in range(most)}
    assert max(m * inner for m, inner, *_ in seen) <= 4  # a mesh for 40 places, not for 16,000 tracers


@pytest.mark.parametrize("step", [0.5, 0.001])
def test_layers_against_all_pairs(spark, monkeypatch, step):
    """Pairs across and along the z axis by region, over the box's ends, at edges of bins and of several points
    at one place; distances along the axis are never made for all."""
    monkeypatch.setattr(pairs, "_between", None)
    monkeypatch.setattr(pairs, "NARROW", 8, raising=False)
    monkeypatch.setattr(pairs, "SIDE", 16)
    rng = np.random.default_rng(23)
    at = np.floor(rng.uniform(0, BOX, (500, 3)) / step) * step
    at = np.concatenate((at, at[:60], at[:20], at[:100] + [5.0, 0.0, 2.5], at[:100] - [3.0, 4.0, 7.5])) % BOX
    region = (2 * at[:, 0] // BOX).astype(int)
    points = spark.createDataFrame([(*map(float, p), int(r)) for p, r in zip(at, region, strict=True)], "x double, y double, z double, region int")
    bins = pairs.Bins("rp_pi", 2.5, 4, 4, 2.5)
    found = {(r.region, r.slot): (r.pairs, r.touching) for r in pairs.counted(points, bins, BOX, region="region", regions=2).collect()}
    d = np.abs(at[:, None] - at)
    d = np.minimum(d, BOX - d)
    rp, up = np.sqrt(d[..., 0] * d[..., 0] + d[..., 1] * d[..., 1]), d[..., 2]
    slot = np.where((rp > 0) & (rp <= 10) & (up > 0) & (up <= 10), (np.ceil(rp / 2.5) - 1) * 4 + np.ceil(up / 2.5) - 1, -1)
    expected = {}
    for r in range(2):
        one, two = (region == r)[:, None], region == r
        for n in range(16):
            counts = (int(((slot == n) & one).sum()), int(((slot == n) & (one | two)).sum()))
            if counts[1]:
                expected[r, n] = counts
    assert found == expected


def test_shell_pull_collects_no_halos(spark, data):
    """Only the number of parts by cell is broadcast, however small Spark takes the halos to be."""
    from boxstats.plans import queries

    plan = queries.QUERIES["aext_shell"](spark, data)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert all("Join [cell#" in line for line in plan if "BroadcastHashJoin" in line)
    assert sum("SortMergeJoin" in line for line in plan) == 2


def test_shell_pull_of_places_and_parts(spark, monkeypatch):
    """As by pairs, across the box's ends and on the shells' edges; pairs are never rows."""
    monkeypatch.setattr(neighbours, "TRACERS", 30, raising=False)
    rng = np.random.default_rng(9)
    points, asked = rng.integers(0, 50, (900, 3)) * 1.0, rng.integers(0, 50, (80, 3)) * 1.0
    points[::2] += 0.125
    low, weight = np.arange(80) % 3 + 1.0, rng.integers(1, 9, 900) * 1.0
    halos = spark.createDataFrame([(i, *map(float, asked[i % 80]), float(low[i % 80])) for i in range(160)], "id long, x double, y double, z double, low double")
    tracers = spark.createDataFrame([(i, *map(float, p), float(weight[i])) for i, p in enumerate(points)], "tid long, x double, y double, z double, w double")
    found = neighbours.shell_pull(halos, tracers, BOX, "low", 5.0, "w")
    assert "tid" not in found._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]
    d = (points[None] - asked[:, None] + BOX / 2) % BOX - BOX / 2
    r = np.sqrt((d * d).sum(-1))
    inside = (r >= low[:, None]) & (r <= 5.0)
    pull = np.where(inside[..., None], weight[:, None] * d / np.where(inside, r, 1)[..., None] ** 3, 0).sum(axis=1)
    rows = {x.id: (x.ax, x.ay, x.az) for x in found.collect()}
    assert set(rows) == {i for i in range(160) if inside[i % 80].any()}
    assert all(np.allclose(v, pull[i % 80], atol=1e-9) for i, v in rows.items())


def test_friends_of_chains_and_copies(spark, monkeypatch):
    """Chains across cells and the box's ends, and thousands of copies; links are never rows."""
    monkeypatch.setattr(neighbours, "within", None)
    rng = np.random.default_rng(12)
    chain = (np.outer(np.arange(90), [1.4, 0.9, 0.7]) + 3) % 100.0
    points = np.concatenate((chain, rng.uniform(0, 100, (300, 3)), np.full((3000, 3), 77.0)))[rng.permutation(3390)]
    near = distances(points, points, 100.0) <= 2.0
    label = np.arange(len(points))
    while True:
        low = np.where(near, label, len(points)).min(axis=1)
        if (low == label).all():
            break
        label = low
    frame = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, x double, y double, z double")
    assert {r.id: r.group for r in neighbours.friends(frame, 100.0, 2.0).collect()} == dict(enumerate(label.tolist()))


def test_percentiles_of_counted_values(spark):
    """A row that stands for several counts as them, within each group."""
    values = [(g, float(v), c) for g in range(3) for v, c in ((1, 4), (2.5, 1), (7, 6 + g), (9, 2))]
    frame = spark.createDataFrame(values, "g int, v double, c long")
    found = {(r.g, r.perc): r.value for r in statistics.percentiles(frame, "v", (0.16, 0.5, 0.84), ["g"], "c").collect()}
    for g in range(3):
        each = np.concatenate([np.full(c, v) for h, v, c in values if h == g])
        assert [found[g, 100 * a] for a in (0.16, 0.5, 0.84)] == pytest.approx(np.quantile(each, (0.16, 0.5, 0.84)))


def test_between_knots(spark):
    xs = [-1.0, 0.0, 0.4, 1.0, 1.7, 3.0, 5.0]
    frame = spark.createDataFrame([(x, 2.0, -1.0, 4.0) for x in xs], "x double, a double, b double, c double")
    found = frame.select(statistics.between(F.col("x"), [(k, F.col(c)) for k, c in ((0.0, "a"), (1.0, "b"), (3.0, "c"))]).alias("y"))
    assert [r.y for r in found.collect()] == pytest.approx(np.interp(xs, [0, 1, 3], [2, -1, 4]))

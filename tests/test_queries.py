"""Every query against its oracle, or for what can be said of it otherwise."""

import pytest

import __spark_entry__ as entry
from boxstats.plans import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, data, duck, compare, name):
    found = queries.QUERIES[name](spark, data)
    relation = duck.sql(queries.ORACLES[name])
    compare(found.toPandas(), relation.df())


def test_entry(spark):
    assert entry.entry(spark).count() == 48


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_randoms_are_uniform_and_repeatable(spark, data):
    first = queries.QUERIES["uniform_randoms"](spark, data).toPandas().sort_values("qid")
    again = queries.QUERIES["uniform_randoms"](spark, data).toPandas().sort_values("qid")
    assert (first.to_numpy() == again.to_numpy()).all()
    assert ((first[["x", "y", "z"]] >= 0) & (first[["x", "y", "z"]] < 200)).all().all()
    assert abs(first.x.mean() - 100) < 10


def test_latin_hypercube_strata(spark, data):
    found = queries.QUERIES["latin_hypercube"](spark, data).toPandas().sort_values("i")
    for c in ("p0", "p1", "p2", "p3"):
        assert sorted((found[c] * 128 - 0.5).round().astype(int)) == list(range(128))
        assert abs(found[c].to_numpy() + found[c].to_numpy()[::-1] - 1).max() < 1e-12


def test_subsamples_cover_all(spark, data):
    found = queries.QUERIES["subsample_split"](spark, data).toPandas()
    assert found.n.sum() == spark.read.parquet(f"{data}/lineitem.parquet").count()
    assert set(found.subsample) == {1, 4, 5, 20, 30, 40}


def test_halos_are_interpolated_in_place(spark, data):
    """No order over all halos and their fields' values, and no row of a halo for each range of it."""
    plan = queries.QUERIES["tidal_interp_r200b"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_volumes_are_counted_before_they_are_left_out(spark, data):
    plan = queries.QUERIES["vvf_jackknife"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert "Aggregate [region#" in plan[len(above) :].split("Join")[0]


@pytest.mark.parametrize("name", ["knn_cdf_jackknife", "matter_voronoi"])
def test_points_are_not_joined_to_their_neighbours(spark, data, name):
    """What a point has besides its place goes through the search with it."""
    plan = queries.QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (qid#" not in plan

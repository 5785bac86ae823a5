"""Inputs that must not lose data silently: nulls, ragged vectors, extra
flags, gaps in positions, loops that do not converge -- alike in any layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions.labels import dictionary_names, flag_labels_array, flag_labels_text
from lodestar.functions.vectors import check_vectors, squared_distance
from lodestar.operators import cluster, pca, recommend, regression, splits, stats


def _wide(spark, cols, parts):
    """Rows 1..6 of ``cols`` columns; the null stands in the last."""
    rng = np.random.default_rng(cols)
    x = rng.integers(-5, 6, (6, cols)).astype(float)
    rows = [[float(v) for v in r] for r in x]
    rows[5][0] = None
    names = [f"c{i}" for i in range(cols)]
    return x[:5], spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).coalesce(1).repartition(parts), names


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("cols", [24, 25])
def test_null_in_a_gram_matrix(spark, cols, parts):
    x, df, names = _wide(spark, cols, parts)
    with pytest.raises(Exception, match="null or NaN"):
        stats.gram(df, names)
    g, _, n = stats.gram(df, names, na="drop")
    assert n == 5 and np.array_equal(g, x.T @ x)
    nan = df.fillna({"c0": float("nan")})
    g, _, n = stats.gram(nan, names, na="drop")
    assert n == 5 and np.array_equal(g, x.T @ x)


@pytest.mark.parametrize("parts", [1, 8])
def test_null_coordinate_in_a_covariance(spark, parts):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(9)]
    bad = spark.createDataFrame([*rows, (9, [None, 1.0]), (10, None), (11, [1.0, 2.0, 3.0])],
                                "id long, v array<double>").coalesce(1).repartition(parts)
    with pytest.raises(Exception, match="coordinates"):
        stats.covariance_long(bad, "v", 2).collect()
    cov = stats.covariance_long(bad, "v", 2, na="drop").collect()
    want = np.cov(np.array([r[1] for r in rows]), rowvar=False)
    assert len(cov) == 4 and all(abs(r["cov"] - want[r["i"], r["j"]]) < 1e-12 for r in cov)


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("d", [256, 257])
def test_ragged_vectors_are_refused_at_any_width(spark, d, parts):
    whole, longer = [1.0] * d, [1.0] * d + [9.0]
    df = spark.createDataFrame([(i, whole, 0) for i in range(7)] + [(7, longer, 0)],
                               "id long, v array<double>, g int").coalesce(1).repartition(parts)
    for job in (lambda: cluster.rank_by_centre_distance(df, "g", "id", "v", 3, d).collect(),
                lambda: stats.covariance_long(df, "v", d).collect(),
                lambda: recommend.recommend_for_user(whole, df.withColumnRenamed("v", "features"), 3, d).collect(),
                lambda: pca.project(df, "v", np.eye(d, 2)).collect(),
                lambda: cluster.lloyd_kmeans(df, "v", 1, id_col="id", centres=[whole])):
        with pytest.raises(Exception, match="coordinates|imension"):
            job()
    kept, _ = check_vectors(df, "v", d, "drop")
    assert [r[0] for r in kept.select(squared_distance("v", [0.0] * d, d)).collect()] == [float(d)] * 7


def test_flags_and_names_must_match(spark):
    df = spark.createDataFrame([([0, 0, 1],)], "f array<int>")
    for expr in (flag_labels_text("f", ["a", "b"]), flag_labels_array("f", ["a", "b"]), flag_labels_text("f", list("abcd"))):
        with pytest.raises(Exception, match="flags for"):
            df.select(expr).collect()
    assert df.select(flag_labels_text("f", list("abc"))).first()[0] == "c|"
    names = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, name string")
    assert dictionary_names(names, 2) == ["a", "b"]
    for width in (1, 3):
        with pytest.raises(ValueError):
            dictionary_names(names, width)


@pytest.mark.parametrize("positions", [[0, 1, 2, 100, 101], [0, 1, 1, 3], [0, 0, 2], [5, 6, None]])
def test_kfold_needs_dense_positions(spark, positions):
    df = spark.createDataFrame([(p,) for p in positions], "pos long")
    with pytest.raises(ValueError, match="dense"):
        splits.kfold_by_position(df, "pos", 5)


def test_kfold_on_dense_positions(spark):
    df = spark.createDataFrame([(p,) for p in (9, 7, 8, 10, 6)], "pos long")
    assert {r["pos"]: r["fold"] for r in splits.kfold_by_position(df, "pos", 5).collect()} == {6 + i: i for i in range(5)}
    assert splits.kfold_by_position(df.limit(0), "pos", 5).collect() == []


def test_unconverged_lloyd_raises(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(40)], "id long, v array<double>")
    with pytest.raises(cluster.NotConvergedError):
        cluster.lloyd_kmeans(df, "v", 4, id_col="id", max_iter=1, tol=0.0)
    done = cluster.lloyd_kmeans(df, "v", 4, id_col="id")
    assert done.converged and done.shifts[-1] <= 1e-4
    assert not cluster.lloyd_kmeans(df, "v", 4, id_col="id", fixed_iterations=1).converged


def test_kth_smallest(spark):
    values = [3, 10**12, -5, 77, 78, 79, 10**6, 4]
    df = spark.createDataFrame([(v,) for v in values], "p long")
    for k in range(1, 9):
        assert splits.kth_smallest(df, "p", k, buckets=3) == sorted(values)[k - 1]
    assert splits.kth_smallest(df, "p", 9) is None


def test_ols_on_a_hundred_features(spark):
    rng = np.random.default_rng(5)
    x, w = rng.normal(0, 1, (400, 100)), rng.normal(0, 1, 100)
    y = x @ w + 3.0
    names = [f"f{i}" for i in range(100)]
    df = spark.createDataFrame([[*map(float, r), float(t), 1.0] for r, t in zip(x, y, strict=True)],
                               ", ".join(f"{n} double" for n in [*names, "y", "intercept"]))
    got = regression.ols_fit(df, [*names, "intercept"], "y")
    assert np.allclose([got[n] for n in names], w, atol=1e-9) and abs(got["intercept"] - 3.0) < 1e-9


def test_seeded_kmeans_does_not_depend_on_the_input_layout(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for mode in ("k-means||", "random"):
        centres = [cluster.mllib_kmeans(d, "v", "id", 5, seed=3, init_mode=mode, rows_per_partition=100)[0].clusterCenters()
                   for d in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("id")))]
        assert all(np.allclose(centres[0], c) for c in centres[1:])


def test_normal_equations_hold_and_detect_a_wrong_model(spark):
    rng = np.random.default_rng(4)
    r = spark.createDataFrame([(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(9) if (u + i) % 3],
                              "user long, item long, rating double")
    model = recommend.als_fit(r, rank=3, max_iter=5, reg=0.1, seed=1, blocks=2)
    good = recommend.normal_equation_residuals(model.userFactors, model.itemFactors, r, 0.1)
    assert good.count() == 12 and good.agg(F.max("residual")).first()[0] < 1e-3
    other = model.userFactors.withColumn("features", F.transform("features", lambda x: x * 1.5))
    assert recommend.normal_equation_residuals(other, model.itemFactors, r, 0.1).agg(F.min("residual")).first()[0] > 0.05

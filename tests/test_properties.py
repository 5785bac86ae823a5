"""Property checks: splits partition the input, repartitioning
does not change results, normal equations hold, k-means cost does not grow,
PCA components are orthonormal, blocked and unrolled moments agree."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.functions.vectors import vector_dim
from lodestar.operators import cluster, pca, regression, splits, stats
from lodestar.plans import relations as R


def test_holdout_partitions_and_is_stable(spark):
    r = R.ratings(spark, SF_SMALL)
    tr, te = splits.holdout_split(r, ["user", "item"])
    n = r.count()
    assert tr.count() + te.count() == n
    assert tr.join(te, ["user", "item"]).count() == 0
    tr2, _ = splits.holdout_split(r.repartition(7), ["user", "item"])
    assert sorted(tr.select("user", "item").collect()) == sorted(tr2.select("user", "item").collect())


def test_sample_k_is_stable_under_repartition(spark):
    p = R.points(spark, SF_SMALL)
    a = [r[0] for r in splits.sample_k(p, "vec_id", 7, seed=3).select("vec_id").collect()]
    b = [r[0] for r in splits.sample_k(p.repartition(5), "vec_id", 7, seed=3).select("vec_id").collect()]
    assert a == b and len(set(a)) == 7


def test_dense_position_equals_row_number(spark):
    r = R.ratings(spark, SF_SMALL).select("user", "item").repartition(6)
    pos = splits.with_dense_position(r, ["user", "item"], "pos")
    expect = r.withColumn("pos", F.row_number().over(Window.orderBy("user", "item")) - 1)
    assert sorted(pos.collect()) == sorted(expect.select("user", "item", F.col("pos").cast("bigint")).collect())


def test_kfold_blocks_partition_the_input(spark):
    h = R.history(spark, SF_SMALL).select("event_id", "user_id")
    f = splits.kfold_by_position(h, "event_id", 5)
    sizes = sorted(r["n"] for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect())
    assert sum(sizes) == h.count() and len(sizes) == 5 and sizes[-1] - sizes[0] <= 1
    base, test = splits.kfold_round(f, 2)
    assert base.count() + test.count() == h.count()


def test_leave_n_out_counts(spark):
    h = R.history(spark, SF_SMALL).select("event_id", "user_id")
    lab = splits.leave_n_out(h, "user_id", "event_id", 3, 7)
    per_user = {r["user_id"]: r["n"] for r in h.groupBy("user_id").count().withColumnRenamed("count", "n").collect()}
    tests = {r["user_id"]: r["t"] for r in lab.where("split = 'test'").groupBy("user_id")
             .agg(F.count("*").alias("t")).collect()}
    for u, n in per_user.items():
        assert tests.get(u, 0) == max(0, min(n, 7) - 2)
    capped = splits.leave_n_out(h, "user_id", "event_id", 3, 7, max_test=25)
    assert capped.where("split = 'test'").count() == 25
    assert capped.count() == h.count()


def test_complement_and_union(spark):
    h = R.history(spark, SF_SMALL).select("event_id", "user_id")
    test = h.where("event_id % 3 = 0")
    base = splits.complement(h, test, ["event_id"])
    assert base.count() + test.count() == h.count()
    assert splits.union_blocks([base, test]).count() == h.count()


def test_normal_equations_hold(spark):
    d = R.design(spark, SF_SMALL)
    feats = ["l_quantity", "l_discount", "l_tax", "intercept"]
    w = regression.ols_fit(d, feats, "l_extendedprice")
    p = regression.ols_predict(d, w).withColumn("res", F.col("l_extendedprice") - F.col("prediction"))
    grads = p.agg(*[F.sum(F.col(c) * F.col("res")).alias(c) for c in feats]).first()
    scale = p.agg(F.sum(F.abs("l_extendedprice"))).first()[0]
    for c in feats:
        assert abs(grads[c]) / scale < 1e-8


def test_ols_agrees_with_spark_linear_regression(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    d = R.design(spark, SF_SMALL)
    w = regression.ols_fit(d, ["l_quantity", "l_discount", "intercept"], "l_extendedprice")
    va = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="f").transform(d)
    m = LinearRegression(featuresCol="f", labelCol="l_extendedprice", solver="normal", regParam=0.0,
                         standardization=False).fit(va)
    assert np.allclose([w["l_quantity"], w["l_discount"], w["intercept"]],
                       list(m.coefficients) + [m.intercept], rtol=1e-6)


def test_blocked_gram_equals_unrolled(spark):
    d = R.design(spark, SF_SMALL)
    cols = ["l_quantity", "l_discount", "l_tax", "intercept"]
    g1, t1, n1 = stats._gram_unrolled(d, cols, "l_extendedprice")
    g2, t2, n2 = stats._gram_partials(d, cols, "l_extendedprice")
    assert n1 == n2
    assert np.allclose(g1, g2, rtol=1e-12) and np.allclose(t1, t2, rtol=1e-12)


def test_covariance_matches_numpy(spark):
    p = R.points(spark, SF_SMALL)
    d = vector_dim(p, "features")
    cov = stats.covariance_long(p, "features", d).collect()
    m = np.zeros((d, d))
    for r in cov:
        m[r["i"], r["j"]] = r["cov"]
    x = np.array([r[0] for r in p.select("features").collect()])
    assert np.allclose(m, np.cov(x, rowvar=False), atol=1e-12)


def test_kmeans_cost_does_not_increase(spark):
    p = R.points(spark, SF_SMALL)
    costs = []
    for it in (1, 2, 3, 4):
        res = cluster.lloyd_kmeans(p, "features", 4, id_col="vec_id", fixed_iterations=it)
        costs.append(cluster.clustering_cost(p, "features", res.centres, 64).first()["sum_squared_distance"])
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_lloyd_same_after_repartition(spark):
    p = R.points(spark, SF_SMALL)
    a = cluster.lloyd_kmeans(p, "features", 3, id_col="vec_id", fixed_iterations=2).centres
    b = cluster.lloyd_kmeans(p.repartition(5), "features", 3, id_col="vec_id", fixed_iterations=2).centres
    assert np.allclose(a, b, atol=1e-12)


def test_pca_components_orthonormal_and_match_numpy(spark):
    p = R.points(spark, SF_SMALL).select("vec_id", F.slice("features", 1, 6).alias("v"))
    pc, var, _ = pca.pca_fit(p, "v", 3)
    assert np.allclose(pc.T @ pc, np.eye(3), atol=1e-9)
    x = np.array([r[0] for r in p.select("v").collect()])
    vals, vecs = np.linalg.eigh(np.cov(x, rowvar=False))
    top = pca.fix_signs(vecs[:, ::-1][:, :3])
    assert np.allclose(pc, top, atol=1e-6)
    proj = pca.project(p, "v", pc).orderBy("vec_id").select("x1", "x2", "x3").collect()
    assert np.allclose(np.array([list(r) for r in proj]), x @ pc, atol=1e-9)


@pytest.mark.parametrize("n", [3])
def test_rank_by_centre_distance_respects_n(spark, n):
    p = R.points(spark, SF_SMALL)
    top = cluster.rank_by_centre_distance(p, "label", "vec_id", "features", n)
    per = top.groupBy("cluster_id").count().collect()
    assert all(r["count"] == n for r in per)


def test_xxhash_holdout_partitions_and_is_stable(spark):
    r = R.ratings(spark, SF_SMALL)
    tr, te = splits.holdout_split(r, ["user", "item"], method="xxhash64", seed=5)
    n = r.count()
    assert tr.count() + te.count() == n
    assert 0.7 < tr.count() / n < 0.9
    tr2, _ = splits.holdout_split(r.repartition(4), ["user", "item"], method="xxhash64", seed=5)
    assert sorted(tr.collect()) == sorted(tr2.collect())

"""Tiled moments, QR regression, bounded k-means, skewed joins, bucketed
factors, bags and one-file CSV: against plain recomputation, and their plans."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import cluster, lookup, recommend, regression, splits, stats, wide
from lodestar.sources import text as io


def _vectors(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                                 "id long, v array<double>").repartition(parts)


# ------------------------------------------------------------------ gram_tiled


@pytest.mark.parametrize("tile, cells", [(4, 1 << 22), (5, 40), (64, 13), (1, 13)])
def test_tiles_equal_one_block(spark, tile, cells):
    x = np.random.default_rng(1).integers(-9, 10, (57, 13)).astype(float)
    tiles = wide.gram_tiled(_vectors(spark, x), "v", tile=tile, chunk_cells=cells)
    got = {(r["i"], r["j"]): r["value"] for r in wide.gram_entries(tiles, 13, tile).collect()}
    want = x.T @ x
    assert got == {(i, j): want[i, j] for i in range(13) for j in range(i, 13)}
    assert {r["n"] for r in tiles.select("n").collect()} == {57}
    n = -(-13 // tile)
    assert tiles.count() == n * (n + 1) // 2


def test_a_task_holds_a_chunk_and_a_tile():
    sizes = []

    class Batch:
        def __init__(self, n):
            self.num_rows = n

        def slice(self, first, n):
            return Batch(n)

    def read(b):
        sizes.append(b.num_rows)
        return np.zeros((b.num_rows, 10))
    chunks = list(wide._chunks(iter([Batch(95), Batch(3), Batch(40)]), read, 10, 200))
    assert max(sizes) <= 20 and max(len(c) for c in chunks) <= 20 and sum(map(len, chunks)) == 138


def test_tiled_gram_refuses_nulls_and_takes_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, None]), (2, [2.0, 3.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="coordinates"):
        wide.gram_tiled(df, "v", d=2).collect()
    assert wide.gram_tiled(df.limit(0), "v", d=2).collect() == []
    assert [r["value"] for r in wide.gram_entries(wide.gram_tiled(df, "v", d=2, na="drop"), 2).orderBy("i", "j").collect()] == [4, 6, 9]


# ------------------------------------------------------------------ QR


def _scaled(spark, parts=5):
    """y = 3 a + 2e-8 b + 5 c exactly, b about 1e8 times a; b nearly follows a."""
    rng = np.random.default_rng(8)
    a = rng.integers(1, 1000, 400) / 1024
    b = np.round((a + rng.normal(size=400) * 1e-5) * 1e8)
    y = 3 * a + 2e-8 * b + 5
    rows = [(float(p), float(q), 1.0, float(r)) for p, q, r in zip(a, b, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, one double, y double").repartition(parts)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_qr_keeps_digits_the_normal_equations_lose(spark, fan_in):
    df = _scaled(spark)
    w = wide.ols_qr(df, ["a", "b", "one"], "y", fan_in=fan_in)
    want = {"a": 3.0, "b": 2e-8, "one": 5.0}
    assert all(abs(w[c] / want[c] - 1) < 1e-8 for c in want)
    assert 0 <= w[None] < 1e-18
    g, t, _ = stats.gram(df, ["a", "b", "one"], "y")
    lost = np.linalg.solve(g, t)
    assert max(abs(v / want[c] - 1) for c, v in zip(want, lost, strict=True)) > 1e-7


def test_qr_names_dependent_columns_and_bad_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, float(i)) for i in range(20)], "a double, b double, one double, y double")
    with pytest.raises(regression.CollinearError, match="b"):
        wide.ols_qr(df, ["a", "b", "one"], "y")
    with pytest.raises(regression.CollinearError):  # fewer rows than columns
        wide.ols_qr(df.limit(1), ["a", "one"], "y")
    with pytest.raises(ValueError, match="no rows"):
        wide.ols_qr(df.limit(0), ["a", "one"], "y")
    nulls = df.withColumn("a", F.when(F.col("y") > 3, F.col("a")))
    with pytest.raises(Exception, match="null or NaN"):
        wide.ols_qr(nulls, ["a", "one"], "y")
    w = wide.ols_qr(nulls, ["a", "one"], "y", na="drop")
    assert abs(w["a"] - 1) < 1e-12 and abs(w["one"]) < 1e-10


# ------------------------------------------------------------------ bounded k-means


@pytest.mark.parametrize("iterations", [1, 4, 11])
def test_bounds_give_lloyds_centres(spark, iterations):
    rng = np.random.default_rng(iterations)
    centres = rng.normal(size=(12, 5)) * 4
    x = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 5))
    df = _vectors(spark, np.round(x, 3), 4)
    plain = cluster.lloyd_kmeans(df, "v", 12, fixed_iterations=iterations)
    bounded = cluster.kmeans_bounded(df, "v", 12, fixed_iterations=iterations, rows_per_partition=100)
    assert np.allclose(plain.centres, bounded.centres, rtol=0, atol=1e-9)
    assert np.allclose(plain.shifts, bounded.shifts, rtol=0, atol=1e-7)
    assert bounded.possible == 600 * 12 * iterations
    assert bounded.skipped_share > 0.4 if iterations > 4 else bounded.distances <= bounded.possible


def test_bounded_ties_empty_clusters_and_failure(spark):
    pts = [(0.0, 0.0), (2.0, 0.0), (0.0, 0.0), (2.0, 0.0), (1.0, 0.0), (1.0, 0.0)]
    df = _vectors(spark, pts, 2)
    for start in ([[0.0, 0.0], [2.0, 0.0]], [[0.0, 0.0], [0.0, 0.0], [9.0, 9.0]], [[1.0, 0.0]]):
        want = cluster.lloyd_kmeans(df, "v", len(start), centres=start, fixed_iterations=5)
        assert cluster.kmeans_bounded(df, "v", len(start), centres=start, fixed_iterations=5).centres == want.centres
    with pytest.raises(cluster.NotConvergedError):
        cluster.kmeans_bounded(df, "v", 2, centres=[[0.0, 0.0], [0.5, 0.0]], max_iter=1, tol=1e-12)
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    cluster.kmeans_bounded(df, "v", 2)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept


# ------------------------------------------------------------------ skewed join


def _hot(spark, n=6000):
    rows = [(7 if i % 3 == 0 else i % 1000, i) for i in range(n)] + [(None, -1), (None, -2)]
    return spark.createDataFrame(rows, "user long, item long").repartition(6)


def test_skewed_join_equals_the_plain_one(spark):
    big = _hot(spark).withColumn("part", F.lit("x"))
    other = spark.createDataFrame([(i, float(i)) for i in range(900)] + [(7, -1.0), (None, 5.0)], "user long, v double")
    got = lookup.join_pairs_skewed(big, other, "user", hot_rows=100)
    want = big.join(other, "user")
    assert got.columns == want.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect()))
    two = other.withColumn("item", F.col("user"))
    assert lookup.join_pairs_skewed(big, two, ["user", "item"], hot_rows=100).count() == big.join(two, ["user", "item"]).count()
    assert lookup.join_pairs_skewed(big.limit(0), other, "user").collect() == []


def test_a_hot_keys_rows_are_spread(spark):
    big = _hot(spark, 60_000)
    other = spark.createDataFrame([(i, 1.0) for i in range(1000)], "user long, v double")
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {}
        for name, j in (("plain", big.join(other, "user")), ("split", lookup.join_pairs_skewed(big, other, "user", hot_rows=500))):
            sizes[name] = [r["count"] for r in j.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert max(sizes["plain"]) > 2.5 * sorted(sizes["plain"])[len(sizes["plain"]) // 2]
    assert max(sizes["split"]) < 1.7 * sorted(sizes["split"])[len(sizes["split"]) // 2]


def test_hot_keys_are_found(spark):
    big = _hot(spark, 30_000)
    found = dict(map(tuple, lookup.hot_keys(big, F.xxhash64("user"), hot_rows=5000).collect()))
    key = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert set(found) == {key} and abs(found[key] - 10_000) < 200


# ------------------------------------------------------------------ bucketed factors


def test_bucketed_scoring_moves_no_factors(spark):
    rng = np.random.default_rng(3)
    f = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "id long, features array<double>")
    pairs = spark.createDataFrame([(random.Random(i).randrange(250), i % 210, "x") for i in range(500)], "user int, item int, id string")
    factors = recommend.BucketedFactors(f, f, 4, buckets=4)
    try:
        scored = factors.score(pairs)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        want = recommend.score_factor_pairs(pairs, f, f, 4)
        rows = lambda d: sorted((r["user"], r["item"], r["id"], round(r["score"], 12)) for r in d.collect())
        assert rows(scored) == rows(want)
        lines = plan.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        scans = [i for i, line in enumerate(lines) if "Scan parquet" in line and "factors" in line]
        assert len(scans) == 2, plan
        for at in scans:
            level = depth(lines[at])
            for line in reversed(lines[:at]):  # the scan's way up to its join
                if depth(line) < level:
                    level = depth(line)
                    assert "Exchange" not in line
                    if "Join" in line:
                        break
    finally:
        factors.drop()


# ------------------------------------------------------------------ bags


@pytest.mark.parametrize("portion", [1_000_000, 3])
def test_bag_complement_counts_repetitions(spark, portion):
    rnd = random.Random(2)
    draw = lambda n: [(rnd.choice([1, 2, None]), rnd.choice(["a", None, "left"])) for _ in range(n)]
    a, b = draw(80) + [(9, "hot")] * 50, draw(30) + [(9, "hot")] * 4 + [(8, "never")] * 3
    left, right = (spark.createDataFrame(x, "left long, s string") for x in (a, b))
    got = splits.bag_complement(left, right.select("s", "left"), copies_per_task=portion)
    assert got.columns == ["left", "s"]
    want = collections.Counter(a) - collections.Counter(b)
    assert collections.Counter(map(tuple, got.collect())) == want
    assert collections.Counter(map(tuple, left.exceptAll(right).collect())) == want
    with pytest.raises(ValueError, match="columns differ"):
        splits.bag_complement(left, right.drop("s"))


# ------------------------------------------------------------------ one CSV file


def test_one_csv_file_in_order(spark, tmp_path):
    rows = [(i * 7919 % 5003, f"name, {i}" if i % 5 else 'say "x"', i / 4) for i in range(5000)] + [(9000, None, None)]
    df = spark.createDataFrame(rows, "id long, `the, name` string, v double").repartition(7)
    path = str(tmp_path / "out.csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = io.write_csv_one_file(df, path, ["id"]).orderBy("place").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lines = open(path).read().splitlines()
    assert lines[0] == 'id,"the, name",v' and len(lines) == len(rows) + 1
    ids = [int(line.split(",")[0]) for line in lines[1:]]
    assert ids == sorted(r[0] for r in rows)
    assert manifest[0]["file"] == "header" and sum(r["rows"] for r in manifest) == len(lines)
    assert sum(r["bytes"] for r in manifest) == (tmp_path / "out.csv").stat().st_size and len(manifest) > 2
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.csv"]
    back = spark.read.option("header", "true").schema(df.schema).csv(path)
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter(rows)
    with pytest.raises(FileExistsError):
        io.write_csv_one_file(df, path, ["id"])
    io.write_csv_one_file(df.limit(0), path, ["id"], overwrite=True)
    assert open(path).read() == 'id,"the, name",v\n'


# ------------------------------------------------------------------ null rules


def test_moments_and_errors_have_one_null_rule(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 10.0, 5.0), (2.0, 1.0, None)], "a double, b double, y double")
    with pytest.raises(Exception, match="null or NaN"):
        stats.gram_long(df, ["a", "b"], "y").collect()
    got = {(r["row_name"], r["col_name"]): r["value"] for r in stats.gram_long(df, ["a", "b"], "y", na="drop").collect()}
    assert got == {("a", "a"): 1, ("a", "b"): 2, ("b", "b"): 4, ("a", "y"): 3, ("b", "y"): 6}
    row = stats.mse_rmse(df, "a", "y").first()
    assert (row["mse"], row["n"]) == (4.0, 1)


def test_nulls_keep_their_places_in_lines(spark, tmp_path):
    df = spark.createDataFrame([(7, [1.0, None, 3.0], "x"), (None, [1.0, 2.0, 3.0], None)], "id long, v array<double>, s string").coalesce(1)
    io.write_delimited(df, str(tmp_path / "t"), ",")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == [",1.0,2.0,3.0,", "7,1.0,,3.0,x"]
    with pytest.raises(Exception, match="null array"):
        io.write_delimited(spark.createDataFrame([(1, None)], "id long, v array<double>"), str(tmp_path / "u"), ",")


# ------------------------------------------------------------------ broadcast by measured size


def test_a_well_compressed_dictionary_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "titles")
    spark.range(20_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 500).alias("title")).coalesce(1).write.parquet(path)
    titles = spark.read.parquet(path)
    assert lookup.size_in_bytes(titles) < 1 << 20 < lookup.measured_bytes(titles)
    facts = spark.range(5).withColumnRenamed("id", "k")
    for bound, join in ((1 << 20, "SortMergeJoin"), (1 << 26, "BroadcastHashJoin")):
        plan = facts.join(lookup.checked_broadcast(titles, bound), "k")._jdf.queryExecution().executedPlan().toString()
        assert join in plan
    assert math.isclose(lookup.measured_bytes(titles), 20_000 * (16 + 16 + 516), rel_tol=0.1)

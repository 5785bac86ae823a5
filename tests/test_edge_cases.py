"""Hand-made edge rows (FIXTURES.md): ties, empty cluster, null/NaN, bad
numbers, items without flags or titles, unknown users, repeated pairs,
collinear columns, fewer points than K."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lodestar.functions.labels import flag_labels_array, flag_labels_text, info_text
from lodestar.functions.vectors import check_vectors
from lodestar.operators import cluster, lookup, recommend, regression, topk
from lodestar.session import scratch_path
from lodestar.sources import text as io


def _pts(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>")


def test_equal_distances_tie_by_id(spark):
    # two points at the same distance from the centre of group 0
    df = spark.createDataFrame(
        [(5, [1.0, 0.0], 0), (3, [-1.0, 0.0], 0), (9, [0.0, 3.0], 0), (1, [0.0, -3.0], 0)],
        "vec_id long, features array<double>, label int")
    top = cluster.rank_by_centre_distance(df, "label", "vec_id", "features", 2).orderBy("rank").collect()
    assert [r["item_id"] for r in top] == [3, 5]


def test_assignment_tie_goes_to_lowest_index(spark):
    df = _pts(spark, [(1, [0.0, 0.0])])
    out = cluster.assign_nearest(df, "features", [[1.0, 0.0], [-1.0, 0.0]], 2, "c").first()
    assert out["c"] == 0
    out = cluster.assign_nearest(df, "features", [[1.0, 0.0], [-1.0, 0.0]], 2, "c", unroll=True).first()
    assert out["c"] == 0


def test_empty_cluster_keeps_its_centre(spark):
    df = _pts(spark, [(1, [0.0, 0.0]), (2, [0.0, 1.0]), (3, [10.0, 10.0])])
    far = [100.0, 100.0]
    res = cluster.lloyd_kmeans(df, "features", 3, id_col="id",
                               centres=[[0.0, 0.0], [10.0, 10.0], far], fixed_iterations=2)
    assert res.centres[2] == far
    assert res.centres[0] == [0.0, 0.5]


def test_fewer_points_than_k(spark):
    df = _pts(spark, [(1, [0.0, 0.0]), (2, [5.0, 5.0])])
    res = cluster.lloyd_kmeans(df, "features", 4, id_col="id", fixed_iterations=1)
    assert len(res.centres) == 2
    assert sorted(res.centres) == [[0.0, 0.0], [5.0, 5.0]]


def test_lloyd_runs_at_least_one_iteration(spark):
    df = _pts(spark, [(1, [0.0]), (2, [1.0]), (3, [9.0]), (4, [10.0])])
    res = cluster.lloyd_kmeans(df, "features", 2, id_col="id", tol=1e9)
    assert res.iterations == 1
    # init = the two lowest ids ([0], [1]); one pass moves the second centre
    assert res.centres[0] == [0.0]
    assert abs(res.centres[1][0] - 20.0 / 3.0) < 1e-12


def test_null_and_nan_coordinates(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [float("nan"), 1.0]), (3, None)],
                               "id long, features array<double>")
    assert check_vectors(df, "features", 2, "drop")[0].count() == 1
    with pytest.raises(Exception):
        check_vectors(df, "features", 2, "error")[0].collect()
    with pytest.raises(Exception):
        cluster.lloyd_kmeans(df, "features", 1, id_col="id", centres=[[0.0, 0.0]])


def test_bad_number_in_rating_line(spark):
    path = scratch_path(spark, "bad-ratings")
    spark.createDataFrame([("1\t2\t3\t100",), ("4\tfive\t3\t100",), ("6\t7\t4",)], "value string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception):
        io.read_ratings(spark, path).collect()
    ok = io.read_ratings(spark, path, mode="DROPMALFORMED").orderBy("user").collect()
    assert [(r["user"], r["item"], r["rating"]) for r in ok] == [(1, 2, 3.0), (6, 7, 4.0)]
    ts = io.read_ratings(spark, path, mode="DROPMALFORMED", keep_ts=True).orderBy("user").first()
    assert ts["ts"] is not None


def test_item_flags_from_the_end_and_no_flag_set(spark):
    path = scratch_path(spark, "items")
    lines = [("1|Toy Story (1995)|01-Jan-1995||http://x|0|1|1",),
             ("2|No Genre|01-Jan-1995||http://y|0|0|0",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    items = io.read_items(spark, path, 3)
    names = ["unknown", "Action", "Adventure"]
    out = {r["item_id"]: r for r in items.select(
        "item_id", info_text("title", "flags", names).alias("info"),
        flag_labels_array("flags", names).alias("arr"),
        flag_labels_text("flags", names).alias("g")).collect()}
    assert out[1]["info"] == "Toy Story (1995)|Action|Adventure|"
    assert out[1]["arr"] == ["Action", "Adventure"]
    assert out[2]["info"] == "No Genre|"
    assert out[2]["g"] == ""


def test_lookup_missing_id(spark):
    facts = spark.createDataFrame([(1,), (2,)], "item long")
    titles = spark.createDataFrame([(1, "A")], "item_id long, title string")
    with pytest.raises(Exception):
        lookup.lookup_join(facts, titles, "item", "item_id", "title", on_missing="error").collect()
    got = lookup.lookup_join(facts, titles, "item", "item_id", "title", on_missing="null") \
        .orderBy("item").collect()
    assert [(r["item"], r["title"]) for r in got] == [(1, "A"), (2, None)]
    assert lookup.lookup_join(facts, titles, "item", "item_id", "title", on_missing="drop").count() == 1


def test_repeated_key_dictionary_is_deterministic(spark):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id long, title string")
    out = {r["id"]: r["title"] for r in lookup.dedup_dictionary(d, "id", "title").collect()}
    assert out == {1: "b", 2: "c"}
    d2 = spark.createDataFrame([(1, "b", 1), (1, "a", 5)], "id long, title string, v int")
    out2 = lookup.dedup_dictionary(d2, "id", "title", order_col="v").first()
    assert out2["title"] == "a"


def test_repeated_pair_multiplies_in_join(spark):
    truth = spark.createDataFrame([(1, 1, 3.0), (1, 1, 4.0)], "user long, item long, rating double")
    pred = spark.createDataFrame([(1, 1, 3.5), (1, 1, 2.5)], "user long, item long, prediction double")
    assert lookup.join_pairs(truth, pred).count() == 4


def test_user_absent_from_training_is_dropped(spark):
    r = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(1, 6) for i in range(1, 6)],
                              "user long, item long, rating double")
    model = recommend.als_fit(r, rank=2, max_iter=3, seed=1, blocks=2)
    pairs = spark.createDataFrame([(1, 1), (99, 1), (1, 99)], "user long, item long")
    out = recommend.predict_pairs(model, pairs).collect()
    assert [(x["user"], x["item"]) for x in out] == [(1, 1)]


def test_collinear_columns_raise(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, 3.0 * i + 1) for i in range(10)],
                               "a double, b double, intercept double, y double")
    with pytest.raises(regression.CollinearError, match="b"):
        regression.ols_fit(df, ["a", "b", "intercept"], "y")
    w = regression.ols_fit(df, ["a", "b", "intercept"], "y", use_pinv=True)
    assert abs(w["a"] + 2 * w["b"] - 3.0) < 1e-8 and abs(w["intercept"] - 1.0) < 1e-8


def test_null_in_regression_input(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    with pytest.raises(Exception):
        regression.ols_fit(df.withColumn("intercept", F.lit(1.0)), ["x", "intercept"], "y")
    w = regression.ols_fit(df.withColumn("intercept", F.lit(1.0)), ["x", "intercept"], "y", na="drop")
    assert set(w) == {"x", "intercept"}


def test_first_n_and_top_n_ties(spark):
    r = spark.createDataFrame([(1, 10, 5), (1, 3, 5), (1, 7, 4), (2, 1, 1)], "user long, item long, rating int")
    top = topk.user_top_rated(r, 2).where("user = 1").orderBy("rank").collect()
    assert [x["item"] for x in top] == [3, 10]
    first = topk.first_n_ordered(r, ["user", "item"], 2).collect()
    assert [(x["user"], x["item"]) for x in first] == [(1, 3), (1, 7)]


def test_recommend_for_user_excludes_seen_on_request(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [0.1, 0.0])],
                                  "id long, features array<double>")
    all_ = recommend.recommend_for_user([1.0, 0.0], items, 2, 2).collect()
    assert [r["id"] for r in all_] == [1, 2]
    seen = spark.createDataFrame([(1,)], "item long")
    fresh = recommend.recommend_for_user([1.0, 0.0], items, 2, 2, seen=seen).collect()
    assert [r["id"] for r in fresh] == [2, 3]


def test_checkpoint_dir_is_taken_from_the_session(spark):
    from lodestar.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and os.path.isabs(d.replace("file:", ""))
    assert not d.startswith(tempfile.gettempdir()) or spark.sparkContext.master.startswith("local")


def test_als_with_64_bit_ids(spark):
    big = 10_000_000_000
    rows = [(big + u, 3 * big + i, float((1 + 0.1 * u) * (1 + 0.1 * i))) for u in range(6) for i in range(5)]
    r = spark.createDataFrame(rows, "user long, item long, rating double")
    with pytest.raises(Exception):
        recommend.als_fit(r, rank=1, max_iter=2, seed=1, blocks=2)
    m = recommend.als_fit_indexed(r, rank=1, max_iter=15, reg=1e-8, seed=1, blocks=2)
    pred = {(x["user"], x["item"]): x["prediction"] for x in m.predict(r.select("user", "item")).collect()}
    for u, i, v in rows:
        assert abs(pred[(u, i)] - v) < 1e-3
    assert {x["id"] for x in m.item_factors().collect()} == {3 * big + i for i in range(5)}
    assert m.user_factors().count() == 6 and m.item_factors().count() == 5


def test_intercept_only_regression_is_the_mean(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "y double").withColumn("intercept", F.lit(1.0))
    assert regression.ols_fit(df, ["intercept"], "y") == {"intercept": 3.0}


def test_point_lines_with_a_bad_number(spark):
    path = scratch_path(spark, "points")
    spark.createDataFrame([("1,0.5,1.5",), ("2,x,1.0",), ("",), ("3,2.0,2.5",)], "value string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception):
        io.read_points(spark, path).collect()
    got = io.read_points(spark, path, mode="DROPMALFORMED").orderBy("id").collect()
    assert [(r["id"], r["features"]) for r in got] == [(1, [0.5, 1.5]), (3, [2.0, 2.5])]


def test_csv_single_file_and_inference(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, 1.5, "b")], "k int, x double, s string")
    path = scratch_path(spark, "one-file")
    io.write_csv(df, path, header=True, single_file=True)
    parts = [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]
    assert len(parts) == 1
    back = io.read_csv(spark, path, header=True, infer_schema=True)
    assert dict(back.dtypes) == {"k": "int", "x": "double", "s": "string"}
    with pytest.raises(Exception):
        io.write_csv(df, path, header=True)          # error if it exists


def test_leave_n_out_with_a_hot_user(spark):
    from lodestar.operators import splits
    # user 0 holds a third of all rows
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "pos long, user long")
    lab = splits.leave_n_out(df, "user", "pos", 2, 6)
    test = lab.where("split = 'test'")
    hot = sorted(r["pos"] for r in test.where("user = 0").collect())
    assert hot == [3, 6, 9, 12, 15]            # occurrences 2..6 of user 0
    assert lab.count() == 3000
    assert test.count() == 5 * 51


def test_scratch_folders_are_removed(spark):
    from lodestar.session import clean_scratch
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    clean_scratch(spark)
    assert not os.path.exists(local)

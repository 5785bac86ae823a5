"""ALS half-steps in cells: what Spark's blocks would hold in memory lies in files."""

import numpy as np
import pyarrow as pa
import pytest

from lodestar.operators import als_cells, recommend


def _ratings(spark):
    """A hot user and a hot item, repeated pairs, negative ids."""
    rows = [(u - 3, (u * 7 + k * 3) % 31 - 5, float(1 + (u + k) % 5)) for u in range(40) for k in range(10)]
    rows += [(5, i % 90, float(1 + i % 4)) for i in range(150)] + [(u, 2, 3.0) for u in range(120)]
    return spark.createDataFrame(rows, "user long, item long, rating double")


def _plain(rows, x, rank, reg, iterations):
    def solve(fixed, own, other):
        out = {}
        for key in {r[own] for r in rows}:
            mine = [r for r in rows if r[own] == key]
            y, v = np.array([fixed[r[other]] for r in mine]), np.array([r[2] for r in mine])
            out[key] = np.linalg.solve(y.T @ y + reg * len(mine) * np.eye(rank), y.T @ v).astype(np.float32).astype(float)
        return out
    for _ in range(iterations):
        y = solve(x, 1, 0)
        x = solve(y, 0, 1)
    return x, y


@pytest.mark.parametrize("per_row,per_chunk,per_part", [(256, 200_000, 2_000_000), (7, 20, 60)])
def test_half_steps_in_cells_are_those_of_als(spark, monkeypatch, per_row, per_chunk, per_part):
    """Vectors against plain loops, whatever the rows, chunks and parts; no
    block is held by Spark's ALS."""
    from pyspark.ml.recommendation import ALS
    monkeypatch.setattr(recommend, "RATINGS_IN_MEMORY", 100)
    for name, value in (("RATINGS_PER_ROW", per_row), ("RATINGS_PER_CHUNK", per_chunk), ("RATINGS_PER_PART", per_part)):
        monkeypatch.setattr(als_cells, name, value)
    monkeypatch.setattr(ALS, "_fit", lambda *a: pytest.fail("blocks in memory"))
    r = _ratings(spark)
    model = recommend.als_fit(r, rank=3, max_iter=3, reg=0.1, seed=5)
    got = [{a["id"]: np.array(a["features"]) for a in t.collect()} for t in (model.userFactors, model.itemFactors)]
    rows = [tuple(x) for x in r.collect()]
    users = np.array(sorted({x[0] for x in rows}), np.int32)
    start = dict(zip(users.tolist(), als_cells._start(users, 3, 5).astype(np.float32).astype(float), strict=True))
    for g, w in zip(got, _plain(rows, start, 3, 0.1, 3), strict=True):
        assert g.keys() == w.keys()
        assert max(np.abs(g[k] - w[k]).max() for k in w) < 1e-4
    predicted = recommend.predict_pairs(model, r)
    assert predicted.count() == len(rows)
    x = predicted.first()
    assert abs(x["prediction"] - got[0][x["user"]] @ got[1][x["item"]]) < 1e-5
    assert recommend.predict_pairs(model, spark.createDataFrame([(999, 1)], "user long, item long")).count() == 0


@pytest.mark.parametrize("per_row", [256, 7])
def test_residuals_in_cells_are_those_of_the_pairs(spark, monkeypatch, per_row):
    """Ids with many ratings, with none, without a vector, null and beyond INT."""
    monkeypatch.setattr(als_cells, "RATINGS_PER_ROW", per_row)
    r = _ratings(spark)
    model = recommend.als_fit(r, rank=3, max_iter=2, reg=0.1, seed=5)
    users, items = model.userFactors.where("id != 4").unionByName(model.userFactors.where("id = 4").selectExpr("id + 5000 as id", "features")), model.itemFactors.where("id != 2")
    r = r.union(spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0), (2**33, 1, 1.0), (1, 2**40, 2.0), (7, 4000, 2.0)], r.schema))
    rows = lambda: {x["id"]: x["residual"] for x in recommend.normal_equation_residuals(users, items, r, 0.1).collect()}
    want = rows()
    monkeypatch.setattr(recommend, "RATINGS_IN_MEMORY", 100)
    monkeypatch.setattr(recommend, "map_pairs", lambda *a: pytest.fail("vectors sent to cells of pairs"))
    got = rows()
    assert got.keys() == want.keys() and 5004 not in got and 4 not in got
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    monkeypatch.undo()
    users = users.union(users)  # ids that come twice stay with the pairs
    monkeypatch.setattr(recommend, "RATINGS_IN_MEMORY", 100)
    assert rows().keys() == want.keys()


def test_bad_ratings_raise_in_cells(spark, monkeypatch):
    monkeypatch.setattr(recommend, "RATINGS_IN_MEMORY", 1)
    for row in ((None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, float("inf"))):
        bad = _ratings(spark).union(spark.createDataFrame([row], "user long, item long, rating double"))
        with pytest.raises(Exception, match="must"):
            recommend.als_fit(bad, rank=2, max_iter=1, seed=1)


def test_ratings_that_come_before_the_vectors_wait():
    """Order of the rows in a task and cuts between an id's rows do not matter."""
    def row(ident, pieces, others, ratings):
        return ident, pieces, others.tobytes(), np.array(ratings, np.float32).tobytes()
    vectors = np.array([[1.0, 0.5], [0.25, 1.0], [0.5, 0.5]], np.float32)
    table = [row(0, -1, np.array([i], np.int32), v) for i, v in enumerate(vectors)]
    ratings = [row(8, 0, np.array([0, 1], np.int32), [4, 2]), row(7, 1, np.array([2], np.int32), [3]), row(8, 2, np.array([2], np.int32), [1])]

    def solved(rows):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 2], strict=True), (
            pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["id", "pieces", "others", "ratings"]) for k in range(0, len(rows), 2)]
        return {i: v for b in als_cells._half_step(iter(batches), {-1: als_cells._Fixed(3, 2)}, *how, 2) for i, v in zip(
            als_cells._numbers(b.column("ids"), np.int32).tolist(),
            als_cells._numbers(b.column("vectors"), np.float32).reshape(-1, 2).tolist(), strict=True)}

    how = als_cells._normal_equations, als_cells._solutions(0.1)
    y, v = vectors.astype(float), np.array([4.0, 2.0, 1.0])
    want = np.linalg.solve(y.T @ y + 0.3 * np.eye(2), y.T @ v)
    for rows in (table + ratings, ratings[::-1] + table, table[:1] + ratings + table[1:]):
        got = solved(rows)
        assert sorted(got) == [7, 8] and np.allclose(got[8], want, atol=1e-5)
    with pytest.raises(RuntimeError, match="missing"):
        solved(table + ratings[:2])

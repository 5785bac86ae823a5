import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.llm import hard_negatives as H
from lodestar.llm.queries import QUERIES

NAME = "op12_residue_hard_negatives"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=50, relabel=True):
    """Brute force in Python's integers over (vec_id, label, embedding)."""
    e = []
    for vec, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if relabel and vec is not None and vec % 7 == 0:
            label = (label + 1) % 10
        e.append((vec, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, (vec, label, v) in enumerate(e):
        if vec is None or vec % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), other is None, other or 0, j, other)
                         for j, (other, _, w) in enumerate(e) if j != i))
        same = [s for s in scored if e[s[3]][1] == label][:5]
        for p in same:
            inside = [s for s in scored if e[s[3]][1] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            out += [(vec, p[4], r + 1, s[4], -p[0], -s[0]) for r, s in enumerate(inside)]
    return sorted(out, key=repr)


def result(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=repr)


def embeddings(rows):
    return pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "label": pa.array([r[1] for r in rows], pa.int32()),
                     "embedding": pa.array([r[2] for r in rows], pa.list_(pa.float32())), "row": ["x"] * len(rows),
                     "group": [1] * len(rows), "anchor": [None] * len(rows)})


def odd_rows():
    rnd = random.Random(3)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, rnd.randrange(10), [f32(rnd.gauss(0, 0.2)) for _ in range(16)]) for i in range(0, 400, 2)]
    same = [f32(x / 7) for x in range(16)]
    rows += [(1000 + i, i % 3, same) for i in range(120)]  # ties without end
    rows += [rows[0], rows[0], rows[25], (50, 3, same), (50, 3, same)]  # repeated anchors and rows
    rows += [(None, 1, same), (None, 1, same), (None, None, None), (5000, None, same), (5050, 1, None), (5100, 2, same[:3] + [None]),
             (5150, 2, [float("nan")] * 16), (5200, 2, [float("inf")] + same[1:]), (5250, 4, []), (5300, 4, same[:5]),
             (5350, 4, [0.0] * 16), (-50, 3, [-x for x in same]), (-7, 2, same)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [H.CELLS, 16 * 20])
def test_against_brute_force(spark, small, monkeypatch, cells):
    rows = odd_rows()
    if cells != H.CELLS:
        monkeypatch.setattr(H, "ROW_TILE", 7)
        monkeypatch.setattr(H, "ANCHOR_TILE", 3)
        monkeypatch.setattr(H, "LEAST_GROUP", 10)
    monkeypatch.setattr(H.mine, "__defaults__", (*H.mine.__defaults__[:-1], cells))
    assert result(QUERIES[NAME](spark, small(embeddings=embeddings(rows)))) == plain(rows)


def test_empty_table_and_no_anchor(spark, small):
    assert result(QUERIES[NAME](spark, small(embeddings=embeddings([])))) == []
    assert result(QUERIES[NAME](spark, small(embeddings=embeddings([(1, 1, [1.0]), (2, 2, [0.5])])))) == []


def test_large_components_use_more_primes(spark):
    rnd = random.Random(5)
    rows = [(i, i % 2, [rnd.randrange(-(10**7), 10**7) for _ in range(5)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>")
    got = result(H.mine(df, F.col("vec_id") % 10 == 0))
    assert got == plain([(i, k, [x / 256 for x in v]) for i, k, v in rows], every=10, relabel=False)
    assert len(H.moduli(5 * 10**14)) > 5
    with pytest.raises(ValueError, match="64 bits"):
        H.mine(spark.createDataFrame([(1, 1, [2**62])], "vec_id long, label long, v array<long>"), F.lit(True))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 2**56), st.integers(0, 2**32))
def test_scores_are_exact(bound, seed):
    rng = np.random.default_rng(seed)
    width = int(rng.integers(1, 2500))
    top = max(1, math.isqrt(bound // width))
    a, b = (rng.integers(-top, top, (n, width), endpoint=True) for n in (3, 4))
    primes = H.moduli(width * top * top)
    got = H.scores(H.residues(a, primes), H.residues(b, primes), primes)
    assert got.tolist() == [[int(sum(int(x) * int(y) for x, y in zip(r, s, strict=True))) for s in b] for r in a]


def test_extreme_residues_stay_exact_in_float32():
    for p in H.moduli(2**60):
        edge = np.full((1, H.COLUMNS), p // 2, dtype=np.int64)
        (r,) = H.residues(edge, [p])
        assert int((r @ r.T)[0, 0]) == H.COLUMNS * (p // 2) ** 2 < 2**24


def test_no_product_of_the_table_with_itself(spark):
    plan = QUERIES[NAME](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

"""Exact top-k for many users: against brute force, skipping, plan shape."""

import numpy as np
import pytest

from lodestar.operators import factor_search


def _brute(users, items, k):
    out = []
    for u, x in users:
        scored = sorted(((-float((np.array(x) * np.array(v)).sum()), i) for i, v in items))[:k]
        out += [(u, i, r + 1) for r, (_, i) in enumerate(scored)]
    return sorted(out)


def _frames(spark, users, items):
    return (spark.createDataFrame(users, "id long, features array<double>"),
            spark.createDataFrame(items, "id long, features array<double>"))


def _rows(top):
    return sorted((r["user"], r["item"], r["rank"]) for r in top.collect())


@pytest.mark.parametrize("block, unit", [(4096, 1 << 16), (7, 5), (1, 1)])
def test_equals_brute_force_with_ties_and_any_blocks(spark, block, unit):
    rng = np.random.default_rng(2)
    items = [(int(i), v.tolist()) for i, v in zip(rng.permutation(60), rng.integers(-3, 4, (60, 4)).astype(float), strict=True)]
    items += [(100 + i, items[0][1]) for i in range(12)] + [(200, [0.0] * 4)]  # equal vectors tie by id
    users = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(13, 4)))] + [(50, [0.0] * 4), (51, [1e9, 0.0, 0.0, 0.0])]
    if block == 1:
        users = users[-4:]
    top, work = factor_search.recommend_for_users(*_frames(spark, users, items), 5, block_items=block, unit_users=unit)
    assert _rows(top) == _brute(users, items, 5)
    assert work.possible == len(users) * -(-len(items) // block)


def test_blocks_are_skipped_when_norms_fall(spark):
    rng = np.random.default_rng(4)
    items = [(i, (rng.normal(size=6) / (1 + i)).tolist()) for i in range(400)]
    users = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(20, 6)))]
    top, work = factor_search.recommend_for_users(*_frames(spark, users, items), 3, block_items=10)
    assert _rows(top) == _brute(users, items, 3)
    assert work.skipped > work.possible // 2


def test_fewer_items_than_k_and_empty_sides(spark):
    users, items = [(1, [1.0, 2.0])], [(5, [0.5, -1.0]), (3, [0.5, -1.0])]
    top, _ = factor_search.recommend_for_users(*_frames(spark, users, items), 10)
    assert _rows(top) == [(1, 3, 1), (1, 5, 2)]
    assert factor_search.recommend_for_users(*_frames(spark, [], items), 10, d=2)[0].collect() == []
    assert factor_search.recommend_for_users(*_frames(spark, users, []), 10, d=2)[0].collect() == []


def test_bad_vectors_are_refused(spark):
    users, items = _frames(spark, [(1, [1.0, 2.0])], [(5, [0.5, None]), (3, [0.5])])
    with pytest.raises(Exception, match="coordinates"):
        factor_search.recommend_for_users(users, items, 10, d=2)

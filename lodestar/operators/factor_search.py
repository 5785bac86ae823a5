"""Exact top-k items for a set of users.

The inner product of a user and an item is at most the product of their norms.
Items are numbered by falling norm and cut into blocks of ``block_items``; once
a user has k scores, no block whose greatest norm times the user's norm is
below the k-th can change the answer, and neither can any later block.

Blocks are visited in rounds of 1, 1, 2, 4, ... blocks.  In each round a user
goes only to the blocks that its bound still allows; a block and at most
``unit_users`` users are one unit, in which the items are held as a matrix and
the users stream past.  After the round a user's k best so far, a window over
at most k rows a block, give its next bound.  The number of rounds is
logarithmic in the number of blocks, and no frame pairs users with items.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.vectors import check_vectors, dot, vector_dim
from lodestar.operators.splits import with_dense_position
from lodestar.operators.units import map_units, matrix
from lodestar.session import written

BLOCK_ITEMS = 4096
UNIT_USERS = 1 << 16
#: users multiplied with a block at a time
TILE = 256
#: a matrix product and a plain sum of the same terms differ by less, relative to the norms
SLACK = 1e-9


@dataclass
class SearchWork:
    """What a search did: (user, block) pairs scored, of all there are."""

    rounds: int = 0
    scored: int = 0
    possible: int = 0
    per_round: list[int] = field(default_factory=list)

    @property
    def skipped(self) -> int:
        return self.possible - self.scored


def _best_of_block(k: int, d: int):
    """Unit functions: hold a block's items, answer users with their k best."""
    def hold(batches):
        t = pa.Table.from_batches(batches)
        ids = t.column("id").to_numpy()
        by = np.argsort(ids, kind="stable")
        return ids[by], matrix(t.column("features"), d)[by]

    def answer(held, batch):
        ids, items = held
        users = matrix(batch.column("features"), d)
        margin = SLACK * np.linalg.norm(users, axis=1) * np.linalg.norm(items, axis=1).max()
        for first in range(0, len(users), TILE):
            own = users[first:first + TILE]
            rough = own @ items.T
            if rough.shape[1] > k:
                floor = np.partition(rough, -k, axis=1)[:, -k] - 2 * margin[first:first + TILE]
                row, column = np.nonzero(rough >= floor[:, None])
            else:
                row, column = np.nonzero(np.ones_like(rough, dtype=bool))
            # summed alike wherever an item stands, so equal vectors tie exactly
            score = (own[row] * items[column]).sum(axis=1)
            by = np.lexsort((column, -score, row))
            row, column, score = row[by], column[by], score[by]
            begin = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])
            rank = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
            kept = rank < k
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row[kept] + first)), pa.array(ids[column[kept]]), pa.array(score[kept])],
                names=["user", "item", "score"])
    return hold, answer


def recommend_for_users(users: DataFrame, item_factors: DataFrame, k: int, d: int | None = None,
                        block_items: int = BLOCK_ITEMS, unit_users: int = UNIT_USERS) -> tuple[DataFrame, SearchWork]:
    """``(user, item, score, rank)`` of the ``k`` best items of every user (ties
    by item id), and the work done.  Both tables are ``(id, features)`` with
    one row per id; a user gets min(k, items) rows."""
    d = d or vector_dim(item_factors, "features")

    def normed(df):
        checked, _ = check_vectors(df.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features")),
                                   "features", d)
        return checked.withColumn("norm", F.sqrt(dot("features", "features", d)))

    placed = with_dense_position(normed(item_factors), [F.desc("norm"), "id"], "pos")
    items = written(placed.select(F.floor(F.col("pos") / block_items).cast("int").alias("block"), "id", "features", "norm"), "items")
    users = written(normed(users), "users")
    bounds = written(items.groupBy("block").agg((F.max("norm") * (1 + SLACK)).alias("greatest")), "bounds")
    n_users, n_blocks = users.count(), bounds.count()
    work = SearchWork(possible=n_users * n_blocks)
    salts = max(1, -(-n_users // unit_users))
    # a block's items go to every unit of users; a user goes to one unit a block
    held = items.select("block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("turn"),
                        "id", "features")
    order = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    top = None
    first, last = 0, 1
    while first < n_blocks and n_users:
        active = users
        if top is not None:
            kth = top.where(F.col("rank") == k).select(F.col("user").alias("id"), F.col("score").alias("kth"))
            active = users.join(kth, "id", "left")
        reach = active.select("*", F.explode(F.sequence(F.lit(first), F.lit(min(last, n_blocks) - 1))).alias("block")).join(
            bounds, "block")
        if top is not None:
            reach = reach.where(F.col("kth").isNull() | (F.col("norm") * F.col("greatest") >= F.col("kth")))
        salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
        sent = written(reach.select("block", salt.alias("salt"), F.lit(1).alias("turn"), "id", "features"), "reach")
        scored = sent.count()
        work.per_round.append(scored)
        work.scored += scored
        work.rounds += 1
        if not scored:
            break  # a bound that ends one block ends all later ones
        unit = held.where(F.col("block").between(first, last - 1)).unionByName(sent)
        found = map_units(unit, ["block", "salt"], *_best_of_block(k, d), "user long, item long, score double")
        if top is not None:
            found = found.unionByName(top.select("user", "item", "score"))
        top = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "top")
        first, last = last, 2 * last
    if top is None:
        return items.sparkSession.createDataFrame([], "user long, item long, score double, rank int"), work
    return top.select("user", "item", "score", "rank"), work

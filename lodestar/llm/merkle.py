"""Merkle manifest of a dataset, with proofs made by Octopus multiproofs.

Every row is a leaf: the hash of its fields.  The leaves of a tree (a language)
ascend by id; while a level has several nodes, every two consecutive ones (the
last may stand alone) become their hash.  What remains is the tree's subroot;
the subroots, ordered by tree, are the leaves of the top tree, whose top is the
root.  A hash is the lowercase hex SHA-256 of its inputs' concatenation.

The rows are sorted over all trees and numbered without a global window; parts
of ``PART`` consecutive leaves are the units of all that follows, so a tree that
holds most rows is many parts, and small trees share one.

Building: a part derives all nodes it can and hands on only the open ones,
those whose sibling lies outside (about two a level).  ``MERGED`` parts' open
nodes make the next round's part, until none is open.  Nodes under a part's
open ones are not stored: no other part ever needs them (of the top tree, whose
leaves are the trees, all nodes are).

Proving (Octopus): a part determines level by level the siblings that its own
leaves do not give, the least set of coordinates that completes all its paths
in its trees and in the top tree; one join fetches these nodes for all parts;
each part derives the interior nodes its leaves share once, and reads every
leaf's siblings from them.

Defined cases: null fields are hashed as ``-``; a null tree is a tree of its
own, the first.  Null ids come first in their tree; equal ids go by leaf, and
rows with equal leaves are interchangeable.  An empty table has no rows and no
root.  Extra columns are ignored.  Texts are hashed whole in the scan and go
nowhere else.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, sorted_groups, written
from lodestar.operators.splits import with_dense_position

PART_BITS = 12
MERGED_BITS = 9
#: the number of the top tree; the others count from 0
TOP = -1

_NODE = "part long, tree long, n long, level int, at long, hash string, open boolean, fresh boolean"


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields, each ``-`` if null, else its UTF-8 length, ``:`` and
    its value."""
    def part(field):
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def missing_nodes(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest (level, place) that, with the leaves at ``places`` (sorted) of
    a tree of ``n``, give all siblings on the way to the top."""
    found, level = [], 0
    while n > 1:
        sibling = places ^ 1
        absent = sibling[(sibling < n) & ~np.isin(sibling, places, assume_unique=True)]
        found += [(level, int(i)) for i in absent]
        places, n, level = np.unique(places >> 1), (n + 1) >> 1, level + 1
    return found


def derive(known: list[dict[int, str]], n: int) -> list[tuple[int, int]]:
    """Adds to ``known`` (a dict of place -> hash per level) every node whose
    children are known; returns the (level, place) of the open ones."""
    still_open = []
    for level in range(len(known) - 1):
        here, above = known[level], known[level + 1]
        for at in sorted(here):
            other = at ^ 1
            if other >= n:
                above[at >> 1] = digest(here[at])
            elif other not in here:
                still_open.append((level, at))
            elif at < other:
                above[at >> 1] = digest(here[at] + here[other])
        n = (n + 1) >> 1
    return still_open


def siblings(known: list[dict[int, str]], at: int) -> list[tuple[bool, str | None]]:
    """(is it on the left, hash) of the sibling on every level up to the top;
    the hash is None where a node stands alone."""
    out = []
    for level in known[:-1]:
        out.append((bool(at & 1), level.get(at ^ 1)))
        at >>= 1
    return out


def fold(value: str, path: list[tuple[bool, str | None]]) -> str:
    """The top that follows from a leaf and its siblings."""
    for left, other in path:
        value = digest(value if other is None else other + value if left else value + other)
    return value


def _build_first(keep_all: bool):
    """Rows of a part: its trees (turn 0), then its leaves (turn 2)."""
    def run(batches):
        for rows in sorted_groups(batches, ("part",)):
            part, trees, leaves, _ = _parted(rows)
            out = []
            for tree, (first, n) in trees.items():
                known = [{} for _ in range(height(n) + 1)]
                known[0] = {at - first: leaf for at, leaf, *_ in _of_tree(leaves, first, n)}
                still_open = set(derive(known, n))
                out += [(part, tree, n, level, at, value, (level, at) in still_open, True)
                        for level, nodes in enumerate(known) for at, value in nodes.items()
                        if keep_all or level == len(known) - 1 or (level, at) in still_open]
            yield _node_batch(out)
    return run


def _build_next(batches):
    """Open nodes of a part of parts."""
    for rows in sorted_groups(batches, ("part",)):
        part = rows.column("part")[0].as_py()
        by_tree: dict[int, tuple[int, list]] = {}
        given = set()
        for tree, n, level, at, value in zip(*(rows.column(c).to_pylist() for c in ("tree", "n", "level", "at", "hash")), strict=True):
            if tree not in by_tree:
                by_tree[tree] = n, [{} for _ in range(height(n) + 1)]
            by_tree[tree][1][level][at] = value
            given.add((tree, level, at))
        out = []
        for tree, (n, known) in by_tree.items():
            still_open = set(derive(known, n))
            out += [(part, tree, n, level, at, value, (level, at) in still_open, (tree, level, at) not in given)
                    for level, nodes in enumerate(known) for at, value in nodes.items()
                    if (level, at) in still_open or (tree, level, at) not in given]
        yield _node_batch(out)


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=[f.split()[0] for f in _NODE.split(", ")])


def _parted(rows: pa.Table):
    """(part, {tree: (first, n)}, sorted leaves, {tree: {(level, at): hash}}) of a part's rows."""
    trees, leaves, fetched = {}, [], {}
    names = ("turn", "tree", "n", "level", "at", "hash")
    for row, (turn, tree, n, level, at, value) in enumerate(zip(*(rows.column(c).to_pylist() for c in names), strict=True)):
        if turn == 0:
            trees[tree] = at, n
        elif turn == 1:
            fetched.setdefault(tree, {})[level, at] = value
        else:
            leaves.append((at, value, row))
    return rows.column("part")[0].as_py(), trees, sorted(leaves), fetched


def _of_tree(leaves: list[tuple], first: int, n: int) -> list[tuple]:
    """The leaves numbered first .. first + n - 1; a part's are consecutive."""
    start = leaves[0][0] if leaves else 0
    return leaves[max(first - start, 0):max(first + n - start, 0)]


def _missing(batches):
    """(part, tree, n, lo, hi) -> the nodes that leaves lo .. hi - 1 lack."""
    for batch in batches:
        out = []
        for part, tree, n, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("part", "tree", "n", "lo", "hi")), strict=True):
            out += [(part, tree, level, at) for level, at in missing_nodes(np.arange(lo, hi), n)]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
            names=["part", "tree", "level", "at"])


def _expand(n_trees: int, id_type: pa.DataType):
    """Proofs of a part's leaves from its trees, fetched nodes and leaves."""
    def known_nodes(n, leaves, fetched):
        known = [{} for _ in range(height(n) + 1)]
        known[0].update(leaves)
        for (level, at), value in fetched.items():
            known[level][at] = value
        derive(known, n)
        return known

    def run(batches):
        for rows in sorted_groups(batches, ("part",)):
            _, trees, leaves, fetched = _parted(rows)
            below = {tree: known_nodes(n, {at - first: leaf for at, leaf, _ in _of_tree(leaves, first, n)}, fetched.get(tree, {}))
                     for tree, (first, n) in trees.items()}
            above = known_nodes(n_trees, {tree: known[-1][0] for tree, known in below.items()}, fetched.get(TOP, {}))
            claimed = rows.column("claimed").to_pylist()
            out = []
            for tree, (first, n) in trees.items():
                known, rest = below[tree], siblings(above, tree)
                for at, leaf, row in _of_tree(leaves, first, n):
                    path = siblings(known, at - first) + rest
                    proof = digest("".join(other for _, other in path if other is not None))
                    out.append((row, leaf, known[-1][0], proof, fold(leaf if claimed[row] is None else claimed[row], path)))
            if out:
                order, *columns = zip(*out, strict=True)
                ids = rows.column("id").combine_chunks().take(pa.array(order)).cast(id_type)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.string()) for c in columns)],
                                                 names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])
    return run


class Manifest:
    """The trees over ``leaves`` (tree_key, id, leaf, and claimed: the leaf to
    fold in its place, or null).

    ``placed`` has the leaves with their numbers, ``trees`` (tree, tree_key,
    first, n), ``nodes`` the nodes that parts may ask for, the tops among them,
    and ``root`` is the root (None for an empty table)."""

    def __init__(self, leaves: DataFrame, part_bits: int = PART_BITS, merged_bits: int = MERGED_BITS):
        self.part_bits, self.merged_bits = part_bits, merged_bits
        # equal rows of any number spread over the sort's ranges by the salt
        leaves = written(leaves.select("tree_key", "id", "leaf", "claimed",
                                       F.xxhash64(F.monotonically_increasing_id()).alias("salt")), "leaves")
        order = [F.asc_nulls_first("tree_key"), F.asc_nulls_first("id"), "leaf", "salt"]
        self.placed = written(with_dense_position(leaves, order, "at").drop("salt"), "placed")
        trees = self.placed.groupBy("tree_key").agg(F.min("at").alias("first"), F.count("*").alias("n"))
        self.trees = written(with_dense_position(trees, "first", "tree"), "trees")
        self.n_trees = self.trees.count()
        self.overlaps = self.trees.select("tree", "first", "n", F.explode(F.sequence(
            F.shiftright("first", part_bits), F.shiftright(F.col("first") + F.col("n") - 1, part_bits))).alias("part"))
        below = self._build(self.placed.select("at", F.col("leaf").alias("hash")), self.overlaps)
        subroots = below.where(self._is_top()).select(F.col("tree").alias("at"), "hash")
        spark = leaves.sparkSession
        parts = spark.range(0, (self.n_trees + (1 << part_bits) - 1) >> part_bits)
        # a leaf part's trees are not a part of the top tree's leaves: keep every node
        above = self._build(subroots, parts.select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(0).cast("long").alias("first"),
            F.lit(self.n_trees).cast("long").alias("n"), F.col("id").alias("part")), keep_all=True)
        self.nodes = below.unionByName(above)
        top = above.where(self._is_top()).first()
        self.root = top["hash"] if top else None

    @staticmethod
    def _is_top() -> Column:
        return ~F.col("open") & (F.col("at") == 0) & (F.pow(F.lit(2.0), F.col("level")) >= F.col("n"))

    def _rows(self, overlaps: DataFrame, leaves: DataFrame, *more: DataFrame) -> DataFrame:
        """Rows of all parts, dealt and sorted by part."""
        def filled(df):
            kinds = {"part": "long", "turn": "int", "tree": "long", "n": "long", "level": "int", "at": "long", "hash": "string"}
            return df.select(*[F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c)
                               for c, k in kinds.items()], *[c for c in df.columns if c not in kinds])
        rows = filled(leaves.withColumn("turn", F.lit(2)).withColumn("part", F.shiftright("at", self.part_bits)))
        rows = rows.unionByName(filled(overlaps.select("part", "tree", "n", F.col("first").alias("at"), F.lit(0).alias("turn"))),
                                allowMissingColumns=True)
        for df in more:
            rows = rows.unionByName(filled(df), allowMissingColumns=True)
        return rows.repartition("part").sortWithinPartitions("part")

    def _build(self, leaves: DataFrame, overlaps: DataFrame, keep_all: bool = False) -> DataFrame:
        """Nodes (tree, n, level, at, hash, open) of the trees: the tops, all that
        join parts, and the open ones (or all) of the parts."""
        rounds = [written(map_batches(self._rows(overlaps, leaves), _build_first(keep_all), _NODE), "nodes")]
        while not rounds[-1].where("open").isEmpty():
            still_open = rounds[-1].where("open").withColumn("part", F.shiftright("part", self.merged_bits))
            rounds.append(written(map_batches(still_open.repartition("part").sortWithinPartitions("part"), _build_next, _NODE), "nodes"))
        nodes = rounds[0].where("fresh")
        for more in rounds[1:]:
            nodes = nodes.unionByName(more.where("fresh"))
        return nodes.select("tree", "n", "level", "at", "hash", "open")

    def proofs(self) -> DataFrame:
        """id, leaf, subroot, root, proof_sha256, folded_root and verified of
        every leaf."""
        start = F.shiftleft("part", self.part_bits)
        lo, hi = F.greatest("first", start), F.least(F.col("first") + F.col("n"), start + (1 << self.part_bits))
        own = self.overlaps.select("part", "tree", "n", (lo - F.col("first")).alias("lo"), (hi - F.col("first")).alias("hi"))
        tops = self.overlaps.groupBy("part").agg(F.min("tree").alias("lo"), (F.max("tree") + 1).alias("hi")).select(
            "part", F.lit(TOP).cast("long").alias("tree"), F.lit(self.n_trees).cast("long").alias("n"), "lo", "hi")
        wanted = map_batches(own.unionByName(tops), _missing, "part long, tree long, level int, at long")
        fetched = wanted.join(self.nodes.select("tree", "level", "at", "hash"), ["tree", "level", "at"]).select(
            "part", F.lit(1).alias("turn"), "tree", "level", "at", "hash")
        kind = self.placed.schema["id"].dataType
        leaves = self.placed.select("at", F.col("leaf").alias("hash"), "id", "claimed")
        from pyspark.sql.pandas.types import to_arrow_type
        out = map_batches(self._rows(self.overlaps, leaves, fetched), _expand(self.n_trees, to_arrow_type(kind)),
                          f"id {kind.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string")
        root = F.lit(self.root).cast("string")
        return out.select("id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                          (F.col("folded_root") == root).alias("verified"))


def oracle(every: int) -> str:
    """DuckDB SQL for the query, where rows whose id's crc32 ``every`` divides
    have another n_chars in the leaf to fold."""
    def field(x):
        return f"coalesce(strlen({x}) || ':' || ({x}), '-')"

    def leaf(n_chars):
        return "sha256(" + " || ".join(field(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    # message bits, lowest first; reflected polynomial
    bits = ("flatten(list_transform(range(strlen({x})), lambda i: list_transform(range(8), "
            "lambda j: (ascii(substr({x}, i + 1, 1)) >> j) & 1)))").format(x="CAST(doc_id AS VARCHAR)")
    crc = (f"xor(list_reduce(list_transform({bits}, lambda b: CAST(b AS BIGINT)), "
           "lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), 4294967295::BIGINT), 4294967295)")
    up = """{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, ix // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY ix)) FROM {name} WHERE n > 1
  GROUP BY tree, level, ix // 2, n)"""
    walk = """{name} AS (
  {start}
  UNION ALL
  SELECT w.r, w.tree, w.level + 1, w.ix // 2, (w.n + 1) // 2, w.proof || coalesce(s.h, ''),
         sha256(CASE WHEN w.ix % 2 = 1 THEN s.h || w.folded ELSE w.folded || coalesce(s.h, '') END)
  FROM {name} w LEFT JOIN {nodes} s ON s.tree = w.tree AND s.level = w.level AND s.ix = xor(w.ix, 1)
  WHERE w.n > 1)"""
    return f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, lang, {leaf('n_chars')} AS leaf,
         CASE WHEN {crc} % {every} = 0 THEN {leaf('CAST(n_chars AS HUGEINT) + 1')} END AS claimed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ix,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM doc),
{up.format(name='up', start='SELECT tree, 0 AS level, ix, n, leaf AS h FROM placed')},
tops AS (SELECT tree, h FROM up WHERE n = 1),
{up.format(name='high', start='SELECT CAST(0 AS BIGINT) AS tree, 0 AS level, tree AS ix, count(*) OVER () AS n, h FROM tops')},
{walk.format(name='walk', nodes='up', start="SELECT r, tree, 0 AS level, ix, n, '' AS proof, coalesce(claimed, leaf) AS folded FROM placed")},
{walk.format(name='climb', nodes='high', start="SELECT r, CAST(0 AS BIGINT) AS tree, 0 AS level, tree AS ix, (SELECT count(*) FROM tops) AS n, proof, folded FROM walk WHERE n = 1")}
SELECT doc_id, leaf, t.h AS subroot, root.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
       c.folded = root.h AS verified
FROM placed p JOIN climb c ON c.r = p.r AND c.n = 1 JOIN tops t ON t.tree = p.tree
CROSS JOIN (SELECT h FROM high WHERE n = 1) root
"""

"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact check.

Two documents are linked when the Jaccard similarity of their sets of
five-word shingles is ``THRESHOLD`` or more (a text of 1 to 4 words has one
shingle of all of them).

1. One pass over the texts gives each document a 128-bit BLAKE2 key of its
   word sequence, ``HASHES`` MinHash values and ``BANDS`` band hashes of ``ROWS``
   values.  Documents of equal key form a class; only classes go on, with
   their number of copies.
2. Classes that share a band meet in that band's bucket.  A bucket of more
   than ``BLOCK`` classes is dealt into blocks, and each pair of blocks is a
   unit of work, so no task holds more than two blocks and no row stands for
   a pair.  A pair is handled only in the first band it shares.
3. Within a unit the MinHash values are compared ``STEP`` at a time.  With m
   of n equal, the posterior of similarity >= ``THRESHOLD`` under a uniform
   prior is P(Binomial(n + 1, THRESHOLD) <= m); pairs below ``TOLERANCE`` are
   dropped.  (Having met in a band only raises m, so it never costs a link.)
   A unit hands on the classes that are left in some pair, not the pairs.
4. The texts of these classes are fetched; the unit's pairs are found again from
   the values and compared exactly.  A unit returns, per class, the number of
   linked documents and the least key reached by its links, so no row is ever
   written for a pair.
5. Connected components over those keys, by label propagation with pointer
   jumping; every round is written to the shared folder.

A linked pair shares no band with probability (1 - 0.8^4)^24 = 3e-6 at the
threshold itself, and falls to 1e-10 at 0.9.

Defined cases: null, empty and wordless texts link to nothing and form
classes of their own.  Repeated rows count as copies.  Null doc_ids are
documents like others; a class's id is its least non-null doc_id (null if it
has none).  Extra columns are ignored (``linked_documents``) or passed
through whatever their names (``drop_near_copies``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import free_names, map_batches, sorted_groups, written
from lodestar.llm.words import U64, Words, doc_shingles, mix, segment_sum, slices

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
BANDS = 24
ROWS = 4
STEP = 32
TOLERANCE = 1e-6
BLOCK = 512
BROADCAST_ROWS = 1_000_000
SALTS = 16

_rng = np.random.default_rng(19970611)
_MUL = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def least_matches(n: int) -> int:
    """The fewest of ``n`` equal values whose posterior reaches TOLERANCE."""
    below = 0.0
    for m in range(n + 2):
        below += math.comb(n + 1, m) * THRESHOLD**m * (1 - THRESHOLD) ** (n + 1 - m)
        if below >= TOLERANCE:
            return m
    return n + 1


LEAST = {n: least_matches(n) for n in range(STEP, HASHES + 1, STEP)}


def minhashes(words: Words) -> np.ndarray:
    """(documents x HASHES) values; rows of wordless texts are 0."""
    hashes, _, counts = doc_shingles(words, SHINGLE)
    out = np.zeros((words.n_docs, HASHES), dtype=np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        for i in range(HASHES):
            out[full, i] = np.minimum.reduceat(hashes * _MUL[i] + _ADD[i], begin) >> U64(32)
    return out


def band_hashes(values: np.ndarray) -> np.ndarray:
    out = np.empty((len(values), BANDS), dtype=U64)
    for b in range(BANDS):
        h = np.full(len(values), b + 1, dtype=U64)
        for j in range(ROWS):
            h = mix(h * U64(0x9E3779B97F4A7C15) + values[:, b * ROWS + j])
        out[:, b] = h
    return out.view(np.int64)


def _sketch(batches):
    for batch in batches:
        for part in slices(batch, "text", 1 << 19):
            words = Words(part.column("text"))
            values = minhashes(words)
            bands = band_hashes(values)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.text_keys(), pa.binary()),
                 pa.array(list(bands), pa.list_(pa.int64())),
                 pa.array([v.tobytes() for v in values], pa.binary())],
                names=["doc_id", "key", "bands", "values"])


UNIT = ("bucket", "low", "high")


def surviving_pairs(values: np.ndarray, block: np.ndarray, low: int, high: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a unit that pruning leaves."""
    left = np.flatnonzero(block == low)
    right = np.flatnonzero(block == high)
    found_a, found_b = [], []
    rows = max(1, (1 << 16) // max(len(right), 1))
    for first in range(0, len(left), rows):
        a, b = (x.ravel() for x in np.meshgrid(left[first:first + rows], right, indexing="ij"))
        if low == high:
            a, b = a[a < b], b[a < b]
        # a pair is handled in the first band it shares
        for earlier in range(band):
            own = slice(earlier * ROWS, (earlier + 1) * ROWS)
            apart = (values[a, own] != values[b, own]).any(axis=1)
            a, b = a[apart], b[apart]
        matches = np.zeros(len(a), dtype=np.int64)
        for n in range(STEP, HASHES + 1, STEP):
            matches += (values[a, n - STEP:n] == values[b, n - STEP:n]).sum(axis=1)
            keep = matches >= LEAST[n]
            a, b, matches = a[keep], b[keep], matches[keep]
        found_a.append(a)
        found_b.append(b)
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *found_a]), np.concatenate([empty, *found_b])


def _unit_pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    first = {c: group.column(c)[0].as_py() for c in (*UNIT, "band")}
    values = np.frombuffer(b"".join(group.column("values").to_pylist()), np.uint32).reshape(-1, HASHES)
    return surviving_pairs(values, group.column("block").to_numpy(), first["low"], first["high"], first["band"])


def _prune(batches):
    """The rows of a unit that are in a surviving pair; the pairs stay here."""
    for group in sorted_groups(batches, UNIT):
        kept = np.unique(np.concatenate(_unit_pairs(group)))
        if len(kept):
            yield from group.take(pa.array(kept)).combine_chunks().to_batches()


def exact_links(texts, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """The (left, right) pairs of texts whose Jaccard similarity holds."""
    hashes, docs, _ = doc_shingles(Words(pa.array(texts, pa.large_string())), SHINGLE)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[fresh], docs[fresh]
    size = np.bincount(docs, minlength=len(texts))
    begin = np.cumsum(size) - size
    linked = []
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    for i in np.unique(left).tolist():
        others = right[np.searchsorted(left, i):np.searchsorted(left, i, side="right")]
        own = hashes[begin[i]:begin[i] + size[i]]
        for part in np.array_split(others, max(1, int(size[others].sum()) >> 20)):
            n = size[part]
            theirs = hashes[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            shared = segment_sum((own[at] == theirs).astype(np.int64), n)
            # shared / union >= 4/5
            linked += [(i, int(j)) for j in part[5 * shared >= 4 * (size[i] + n - shared)]]
    return linked


def _verify(batches):
    for group in sorted_groups(batches, UNIT):
        keys, copies = group.column("key").to_pylist(), group.column("copies").to_pylist()
        pairs = _unit_pairs(group)
        links = [0] * len(keys)
        root = list(range(len(keys)))

        def find(i, root=root):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in exact_links(group.column("text").to_pylist(), *pairs):
            links[i] += copies[j]
            links[j] += copies[i]
            a, b = sorted((find(i), find(j)), key=lambda x: keys[x])
            root[b] = a
        linked = [i for i, n in enumerate(links) if n]
        if linked:
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in linked], pa.binary()), pa.array([links[i] for i in linked], pa.int64()),
                 pa.array([keys[find(i)] for i in linked], pa.binary())], names=["key", "links", "root"])


def _with_key(name: str):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(Words(part.column("text")).text_keys(), pa.binary())],
                    names=[*part.schema.names, name])
    return run


def small(df: DataFrame) -> DataFrame:
    """``df`` (written, narrow), broadcast only if it has at most
    BROADCAST_ROWS rows; otherwise the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def join_hot(rows: DataFrame, one_each: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``rows`` left-joined with ``one_each`` (a row per ``key``).  A key may
    hold most of ``rows``: they are dealt by ``spread_by`` over ``SALTS`` tasks
    a key, and ``one_each`` is sent to all of them."""
    salt = free_names(rows, "salt")[0]
    left = rows.withColumn(salt, F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    right = one_each.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, salt], "left").drop(salt)


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the least key of each connected component."""
    both = written(edges.select(F.col("key").alias("a"), F.col("root").alias("b")).distinct()
                   .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                           .alias("e")).select("e.a", "e.b"), "edges")
    labels = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("near")).select(
        "key", F.least("key", "near").alias("label"))
    while True:
        near = join_hot(both, labels.withColumnRenamed("key", "b"), "b", "a").groupBy(F.col("a").alias("key")).agg(
            F.min("label").alias("near"))
        nearer = labels.join(near, "key", "left").select(
            "key", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = nearer.select(F.col("key").alias("label"), F.col("label").alias("beyond"))
        labels = written(join_hot(nearer, jump, "label", "key").select(
            "key", F.least("label", F.coalesce("beyond", "label")).alias("label"), "old"), "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("key", "label")
        labels = labels.select("key", "label")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, key), (classes: key, rep, copies, links, label)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketched = written(map_batches(docs.select("doc_id", "text"), _sketch,
                                   f"doc_id {kind}, key binary, bands array<long>, values binary"), "sketches")
    classes = written(sketched.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"),
        F.first("values").alias("values")), "classes")
    rows = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(shared, "bucket")
    blocks = F.ceil(F.col("n") / BLOCK)
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    units = rows.select(
        "bucket", "band", "key", "block",
        F.explode(F.expr("transform(sequence(0L, blocks - 1), j -> struct(least(block, j) AS low, "
                         "greatest(block, j) AS high))")).alias("u")).select(
        "bucket", "band", "key", "block", "u.low", "u.high")
    units = units.join(classes.select("key", "copies", "values"), "key").select(*UNIT, "band", "block", "key", "copies", "values")
    pruned = written(map_batches(units.repartition(*UNIT).sortWithinPartitions(*UNIT), _prune, units.schema), "pruned")

    needed = written(pruned.select("key").distinct().join(classes.select("key", "rep"), "key"), "needed")
    texts = docs.select("doc_id", "text").join(
        small(needed.select("rep").distinct()), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    texts = map_batches(texts, _with_key("key"), f"doc_id {kind}, text string, key binary").select(
        "key", "text").where("key is not null").dropDuplicates(["key"])
    verified = written(map_batches(
        pruned.join(texts, "key").repartition(*UNIT).sortWithinPartitions(*UNIT), _verify,
        "key binary, links long, root binary"), "verified")
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    labels = components(verified.select("key", "root"))
    classes = classes.select("key", "rep", "copies").join(links, "key", "left").join(labels, "key", "left").select(
        "key", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "key").alias("label"))
    return sketched.select("doc_id", "key"), written(classes, "linked")


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of its group of linked documents) and
    n_links (documents similar to it, copies included), a row per document."""
    rows, classes = _classes(docs)  # exact copies share a key: the document joins are hot too
    ids = classes.groupBy("label").agg(F.min("rep").alias("class_id"))
    by_key = join_hot(classes, ids, "label", "key").select("key", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return join_hot(rows, by_key, "key", "doc_id").select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, but of each group of linked documents only the
    one of least doc_id (ties: least key; of equal rows, one)."""
    rows, classes = _classes(docs)
    best = classes.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "key")).alias("b")).select(
        "label", F.col("b.rep").alias("best_id"), F.col("b.key").alias("best_key"))
    labelled = join_hot(classes.select("key", "label"), best, "label", "key")
    counted = rows.where("key is not null").groupBy("doc_id", "key").agg(F.count("*").alias("n"))
    counted = join_hot(counted, labelled, "key", "doc_id")
    is_best = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("key") == F.col("best_key"))
    key, gone_id, gone_key = free_names(docs, "text_key", "gone_id", "gone_key")
    again = free_names(docs, "again")[0]
    out = written(counted.where(~is_best | (F.col("n") > 1)).select(
        F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key), is_best.alias(again)), "gone")
    keyed = map_batches(docs, _with_key(key), T.StructType([*docs.schema.fields, T.StructField(key, T.BinaryType())]))
    match = keyed["doc_id"].eqNullSafe(out[gone_id]) & (keyed[key] == out[gone_key])
    kept = keyed.join(small(out), match, "left_anti")
    once = keyed.join(small(out.where(F.col(again))), match, "left_semi").dropDuplicates(["doc_id", key])
    return kept.unionByName(once).drop(key)

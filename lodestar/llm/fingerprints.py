"""Document fingerprints: one-permutation MinHash, optimally densified, b bits.

A text's five-word shingles (fewer words: one shingle of all of them) are
hashed once.  The top bits pick one of ``BINS`` bins, each bin keeps its
smallest value.  An empty bin borrows from the first non-empty bin in its own
fixed random order (optimal densification).  The fingerprint stores ``BITS``
low bits of every bin's value, re-hashed per bin; likeness is the share of agreeing bins corrected
for chance agreement, ``(share - 2^-BITS) / (1 - 2^-BITS)``, kept in 0..1.

``edited_fingerprints`` compares each document with an edited copy and with
its successor in descending doc_id.  Documents are range-dealt by bounds on
doc_id found first; the head of every range is also sent to the range before
it, so successors are local and one shuffle suffices.

Defined cases: null is the empty text; a text without words has the empty
fingerprint, whose likeness is 1 to another such and 0 to any other.  Null
doc_ids come last, rows of equal doc_id in the order of their texts' hash; a
single row is its own successor.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches
from lodestar.llm.words import U64, Words, doc_shingles, mix, slices

BINS = 512
BITS = 4
SHINGLE = 5
CHUNK_CHARS = 1 << 20
_EMPTY = np.uint64(2**64 - 1)


@functools.cache
def _orders() -> tuple[np.ndarray, np.ndarray]:
    """Per bin, its random order of all bins, and every bin's rank in it."""
    rng = np.random.default_rng(20170806)
    order = rng.permuted(np.tile(np.arange(BINS, dtype=np.uint16), (BINS, 1)), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order.astype(np.int64), np.arange(BINS, dtype=np.uint16)[None, :], axis=1)
    return order, rank


def densify(values: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each non-empty row from its non-empty bins."""
    order, rank = _orders()
    full = values != _EMPTY
    n_full = full.sum(axis=1)
    out = values.copy()
    for d in np.flatnonzero((n_full > 0) & (n_full <= 64)):
        own = np.flatnonzero(full[d])
        need = np.flatnonzero(~full[d])
        out[d, need] = values[d, own[rank[need][:, own].argmin(axis=1)]]
    rows, bins = np.nonzero(~full & (n_full > 64)[:, None])
    step = 0
    while len(rows):
        source = order[bins, step]
        ok = full[rows, source]
        out[rows[ok], bins[ok]] = values[rows[ok], source[ok]]
        rows, bins, step = rows[~ok], bins[~ok], step + 1
    return out


def sketch(column) -> tuple[np.ndarray, np.ndarray]:
    """(low bits per bin, whether the text has words) of a column of texts."""
    words = Words(column)
    hashes, docs, counts = doc_shingles(words, SHINGLE)
    values = np.full(words.n_docs * BINS, _EMPTY, dtype=U64)
    width = BINS.bit_length() - 1
    at = docs * BINS + (hashes >> U64(64 - width)).astype(np.int64)
    np.minimum.at(values, at, hashes & U64((1 << (64 - width)) - 1))
    values = densify(values.reshape(words.n_docs, BINS))
    # re-hashed per bin, so that copies of one value do not all agree by chance
    values = mix(values + np.arange(BINS, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return (values & U64((1 << BITS) - 1)).astype(np.uint8), counts > 0


def pack(low: np.ndarray, has_words: np.ndarray) -> list[str]:
    """Two 4-bit values a byte, in base64; empty for texts without words."""
    packed = low[:, 0::2] << 4 | low[:, 1::2]
    return [base64.b64encode(p.tobytes()).decode() if w else "" for p, w in zip(packed, has_words, strict=True)]


def likeness(a: np.ndarray, a_words: np.ndarray, b: np.ndarray, b_words: np.ndarray) -> np.ndarray:
    chance = 2.0 ** -BITS
    share = (a == b).mean(axis=1)
    both = np.clip((share - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_words & b_words, both, (a_words == b_words).astype(float))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(pack(*sketch(part.column("text"))), pa.string())],
                    names=["doc_id", "fingerprint"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, fingerprint string")


def _with_successors(batches):
    """(ids, texts, successors' texts) in chunks; a partition's rows come in
    order, with the next range's head last."""
    ids: list = []
    texts: list[str] = []
    size = 0
    closed = False
    for batch in batches:
        for i, text, copy in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                 batch.column("copy").to_pylist(), strict=True):
            if closed:
                continue
            closed = copy
            ids.append(i)
            texts.append(text or "")
            size += len(texts[-1])
            if size > CHUNK_CHARS and len(ids) > 1:
                yield ids[:-1], texts
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield ids[:-1], texts


def _compare(batches):
    for ids, texts in _with_successors(batches):
        m = len(ids)
        edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2]
                  for t, after in zip(texts[:-1], texts[1:], strict=True)]
        low, has = sketch(pa.array(texts, pa.large_string()))
        low_e, has_e = sketch(pa.array(edited, pa.large_string()))
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array(pack(low[:m], has[:m]), pa.string()), pa.array(pack(low_e, has_e), pa.string()),
            pa.array(likeness(low[:m], has[:m], low_e, has_e)),
            pa.array(likeness(low[:m], has[:m], low[1:], has[1:]))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"])


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` (doc_id, text) dealt by descending doc_id into ``ranges``
    sorted partitions, each followed by copies of the next one's head (the
    last by the first one's), marked ``copy``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.bitwise_not(F.xxhash64(F.coalesce("text", F.lit("")))).alias("tie"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5],
                                        10000).alias("c")).first()["c"]
    splits = [float("-inf"), *sorted({float(c) for c in cuts or [0]}), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="as_double", outputCol="bucket", handleInvalid="keep").transform(
        rows.withColumn("as_double", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan")))))
    last = len(splits) - 2
    # the highest ids first; handleInvalid's extra bucket (null ids) last
    place = F.when(F.col("bucket") > last, F.lit(last + 1)).otherwise(last - F.col("bucket")).cast("int")
    rows = rows.select("doc_id", "text", "tie", place.alias("place"))
    heads = rows.groupBy("place").agg(F.max(F.struct("doc_id", "tie")).alias("h")).orderBy("place").collect()
    if not heads:
        return rows.select("doc_id", "text", F.lit(False).alias("copy"))
    before = docs.sparkSession.createDataFrame(  # a row per range
        [(h["place"], h["h"]["doc_id"], h["h"]["tie"], heads[i - 1]["place"]) for i, h in enumerate(heads)],
        "place int, head_id long, head_tie long, before int")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    stay = F.struct(F.col("place").alias("to"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("before").alias("to"), F.lit(True).alias("copy"))
    rows = rows.join(F.broadcast(before), "place").select(
        "doc_id", "text", "tie", F.explode(F.when(is_head, F.array(stay, copy)).otherwise(F.array(stay))).alias("x"))
    return (rows.select("doc_id", "text", "tie", "x.to", "x.copy").repartitionById(last + 2, "to")
            .sortWithinPartitions("copy", F.desc_nulls_last("doc_id"), F.desc("tie"))
            .select("doc_id", "text", "copy"))


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of its
    code points replaced by the first as many of the successor's."""
    if ranges is None:
        ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(in_ranges(docs, ranges), _compare,
                       "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double")

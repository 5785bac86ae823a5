"""Benchmark decontamination by winnowing.

Training and test texts are fingerprinted alike: hash every ``K`` words, keep
the minimum of each run of ``SPAN - K + 1`` consecutive hashes.  Any shared
run of ``SPAN`` words therefore shares a kept fingerprint.  Document
fingerprints probe the benchmark's; each hit is extended to the ``SPAN``-word
windows around it, and a window counts only if its words are equal to an
item's window, word for word.  Items of 1 to SPAN-1 words are one window of
their own length; for these every run of that length is a fingerprint.

Documents never shuffle.  The benchmark goes to the tasks in blocks of at
most ``BLOCK_CHARS`` characters (measured first); a larger benchmark takes
several passes over the documents, each adding to the spans found so far, so
neither the index in a task nor what the driver holds grows with it.

Defined cases: a null, empty or wordless text has no words and no hits.  A
null, empty or wordless benchmark text has no window.  A null item_id marks
words but is neither listed nor counted.  Repeated item ids count once,
repeated documents give one row each, an empty benchmark clears everything.
Extra columns are ignored (``find_leaks``) or passed through
(``drop_leaks``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, written
from lodestar.llm.words import U64, Words, gram_hashes, mix, segment_sum, slices

SPAN = 10
K = 5
BLOCK_CHARS = 4_000_000
_BITS = 1 << 20


@dataclass
class _Grams:
    """Sorted hashes with the word position each came from."""

    hashes: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, first: np.ndarray) -> _Grams:
        order = np.argsort(hashes, kind="stable")
        return cls(hashes[order], first[order])

    def seen(self) -> np.ndarray:
        bits = np.zeros(_BITS, dtype=bool)
        bits[self.hashes & U64(_BITS - 1)] = True
        return bits


def winnow(words: Words, span: int = SPAN, k: int = K) -> np.ndarray:
    """Positions of the kept ``k``-grams: in every ``span``-word window inside
    a document, those with the window's minimum hash."""
    grams = gram_hashes(words.hash, k)
    starts = len(words.hash) - span + 1
    if starts <= 0:
        return np.zeros(0, np.int64)
    width = span - k + 1
    least = grams[:starts].copy()
    for j in range(1, width):
        np.minimum(least, grams[j:j + starts], out=least)
    valid = window_starts(words, span)
    kept = np.zeros(len(grams), dtype=bool)
    for j in range(width):
        kept[j:j + starts] |= (grams[j:j + starts] == least) & valid
    return np.flatnonzero(kept)


def window_starts(words: Words, span: int) -> np.ndarray:
    """True where a run of ``span`` words starts that stays in its document."""
    starts = len(words.hash) - span + 1
    valid = np.ones(max(starts, 0), dtype=bool)
    for d in np.flatnonzero(words.n_words > 0):
        valid[max(words.lo[d], words.hi[d] - span + 1):words.hi[d]] = False
    return valid


class BenchmarkIndex:
    """Fingerprints and windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], span: int = SPAN, k: int = K):
        self.span, self.k = span, k
        self.ids = [i for i, _ in items]
        self.words = words = Words(pa.array([t for _, t in items], type=pa.large_string()))
        self.item_of = words.doc_of_word()
        kept = winnow(words, span, k)
        self.prints = np.unique(gram_hashes(words.hash, k)[kept]) if len(kept) else np.zeros(0, U64)
        self.bits = np.zeros(_BITS, dtype=bool)
        self.bits[self.prints & U64(_BITS - 1)] = True
        first = np.flatnonzero(window_starts(words, span))
        self.windows = {span: _Grams.of(gram_hashes(words.hash, span)[first], first)} if len(first) else {}
        for n in range(1, span):
            first = words.lo[words.n_words == n]
            if len(first):
                self.windows[n] = _Grams.of(gram_hashes(words.hash, n)[first], first)

    def candidates(self, words: Words, n: int) -> np.ndarray:
        """Starts of the ``n``-word runs worth comparing with the windows."""
        if len(words.hash) < n:
            return np.zeros(0, np.int64)
        valid = window_starts(words, n)
        if n < self.span:
            hashes = gram_hashes(words.hash, n)
            return np.flatnonzero(valid & self.windows[n].seen()[hashes & U64(_BITS - 1)])
        kept = winnow(words, self.span, self.k)
        prints = gram_hashes(words.hash, self.k)[kept]
        maybe = self.bits[prints & U64(_BITS - 1)]
        kept, prints = kept[maybe], prints[maybe]
        at = np.searchsorted(self.prints, prints)
        hits = kept[self.prints[np.minimum(at, len(self.prints) - 1)] == prints] if len(kept) else kept
        near = np.zeros(len(words.hash) + self.span, dtype=bool)
        for back in range(self.span - self.k + 1):
            near[np.maximum(hits - back, 0)] = True
        return np.flatnonzero(near[:len(valid)] & valid)

    def matches(self, words: Words) -> list[tuple[int, int, list[int]]]:
        """(start, length, items) of the document runs equal to a window."""
        found = []
        for n, grams in self.windows.items():
            starts = self.candidates(words, n)
            if not len(starts):
                continue
            hashes = words.hash[starts].copy()
            for j in range(1, n):
                hashes *= U64(0x9E3779B97F4A7C15)
                hashes += words.hash[starts + j]
            hashes = mix(hashes)
            lo = np.searchsorted(grams.hashes, hashes, side="left")
            hi = np.searchsorted(grams.hashes, hashes, side="right")
            same: dict[bytes, list[int]] = {}
            for i in np.flatnonzero(hi > lo):
                phrase = words.phrase(int(starts[i]), n)
                items = same.get(phrase)
                if items is None:
                    firsts = grams.first[lo[i]:hi[i]]
                    items = same[phrase] = sorted({int(self.item_of[f]) for f in firsts
                                                   if self.words.phrase(int(f), n) == phrase})
                if items:
                    found.append((int(starts[i]), n, items))
        return found


_LEAKS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _spans(hit: np.ndarray) -> list[dict]:
    """Maximal runs of True as word positions, both ends inclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _scan(index_of, carried: bool):
    def run(batches):
        index = index_of.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                hit = np.zeros(len(words.hash), dtype=bool)
                items: dict[int, set[str]] = {}
                doc_of = None
                if carried:
                    for d, (spans, ids) in enumerate(zip(part.column("spans").to_pylist(),
                                                         part.column("items").to_pylist(), strict=True)):
                        for s in spans:
                            hit[words.lo[d] + s["first"]:words.lo[d] + s["last"] + 1] = True
                        if ids:
                            items[d] = set(ids)
                found = index.matches(words)
                if found:
                    doc_of = words.doc_of_word()
                for start, n, own in found:
                    hit[start:start + n] = True
                    items.setdefault(int(doc_of[start]), set()).update(
                        index.ids[i] for i in own if index.ids[i] is not None)
                any_hit = segment_sum(hit.astype(np.int64), words.n_words)
                spans = [_spans(hit[words.lo[d]:words.hi[d]]) if any_hit[d] else [] for d in range(words.n_docs)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(words.n_words, pa.int64()),
                     pa.array(spans, _LEAKS),
                     pa.array([sorted(items.get(d, ())) for d in range(words.n_docs)], pa.list_(pa.string()))],
                    names=["doc_id", "text", "n_words", "spans", "items"])
    return run


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """The benchmark's indexes, one per block of about ``block_chars``."""
    spark = benchmark.sparkSession
    # copies of an item would all go to one block
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(block == b).orderBy("item_id", "text").collect() if blocks > 1 else items.collect()
        yield spark.sparkContext.broadcast(BenchmarkIndex([(r["item_id"], r["text"]) for r in rows]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_words, spans (word positions inside any occurring window) and
    items (sorted ids of the items with occurring windows), a row per document."""
    out = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, text string, n_words long, "
              "spans array<struct<first:int,last:int>>, items array<string>")
    carried = False
    for index in benchmark_blocks(benchmark, block_chars):
        if carried:
            out = written(out, "leaks")  # one block's index in a task at a time
        out = map_batches(out, _scan(index, carried), schema)
        carried = True
    return out.drop("text")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of the benchmark."""
    def keep(index_of):
        def run(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    words = Words(part.column("text"))
                    clean = np.ones(words.n_docs, dtype=bool)
                    found = index_of.value.matches(words)
                    if found:
                        doc_of = words.doc_of_word()
                        clean[[doc_of[s] for s, _, _ in found]] = False
                    yield part.filter(pa.array(clean))
        return run

    first = True
    for index in benchmark_blocks(benchmark, block_chars):
        docs = docs if first else written(docs, "clean")
        docs, first = map_batches(docs, keep(index), docs.schema), False
    return docs


def leak_report(leaks: DataFrame) -> DataFrame:
    """The digest columns of ``find_leaks``' rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return leaks.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))

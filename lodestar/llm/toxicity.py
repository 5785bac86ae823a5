"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its byte n-grams (3 to 5,
with word marks) and of the whole word, all hashed into ``BUCKETS`` rows; a
passage of ``PASSAGE`` words is the mean of its words' vectors; a linear
softmax turns it into P(toxic).  Passages start every ``STRIDE`` words, the
last one ends with the text.  A document scores as its most toxic passage, so a
few words in a long text are not diluted.  Unseen spellings share n-grams with
seen ones.

Embeddings and softmax are trained jointly with Adam in numpy on a bounded
sample: at most about ``TRAIN_ROWS`` labelled documents and ``TRAIN_BYTES`` of
text, half of the bounds per class, drawn by the hash of their id and weighted
back to the classes' true shares.  Tasks turn the sample, dealt by the hash of
its texts into ``BATCHES`` batches, into compact blocks (word ids and the
distinct words' n-grams, at most ``BLOCK_BYTES`` of text each, about four bytes
per byte of it); the steps, one batch each, run in one task that holds the blocks and no texts, so the
bounds are also its bounds in time and memory, whatever the input.  A training
document's loss weighs its passages by a softmax over their scores that
sharpens from the plain mean to the maximum.

Scoring is one narrow pass: the trained model reduces to a number per n-gram
bucket (``BUCKETS`` doubles sent to the tasks), whatever the input size.  Every
distinct word of a slice of texts is cut into n-grams once.

Defined cases: null, empty and wordless texts score the softmax's bias.
Labels that are null or not 0/1 and labels without a document are ignored;
repeated labels count once (the greatest), and of documents of one doc_id the
text of least hash trains.  Without labels of both classes every score is the
share of toxic labels (0 without any).  A text is never cut; scoring takes about
20 bytes per byte of it.  Extra columns are ignored (``score``) or passed
through (``drop_toxic``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import is_held_out, map_batches, written
from lodestar.llm.words import U64, Words, mix, segment_sum, slices, word_portions

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
PASSAGE = 8
DIM = 8
TRAIN_ROWS = 20_000
TRAIN_BYTES = 128 << 20
HELD_OUT = (5, 0)
EPOCHS = 14
BATCHES = 24
RATE = 0.05
STRIDE = 4
BLOCK_BYTES = 4 << 20


def word_grams(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, number per word) of the words ``which``: byte
    n-grams of ``<word>`` and the word itself."""
    start = words.start[which]
    n = words.end[which] - start
    # every word between two marks, back to back
    size = n + 2
    begin = np.cumsum(size) - size
    total = int(size.sum())
    text = np.full(total, 1, dtype=np.uint8)
    body = np.ones(total, dtype=bool)
    body[begin] = body[begin + n + 1] = False
    inside = np.repeat(start, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    text[body] = words.data[inside]
    codes = text.astype(U64)
    owner = np.repeat(np.arange(len(n)), size)
    left = (np.repeat(begin + size, size) - np.arange(total)).astype(np.int32)  # bytes to the word's end
    grams, owners = [words.hash[which]], [np.arange(len(n))]
    rolled = codes.copy()
    for k in range(2, max(GRAMS) + 1):
        if total < k:
            break
        rolled = rolled[:total - k + 1] * U64(0x100000001B3) + codes[k - 1:]
        if k in GRAMS:
            at = np.flatnonzero(left[:total - k + 1] >= k)
            grams.append(mix(rolled[at] + U64(k)))
            owners.append(owner[at])
    ids, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (ids[order] & U64(BUCKETS - 1)).astype(np.int32), np.bincount(owners, minlength=len(n))


def passages(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, number per text) of the passages of texts whose words
    stand back to back: every ``STRIDE`` words, the last one at the end."""
    per_doc = np.where(n_words > PASSAGE, 1 - (-(n_words - PASSAGE) // STRIDE), (n_words > 0).astype(n_words.dtype))
    within = np.arange(int(per_doc.sum())) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    n = np.repeat(n_words, per_doc)
    first = np.minimum(within * STRIDE, np.maximum(n - PASSAGE, 0))
    return first + np.repeat(np.cumsum(n_words) - n_words, per_doc), np.minimum(n, PASSAGE), per_doc


def passage_scores(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean of the words' numbers over each passage."""
    total = np.zeros(len(first))
    for k in range(PASSAGE):  # one way of adding, wherever a passage stands
        total += np.where(k < size, word[np.minimum(first + k, len(word) - 1)], 0.0)
    return total / size


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


class Block:
    """Training texts as word ids, the distinct words' n-gram buckets, labels
    and weights."""

    def __init__(self, tokens, n_words, grams, per_word, toxic, weight):
        self.tokens, self.n_words, self.grams, self.per_word = tokens, n_words, grams, per_word
        self.toxic, self.weight = toxic, weight
        self.first, self.size, self.per_doc = passages(n_words)

    #: how the arrays are written
    TYPES = (np.int32, np.int64, np.uint16, np.int32, np.float64, np.float64)

    @classmethod
    def of(cls, column, toxic, weight) -> Block:
        """Of texts; those without words are left out."""
        words = Words(column)
        own = words.n_words > 0
        distinct, where, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        parts = [word_grams(words, p) for _, p in word_portions(words, where)]
        grams = np.concatenate([np.zeros(0, np.int32), *(g for g, _ in parts)])
        per_word = np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
        return cls(inverse.astype(np.int32), words.n_words[own], grams.astype(np.uint16), per_word.astype(np.int32),
                   np.asarray(toxic, dtype=float)[own], np.asarray(weight, dtype=float)[own])

    def arrays(self) -> list[bytes]:
        return [np.ascontiguousarray(x, dtype=t).tobytes() for x, t in zip(
            (self.tokens, self.n_words, self.grams, self.per_word, self.toxic, self.weight), self.TYPES, strict=True)]

    @classmethod
    def read(cls, arrays) -> Block:
        return cls(*(np.frombuffer(x, t) for x, t in zip(arrays, cls.TYPES, strict=True)))

    def gradient(self, line: np.ndarray, bias: float, sharp: float) -> tuple[np.ndarray, float]:
        """(by bucket, by bias) of the texts' summed weighted loss, where a
        word's number is the mean of ``line`` over its buckets."""
        word = segment_sum(line[self.grams], self.per_word) / self.per_word
        score = passage_scores(word[self.tokens], self.first, self.size)
        per_doc = self.per_doc
        attend = np.exp(sharp * (score - np.repeat(np.maximum.reduceat(score, np.cumsum(per_doc) - per_doc), per_doc)))
        attend /= np.repeat(segment_sum(attend, per_doc), per_doc)
        delta = (_sigmoid(segment_sum(attend * score, per_doc) + bias) - self.toxic) * self.weight
        up = np.repeat(delta, per_doc) * attend / self.size
        # from the passages that start and end at each occurrence
        n = len(self.tokens)
        on_token = np.cumsum(np.bincount(self.first, up, n + 1) - np.bincount(self.first + self.size, up, n + 1))[:n]
        on_word = np.bincount(self.tokens, on_token, len(word))
        on_bucket = np.bincount(self.grams, np.repeat(on_word / self.per_word, self.per_word), BUCKETS)
        return on_bucket, float(delta.sum())


def train(batches: list[list[Block]], seed: int = 11, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(number per bucket, bias): the log-odds of a passage is the bias plus
    the mean over its words of the mean of their buckets' numbers.  A step is
    one batch."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM))
    soft = rng.normal(0, 0.3, (DIM, 2))
    bias = np.zeros(2)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (embed, soft, bias)]
    step = 0
    for epoch in range(epochs):
        sharp = 0.0 if epoch < 2 else min(8.0, 0.5 * 2 ** ((epoch - 2) / 2))
        for turn in rng.permutation(len(batches)):
            line = soft[:, 1] - soft[:, 0]
            own = [block.gradient(embed @ line, float(bias[1] - bias[0]), sharp) for block in batches[turn]]
            weight = sum(block.weight.sum() for block in batches[turn])
            step += 1
            on_bucket, on_bias = sum(g for g, _ in own) / weight, sum(g for _, g in own) / weight
            bag = on_bucket @ embed
            grads = (on_bucket[:, None] * line[None, :], np.stack([-bag, bag], axis=1), np.array([-on_bias, on_bias]))
            for p, d, (m, v) in zip((embed, soft, bias), grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * d
                v *= 0.99
                v += 0.01 * d * d
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return embed @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0])


def sample_labels(labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, toxic, weight of about ``train_rows`` labels, at most half of
    them per class; never a held-out one."""
    own = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out("doc_id", *HELD_OUT))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {t: min(1.0, train_rows / 2 / n[t]) if n.get(t) else 1.0 for t in (0, 1)}
    kept = F.when(F.col("toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    return own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < kept * (1 << 30)).select(
        "doc_id", "toxic", (1.0 / kept).alias("weight"))


def _blocks(block_bytes: int):
    """Blocks of the sampled texts; rows come sorted by batch."""
    def block(batch, texts, toxic, weight):
        own = Block.of(pa.array(texts, pa.large_string()), toxic, weight)
        return pa.RecordBatch.from_arrays(
            [pa.array([batch], pa.int32()), pa.array([float(own.weight.sum())]), *(pa.array([x], pa.binary()) for x in own.arrays())],
            names=["batch", "total", *_ARRAYS])

    def run(batches):
        held, size, current = ([], [], []), 0, None
        for batch in batches:
            for number, *row in zip(*(batch.column(c).to_pylist() for c in ("batch", "text", "toxic", "weight")), strict=True):
                if held[0] and (number != current or size + len(row[0]) > block_bytes):
                    yield block(current, *held)
                    held, size = ([], [], []), 0
                current = number
                size += len(row[0])
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        if held[0]:
            yield block(current, *held)
    return run


_ARRAYS = ("tokens", "n_words", "grams", "per_word", "toxic", "weight")


def training_blocks(docs: DataFrame, sample: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """The sampled documents as blocks, a row each: batch, total weight, arrays."""
    own = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(sample), "doc_id")
    tie = F.xxhash64("text")
    # repeated doc_ids: the text of least hash; a row per sampled label
    least = written(own.groupBy("doc_id", "toxic").agg(F.min(F.struct(tie.alias("tie"), F.octet_length("text").alias("bytes"))).alias("l"))
                    .select("doc_id", "toxic", "l.tie", "l.bytes"), "training-texts")
    size = {r["toxic"]: r["b"] for r in least.groupBy("toxic").agg(F.sum("bytes").alias("b")).collect()}
    share = F.lit(1.0)
    for toxic, n in size.items():
        share = F.when(F.col("toxic") == toxic, min(1.0, train_bytes / 2 / max(n, 1))).otherwise(share)
    kept = least.withColumn("share", share).where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    own = own.drop("toxic").join(F.broadcast(kept.select(F.col("doc_id").alias("_id"), "toxic", "tie", "share")),
                                 (F.col("doc_id") == F.col("_id")) & (tie == F.col("tie"))).dropDuplicates(["doc_id"])
    dealt = own.select(F.pmod(F.xxhash64("text", "toxic"), F.lit(BATCHES)).cast("int").alias("batch"), "text", "toxic",
                       (F.col("weight") / F.col("share")).alias("weight"), "tie")
    dealt = dealt.repartition(BATCHES, "batch").sortWithinPartitions("batch", "tie")
    return map_batches(dealt.select("batch", "text", "toxic", "weight"), _blocks(BLOCK_BYTES),
                       "batch int, total double, " + ", ".join(f"{c} binary" for c in _ARRAYS))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The trained model; ``docs`` are joined with the sampled labels only."""
    sample = sample_labels(labels.select("doc_id", "toxic"), train_rows)
    blocks = training_blocks(docs, sample)  # the sample is bounded by train_rows: a broadcast

    def learn(rows):
        # rows come sorted: the blocks' order of arrival is Spark's
        by_batch: dict[int, list[tuple[bytes, Block]]] = {}
        for batch in rows:
            for number, *arrays in zip(*(batch.column(c) for c in ("batch", *_ARRAYS)), strict=True):
                raw = [x.as_py() for x in arrays]
                if raw[1]:
                    by_batch.setdefault(number.as_py(), []).append((raw[0][:64] + raw[1][:64], Block.read(raw)))
        batches = [[b for _, b in sorted(own, key=lambda x: x[0])] for _, own in sorted(by_batch.items())]
        toxic = np.concatenate([np.zeros(0), *(b.toxic for own in batches for b in own)])
        line, bias = np.zeros(BUCKETS), -500.0
        if len(toxic) and 0 < toxic.sum() < len(toxic):
            line, bias = train(batches)
        elif toxic.sum():
            bias = 500.0
        yield pa.RecordBatch.from_arrays([pa.array([line.tobytes()], pa.binary()), pa.array([bias])], names=["line", "bias"])

    model = map_batches(blocks.repartition(1), learn, "line binary, bias double").collect()
    if not model:
        return np.zeros(BUCKETS), -500.0
    return np.frombuffer(model[0]["line"]), model[0]["bias"]


def score_texts(column, model: tuple[np.ndarray, float]) -> np.ndarray:
    """P(toxic) of every text of an Arrow string column."""
    line, bias = model
    words = Words(column)
    best = np.zeros(words.n_docs)
    if len(words.start):
        _, where, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        each = []
        for _, portion in word_portions(words, where):
            grams, per_word = word_grams(words, portion)
            each.append(segment_sum(line[grams], per_word) / per_word)
        first, size, per_doc = passages(words.n_words)
        score = passage_scores(np.concatenate(each)[inverse], first, size)
        full = per_doc > 0
        best[full] = np.maximum.reduceat(score, (np.cumsum(per_doc) - per_doc)[full])
    return _sigmoid(best + bias)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, score (P(toxic)) and predicted (score >= 0.5)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                p = score_texts(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The rows of ``docs`` that score below 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(score_texts(part.column("text"), sent.value) < 0.5))
    return map_batches(docs, run, docs.schema)

"""Language-model scores by masked pseudo-likelihood.

A network predicts each word from the ``SIDE`` words before and after it:
embeddings side by side, a tanh layer, a softmax over ``CLASSES`` word classes
and one over the words of the class.  A document's score is the sum over its
words of log P(word | its neighbours).

The network's outputs are the ``TOP`` most frequent words of the corpus (equal
counts: lower hash first) and ``CLASSES**2 - TOP`` buckets, by hash, of all
others.  P(word | neighbours) of a word in a bucket is the network's P(bucket |
neighbours) times the word's share of the bucket's count, so every distinct
word has a probability of its own and they sum to one over the words.  Each
bucket keeps a count of ``REST`` for words that are not in the corpus.  Counts
come from all documents and also set the output biases, so training starts
from the corpus' word frequencies.  Scoring knows the counts of about ``HEAD``
words by heart and joins the other occurrences with the written counts.

Training is in numpy where the data lie: each round, every partition runs
Adam from the common parameters over the masked positions of all its
documents, and the partitions' parameters are averaged, weighted by their
targets.  A round masks one position in ``MASK`` and the next round the one
after it, so that in ``MASK`` rounds every position of every document is a
target once.  The texts are split into words twice, for the counts and for the
ids that training and scoring read; the ids lie in the shared folder.  What is gathered is a parameter
vector (about 0.8 MB) per partition and round and a count per distinct word
and partition, so it grows with the corpus; sums are streamed.  The result
depends slightly on how the input is split into partitions.

Defined cases: null, empty and wordless texts have no tokens, score 0 and a
null mean.  Repeated rows train and score like others; equal texts' scores are equal
but for float32 rounding.  Extra columns are
ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, written
from lodestar.llm.words import U64, Words, segment_sum, slices

SIDE = 2
DIM = 16
HIDDEN = 32
CLASSES = 64
TOP = 3072
HEAD = 1 << 16
REST = 0.5
MASK = 2
ROUNDS = MASK
BATCH = 4096
ROWS_AT_ONCE = 2048
SCORED_AT_ONCE = 1 << 15
STEPPED_AT_ONCE = 1 << 16
RATE = 0.01
PIECES = 16
VOCABULARY = CLASSES * CLASSES
PAD = VOCABULARY

#: the last row of ``classes`` and of every class's ``words`` is its bias
_SHAPES = {"embed": (VOCABULARY + 1, DIM), "hidden": (2 * SIDE * DIM, HIDDEN), "hidden_bias": (HIDDEN,),
           "classes": (HIDDEN + 1, CLASSES), "words": (CLASSES, HIDDEN + 1, CLASSES)}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The named parameters as views of one vector; ``*_and_bias`` are the
    weights with their bias as the last row."""
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    for name, bias in (("classes", "class_bias"), ("words", "word_bias")):
        both = out[f"{name}_and_bias"] = out[name]
        out[name], out[bias] = both[..., :-1, :], both[..., -1, :]
    return out


#: hashes are looked up from their first bits on
_FIRST = 18


@dataclass
class Model:
    head: np.ndarray  # sorted hashes of the most frequent words
    ids: np.ndarray  # their ids
    log_n: np.ndarray  # log of their counts; 0 for words with ids of their own
    log_total: np.ndarray  # per id: log of its bucket's count; 0 for the words with ids of their own
    flat: np.ndarray
    counts: DataFrame | None = None  # hash, n of every word; not sent to tasks

    @functools.cached_property
    def _first(self) -> np.ndarray:
        """Per value of the first ``_FIRST`` bits: the place in ``head`` of the first such hash."""
        return np.searchsorted(self.head, np.arange(1 << _FIRST, dtype=U64) << U64(64 - _FIRST))

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """Where in ``head`` each hash is, or would be (the last place at most)."""
        last = len(self.head) - 1
        at = np.minimum(self._first[(hashes >> U64(64 - _FIRST)).astype(np.int64)], last)
        late = np.flatnonzero(self.head[at] < hashes)
        while len(late):  # hashes are spread evenly: a few steps
            late = late[at[late] < last]
            at[late] += 1
            late = late[self.head[at[late]] < hashes[late]]
        return at

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, log P(word | id), whether in ``head``) of every word; for a
        word not in ``head`` the log of its count is still to be added."""
        ids = TOP + (hashes & U64(VOCABULARY - TOP - 1)).astype(np.int64)
        share, known = np.zeros(len(hashes)), np.zeros(len(hashes), dtype=bool)
        if len(self.head):
            at = self._place(hashes)
            known = self.head[at] == hashes
            ids[known] = self.ids[at[known]]
            share[known] = self.log_n[at[known]]
        return ids, share - self.log_total[ids], known

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        return self.look_up(hashes)[0]


#: float32 exponentials of logits within this neither overflow nor vanish
_SAFE = 60.0


def _bounded(p: dict[str, np.ndarray]) -> bool:
    """Whether no logit can leave -_SAFE .. _SAFE (the hidden layer is within -1 .. 1)."""
    return all(float(np.abs(p[w]).sum(axis=-2).max()) < _SAFE for w in ("classes_and_bias", "words_and_bias"))


def _exponentials(x: np.ndarray, bounded: bool, parts=((0, 0, None),)) -> tuple[np.ndarray, np.ndarray | float]:
    """Turns every row of ``x`` into exponentials; returns (their sum, what was
    taken from the row before).  The rows of each of ``parts`` are summed by a
    product of their own: the last bit of a sum depends on a row's place in it."""
    top = 0.0
    if not bounded:
        top = x.max(axis=1)
        x -= top[:, None]
    np.exp(x, out=x)
    ones, total = np.ones(x.shape[1], x.dtype), np.empty(len(x), x.dtype)
    for _, a, b in parts:
        np.matmul(x[a:b], ones, out=total[a:b])
    return total, top


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(an order of the targets by class, (class, first, end) of each)."""
    own = (targets // CLASSES).astype(np.uint8)
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(CLASSES + 1))
    return order, [(int(c), int(edges[c]), int(edges[c + 1])) for c in np.flatnonzero(np.diff(edges))]


def contexts(ids: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the neighbours of the words ``at``; PAD beyond their document
    (whose first and end positions are ``lo`` and ``hi``)."""
    out = np.empty((len(at), 2 * SIDE), dtype=np.int64)
    for j, offset in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        place = at + offset
        near = ids.take(place, mode="clip")
        near[place < lo if offset < 0 else place >= hi] = PAD
        out[:, j] = near
    return out


def _hidden(p: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(neighbours' embeddings side by side, hidden layer, hidden layer and a
    column of ones for the biases)."""
    x = p["embed"].take(context.ravel(), axis=0).reshape(len(context), -1)
    h = x @ p["hidden"]
    h += p["hidden_bias"]
    np.tanh(h, out=h)
    h1 = np.ones((len(h), HIDDEN + 1), h.dtype)
    h1[:, :-1] = h
    return x, h, h1


def log_probabilities(p: dict[str, np.ndarray], context: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """log P(target | context) of every row; ``ROWS_AT_ONCE`` rows are worked
    on at a time, those of a class side by side."""
    sort = np.argsort((targets // CLASSES).astype(np.uint8), kind="stable")
    bounded = _bounded(p)
    out = np.empty(len(targets))
    for first in range(0, len(targets), ROWS_AT_ONCE):
        own = sort[first:first + ROWS_AT_ONCE]
        to, rows = targets[own], np.arange(len(own))
        h1 = _hidden(p, context[own])[2]
        logits = h1 @ p["classes_and_bias"]
        total = logits[rows, to // CLASSES].astype(np.float64)
        each, top = _exponentials(logits, bounded)
        total -= top + np.log(each)
        for c, a, b in _by_class(to)[1]:
            np.matmul(h1[a:b], p["words_and_bias"][c], out=logits[a:b])
        total += logits[rows, to % CLASSES]
        each, top = _exponentials(logits, bounded)
        total -= top + np.log(each)
        out[own] = total
    return out


def gradient(p: dict[str, np.ndarray], g: dict[str, np.ndarray], context: np.ndarray, targets: np.ndarray) -> None:
    """Puts the gradient of the mean negative log-probability into ``g``.  The
    rows of a class lie side by side and only its products are by class."""
    n = len(targets)
    order, classes = _by_class(targets)
    context, targets, rows = context[order], targets[order], np.arange(n)
    bounded = _bounded(p)
    x, h, h1 = _hidden(p, context)
    d = h1 @ p["classes_and_bias"]
    d /= (_exponentials(d, bounded)[0] * np.float32(n))[:, None]
    d[rows, targets // CLASSES] -= np.float32(1 / n)
    np.matmul(h.T, d, out=g["classes"])
    np.add.reduce(d, axis=0, out=g["class_bias"])
    dh = d @ p["classes"].T
    for c, a, b in classes:
        np.matmul(h1[a:b], p["words_and_bias"][c], out=d[a:b])
    d /= (_exponentials(d, bounded, classes)[0] * np.float32(n))[:, None]
    d[rows, targets % CLASSES] -= np.float32(1 / n)
    g["words_and_bias"][:] = 0
    more = np.empty_like(dh)
    for c, a, b in classes:
        np.matmul(h[a:b].T, d[a:b], out=g["words"][c])
        np.add.reduce(d[a:b], axis=0, out=g["word_bias"][c])
        np.matmul(d[a:b], p["words"][c].T, out=more[a:b])
    dh += more
    h *= h
    np.subtract(1, h, out=h)
    dh *= h
    np.matmul(x.T, dh, out=g["hidden"])
    np.add.reduce(dh, axis=0, out=g["hidden_bias"])
    dx = (p["hidden"] @ dh.T).reshape(2 * SIDE, DIM, n)
    near = context.T.ravel()
    sums = np.empty((DIM, len(p["embed"])), h.dtype)
    for j in range(DIM):
        sums[j] = np.bincount(near, dx[:, j].ravel(), len(p["embed"]))
    g["embed"][:] = sums.T


class Trainer:
    """Adam over a stream of (contexts, targets)."""

    def __init__(self, flat: np.ndarray, batch: int = BATCH, rate: float = RATE):
        self.batch, self.rate = batch, rate
        self.flat = flat.astype(np.float32).copy()
        self.mean = np.zeros(SIZE, np.float32)
        self.square = np.zeros(SIZE, np.float32)
        self.grad = np.zeros(SIZE, np.float32)
        self.at, self.towards = views(self.flat), views(self.grad)
        self.step = self.seen = 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, context: np.ndarray, targets: np.ndarray) -> None:
        self.held.append((context, targets))
        self.waiting += len(targets)
        if self.waiting >= self.batch:
            self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        context = np.concatenate([c for c, _ in self.held])
        targets = np.concatenate([t for _, t in self.held])
        self.held, self.waiting = [], 0
        for start in range(0, len(targets), self.batch):
            part = slice(start, start + self.batch)
            gradient(self.at, self.towards, context[part], targets[part])
            self.step += 1
            rate = self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
            for first in range(0, SIZE, STEPPED_AT_ONCE):
                own = slice(first, first + STEPPED_AT_ONCE)
                grad, mean, square, flat = self.grad[own], self.mean[own], self.square[own], self.flat[own]
                mean *= np.float32(0.9)
                square *= np.float32(0.99)
                square += np.float32(0.01) * (grad * grad)
                grad *= np.float32(0.1)
                mean += grad
                np.sqrt(square, out=grad)
                grad += np.float32(1e-8)
                np.divide(mean, grad, out=grad)
                grad *= np.float32(rate)
                flat -= grad
        self.seen += len(targets)


def _masked(n_words: np.ndarray, turn: int, mask: int = MASK) -> np.ndarray:
    """One position in ``mask`` of every document of ``n_words`` words, back to
    back; each of ``mask`` turns has others."""
    place = np.arange(int(n_words.sum())) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    return np.flatnonzero((place + turn) % mask == 0)


def vocabulary(docs: DataFrame) -> Model:
    """Ids of the most frequent words and parameters that give the corpus'
    word frequencies."""
    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            hashes = np.concatenate([h for h, _ in held])
            own, inverse = np.unique(hashes, return_inverse=True)
            return own, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            for part in slices(batch, "text"):
                held.append(np.unique(Words(part.column("text")).hash, return_counts=True))
                size += len(held[-1][0])
                if size > 2_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_000_000:  # bounded memory: the shuffle adds up the rest
                        yield rows(*held[0])
                        held, size = [], 0
        if held:
            yield rows(*merged())

    def rows(hashes, n):
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])

    counts = written(map_batches(docs.select("text"), count, "hash long, n long")
                     .groupBy("hash").agg(F.sum("n").alias("n")), "word-counts")
    top = counts.orderBy(F.desc("n"), "hash").limit(TOP).collect()
    buckets = counts.groupBy(F.col("hash").bitwiseAND(F.lit(VOCABULARY - TOP - 1)).alias("b")).agg(
        F.sum("n").alias("n")).collect()
    mass = np.full(VOCABULARY, REST)
    for r in buckets:
        mass[TOP + r["b"]] += r["n"]
    own = np.array([r["hash"] for r in top], dtype=np.int64).view(U64)
    for i, r in enumerate(top):
        mass[i] += r["n"]
        mass[TOP + int(own[i] & U64(VOCABULARY - TOP - 1))] -= r["n"]
    log_total = np.log(mass)
    log_total[:TOP] = 0
    # the next words by whole steps of frequency, as many as HEAD allows
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    least, room = 1 << 20, HEAD
    for r in sorted(steps, key=lambda r: -r["step"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    more = counts.where(step >= least).collect()
    more_hash = np.array([r["hash"] for r in more], dtype=np.int64).view(U64)
    fresh = ~np.isin(more_hash, own)
    hashes = np.concatenate([own, more_hash[fresh]])
    log_n = np.concatenate([np.zeros(len(own)), np.log(np.array([r["n"] for r in more], dtype=float)[fresh])])
    ids = np.concatenate([np.arange(len(own)),
                          TOP + (more_hash[fresh] & U64(VOCABULARY - TOP - 1)).astype(np.int64)])
    order = np.argsort(hashes)
    rng = np.random.default_rng(3)
    flat = np.zeros(SIZE, np.float32)
    p = views(flat)
    for name in ("embed", "hidden", "classes", "words"):
        p[name][:] = rng.normal(0, 0.1, p[name].shape)
    by_class = mass.reshape(CLASSES, CLASSES)
    p["class_bias"][:] = np.log(by_class.sum(axis=1) / mass.sum())
    p["word_bias"][:] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
    return Model(hashes[order], ids[order], log_n[order], log_total, flat, counts)


def coded(docs: DataFrame, model: Model) -> DataFrame:
    """Every document as ids, so that training and scoring read no text: row,
    doc_id, n_tokens, ids (16-bit, back to back), share (summed log P(word |
    id)), and the words not in ``head`` with how often each occurs."""
    sent = docs.sparkSession.sparkContext.broadcast(replace(model, counts=None))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                words = Words(part.column("text"))
                ids, share, known = sent.value.look_up(words.hash)
                doc = words.doc_of_word()[~known]
                order = np.lexsort((words.hash[~known], doc))
                doc, rare = doc[order], words.hash[~known][order]
                fresh = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])])[:len(doc)])
                times = np.diff(np.append(fresh, len(doc)))
                edges = np.searchsorted(doc[fresh], np.arange(words.n_docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.n_words, pa.int64()),
                     pa.array([x.tobytes() for x in np.split(ids.astype("<u2"), words.hi[:-1])], pa.binary()),
                     pa.array(segment_sum(share, words.n_words)),
                     pa.ListArray.from_arrays(edges, rare[fresh].view(np.int64)),
                     pa.ListArray.from_arrays(edges, times)],
                    names=["doc_id", "n_tokens", "ids", "share", "rare", "times"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    # doc_id may be null or repeated: the rows are numbered as they are written
    return written(map_batches(docs.select("doc_id", "text"), run,
                               f"doc_id {kind}, n_tokens long, ids binary, share double, rare array<long>, times array<long>")
                   .withColumn("row", F.monotonically_increasing_id()), "coded-words")


def _blocks(batch: pa.RecordBatch):
    """(first row, words per document, ids) of at most about ``SCORED_AT_ONCE``
    words, one document at least."""
    n_all = batch.column("n_tokens").to_numpy()
    ends = np.cumsum(n_all)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SCORED_AT_ONCE, side="right"))
        last = min(max(last, first + 1), batch.num_rows)
        ids = np.frombuffer(b"".join(batch.column("ids").slice(first, last - first).to_pylist()), "<u2").astype(np.int64)
        yield first, n_all[first:last], ids
        first = last


def train(texts: DataFrame, model: Model, rounds: int = ROUNDS, mask: int = MASK, batch: int = BATCH, rate: float = RATE) -> Model:
    """``model`` with parameters trained on all of ``texts`` (from :func:`coded`)."""
    batch_size = batch
    spark = texts.sparkSession
    cuts = np.linspace(0, SIZE, PIECES + 1).astype(int)
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(model.flat)

        def learn(batches, sent=sent, turn=turn):
            trainer = Trainer(sent.value, batch_size, rate)
            for batch in batches:
                for _, n, ids in _blocks(batch):
                    at = _masked(n, turn, mask)
                    if not len(at):
                        continue
                    end = np.cumsum(n)
                    doc = np.repeat(np.arange(len(n)), n)[at]
                    trainer.add(contexts(ids, (end - n)[doc], end[doc], at), ids[at])
            trainer.flush()
            if trainer.seen:
                share = trainer.flat.astype(np.float64) * trainer.seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(PIECES, dtype=np.int32)), pa.array([trainer.seen] * PIECES, pa.int64()),
                     pa.array([share[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=["piece", "seen", "share"])

        def total(batches):
            sums: dict[int, list] = {}
            for batch in batches:
                for piece, seen, share in zip(*(batch.column(c).to_pylist() for c in ("piece", "seen", "share")), strict=True):
                    own = sums.setdefault(piece, [0, 0.0])
                    own[0] += seen
                    own[1] = own[1] + np.frombuffer(share)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s for s, _ in sums.values()], pa.int64()),
                 pa.array([(v / s).astype(np.float32).tobytes() for s, v in sums.values()], pa.binary())],
                names=["piece", "seen", "share"])

        schema = "piece int, seen long, share binary"
        shares = map_batches(texts.select("n_tokens", "ids"), learn, schema)
        means = map_batches(shares.repartition(PIECES, "piece"), total, schema).collect()
        if not means:
            break
        flat = np.concatenate([np.frombuffer(r["share"], np.float32) for r in sorted(means, key=lambda r: r["piece"])])
        model = replace(model, flat=flat)
    return model


def fit(docs: DataFrame, **how) -> Model:
    """Vocabulary and parameters from all of ``docs`` (doc_id, text)."""
    model = vocabulary(docs)
    return train(coded(docs, model), model, **how)


def score_ids(ids: np.ndarray, n_words: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """log P(id | neighbours) of every position of documents back to back."""
    end = np.cumsum(n_words)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    out = np.empty(len(ids))
    for first in range(0, len(ids), SCORED_AT_ONCE):
        at = np.arange(first, min(first + SCORED_AT_ONCE, len(ids)))
        own = doc[at]
        out[at] = log_probabilities(p, contexts(ids, (end - n_words)[own], end[own], at), ids[at])
    return out


def score_coded(texts: DataFrame, model: Model) -> DataFrame:
    """:func:`score` of documents from :func:`coded`."""
    sent = texts.sparkSession.sparkContext.broadcast(model.flat)

    def run(batches):
        p = views(sent.value)
        for batch in batches:
            for first, n, ids in _blocks(batch):
                part = batch.slice(first, len(n))
                total = segment_sum(score_ids(ids, n, p), n) + part.column("share").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("n_tokens"), pa.array(total)],
                    names=["row", "doc_id", "n_tokens", "log_prob"])
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = map_batches(texts.select("row", "doc_id", "n_tokens", "ids", "share"), run,
                         f"row long, doc_id {kind}, n_tokens long, log_prob double")
    log_n = F.log(F.coalesce(F.col("n").cast("double"), F.lit(REST)))
    # a document's rare words are grouped: a row per word and document
    rare = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("hash"), F.col("w.times").alias("times"))
    rare = rare.join(model.counts, "hash", "left").groupBy("row").agg(F.sum(F.col("times") * log_n).alias("rare"))
    total = F.col("log_prob") + F.coalesce("rare", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_prob"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_prob (summed) and mean_log_prob of every text.
    All words not in the corpus that was fitted score as one per bucket."""
    return score_coded(coded(docs, model), model)


def scored_corpus(docs: DataFrame) -> DataFrame:
    """Scores of ``docs`` under a model of themselves; their texts are split
    into words twice, for the counts and for the ids."""
    start = vocabulary(docs)
    texts = coded(docs, start)
    return score_coded(texts, train(texts, start))

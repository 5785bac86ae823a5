"""Language identification as a mixture of languages per document.

Each language is a smoothed distribution over hashed byte ``GRAM``-grams of
marked words (``<word>``), counted over all training documents in Spark.  A
word's likelihood under a language is the product of its n-grams', tempered
by 1/``GRAM`` because neighbouring n-grams overlap.  Expectation-maximisation
over a document's words estimates its language proportions.  The language
set is chosen by penalised likelihood: the ``s`` strongest languages are
fitted for s = 1, 2, ... and the best of ``loglik - s * PENALTY * log(words +
1)`` wins.  A larger set is fitted only if all languages together may gain more
than one penalty, since no smaller set can gain more than they do; what they
may gain is their log-likelihood after ``ROUNDS`` rounds and a bound of what
further rounds could add.  Sets are fitted to within ``TOLERANCE``.

The prediction is the language of the largest proportion, the score that
proportion.  Ties go to the alphabetically first language.

Counting partially aggregates before its shuffle (languages x ``BUCKETS``
rows at most per task); the model on the driver and in the tasks has that
size too.  Prediction is one narrow pass.

Defined cases: null, empty and letterless texts are ``und`` with score 0;
texts with letters always get a language.  Rows with null lang do not train;
without any training row everything is ``und``.  Extra columns are ignored
(``identify``) or passed through (``drop_unidentified``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import is_held_out, map_batches
from lodestar.llm.words import U64, Words, mix, segment_sum, slices, utf8_column, word_portions

GRAM = 4
BUCKETS = 1 << 15
SMOOTHING = 0.1
PENALTY = 2.0
ROUNDS = 12
FIT_ROUNDS = 200
#: a set's log-likelihood is fitted to within this
TOLERANCE = 0.05
HELD_OUT = (4, 2)
MIN_SHARE = 0.5
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_LETTER = re.compile(r"[^\W\d_]")


def marked_grams(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every byte n-gram of ``<word>``, number per word) of the words
    ``which``; a word shorter than the n-gram is one n-gram."""
    start = words.start[which]
    n = words.end[which] - start
    size = np.maximum(n + 2, GRAM)
    begin = np.cumsum(size) - size
    total = int(size.sum())
    text = np.full(total + GRAM, 1, dtype=np.uint8)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    text[np.repeat(begin + 1, n) + inside] = words.data[np.repeat(start, n) + inside]
    rolled = text[:total].astype(U64)
    for k in range(1, GRAM):
        rolled = rolled * U64(0x100000001B3) + text[k:total + k]
    counts = size - GRAM + 1
    at = np.repeat(begin, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return (mix(rolled[at]) & U64(BUCKETS - 1)).astype(np.int32), counts


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages, tempered


def fit(docs: DataFrame) -> Model:
    """Counts n-grams per language over the documents (text, lang, doc_id)
    that are not held out."""
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out("doc_id", *HELD_OUT))

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                for name in sorted(set(langs.tolist())):
                    own = np.flatnonzero(np.repeat(langs == name, words.n_words))
                    # every distinct word is cut once
                    _, where, times = np.unique(words.hash[own], return_index=True, return_counts=True)
                    c = totals.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                    for at, portion in word_portions(words, own[where]):
                        grams, per_word = marked_grams(words, portion)
                        c += np.bincount(grams, np.repeat(times[at], per_word), BUCKETS).astype(np.int64)
        for name, c in totals.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                names=["lang", "bucket", "n"])

    rows = (map_batches(train.select("lang", "text"), count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))  # <= BUCKETS
            .orderBy("lang").collect())
    counts = np.zeros((BUCKETS, len(rows)))
    for j, r in enumerate(rows):
        counts[np.array(r["b"]), j] = r["n"]
    if not rows:
        return Model([], counts)
    # mixed with what all languages share, so rare n-grams stay comparable
    shared = (counts.sum(axis=1) + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS)
    p = (counts + SMOOTHING * BUCKETS * shared[:, None]) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model([r["lang"] for r in rows], np.log(p) / GRAM)


def _mixture(like: np.ndarray, times: np.ndarray, units: np.ndarray, allowed: np.ndarray, rounds: int,
             tolerance: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM per document over the likelihoods of its ``units`` distinct words
    (words x languages), each standing ``times`` times, with proportions kept at
    0 outside ``allowed`` (documents x languages).

    Returns the proportions, the log-likelihood and how much more any
    proportions could reach: the log-likelihood is concave in them, so it can
    gain at most the greatest of its slopes towards one language alone.  A
    document is done when that is within ``tolerance``."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    n_words = segment_sum(times, units)
    value, gap = np.zeros(len(units)), np.full(len(units), np.inf)
    todo = np.arange(len(units))
    owner = np.repeat(np.arange(len(units)), units)
    for turn in range(rounds + 1):
        total = (like * np.repeat(share[todo], units[todo], axis=0)).sum(axis=1)
        value[todo] = segment_sum(times * np.log(total), units[todo])
        slope = segment_sum(like * (times / total)[:, None], units[todo])
        gap[todo] = np.maximum(np.where(allowed[todo] > 0, slope, 0).max(axis=1) - n_words[todo], 0)
        going = gap[todo] > tolerance
        if turn == rounds or not going.any():
            break
        share[todo[going]] *= slope[going] / n_words[todo[going], None]
        if not going.all():
            todo = todo[going]
            own = np.isin(owner, todo)
            like, times, owner = like[own], times[own], owner[own]
    return share, value, gap


def proportions(words: Words, model: Model) -> np.ndarray:
    """Language proportions (documents x languages); 0 for wordless texts."""
    out = np.zeros((words.n_docs, len(model.languages)))
    docs = np.flatnonzero(words.n_words)
    if not len(docs):
        return out
    n_words = words.n_words[docs]
    distinct, where, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    each = []
    for _, portion in word_portions(words, where):
        grams, counts = marked_grams(words, portion)
        each.append(segment_sum(model.log_p[grams], counts))
    # a document's distinct words and how often each stands in it
    keys, times = np.unique(np.repeat(np.arange(len(docs)), n_words) * len(distinct) + inverse, return_counts=True)
    owner = keys // len(distinct)
    units = np.bincount(owner, minlength=len(docs))
    log_like = np.concatenate(each)[keys % len(distinct)]
    top = log_like.max(axis=1, keepdims=True)
    like = np.exp(log_like - top)
    n_langs = like.shape[1]
    share, full, more_yet = _mixture(like, times, units, np.ones((len(docs), n_langs)), ROUNDS)
    rank = np.argsort(-share, axis=1, kind="stable")
    # one language: every word under it
    alone = segment_sum((log_like - top) * times[:, None], units)
    first = alone.argmax(axis=1)
    best = np.zeros_like(share)
    best[np.arange(len(docs)), first] = 1.0
    penalty = PENALTY * np.log(n_words + 1.0)
    value = alone[np.arange(len(docs)), first] - penalty
    # no set can gain more than all languages at their best
    more = np.flatnonzero(full + more_yet - 2 * penalty > value)
    chosen = np.isin(owner, more)
    for s in range(2, n_langs + 1):
        if not len(more):
            break
        allowed = np.zeros((len(more), n_langs))
        np.put_along_axis(allowed, rank[more, :s], 1.0, axis=1)
        fit_share, fit_value, _ = _mixture(like[chosen], times[chosen], units[more], allowed, FIT_ROUNDS, TOLERANCE)
        fit_value = fit_value - s * penalty[more]
        better = fit_value > value[more]
        best[more[better]], value[more[better]] = fit_share[better], fit_value[better]
    out[docs] = best
    return out


def has_letter(column) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    raw, offsets = utf8_column(column)
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for d in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        text = raw[offsets[d]:offsets[d + 1]].tobytes().decode("utf-8", "replace")
        # the pattern also finds signs of numbers, which are no letters
        found[d] = any(m.group().isalpha() for m in _LETTER.finditer(text))
    return found


def predict(column, model: Model) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text of an Arrow string column."""
    letters = has_letter(column)
    if not model.languages:
        return ["und"] * len(letters), np.zeros(len(letters))
    share = proportions(Words(column), model)
    pick = share.argmax(axis=1)
    score = np.where(letters, share[np.arange(len(pick)), pick], 0.0)
    return [model.languages[p] if ok else "und" for p, ok in zip(pick, letters, strict=True)], np.clip(score, 0, 1)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                lang, score = predict(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: Model, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` in which one language has ``min_share`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                lang, score = predict(part.column("text"), sent.value)
                ok = (np.array(lang, dtype=object) != "und") & (score >= min_share)
                yield part.filter(pa.array(ok.astype(bool)))
    return map_batches(docs, run, docs.schema)

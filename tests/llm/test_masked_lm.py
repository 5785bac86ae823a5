import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import masked_lm as lm
from lodestar.llm.queries import QUERIES
from lodestar.llm.words import Words


def sentences(n, seed):
    """Word pairs that predict each other: a0 b0, a1 b1, ..."""
    rnd = random.Random(seed)
    return [" ".join(f"a{k} b{k} c" for k in (rnd.randrange(30) for _ in range(rnd.choice([3, 20, 60])))) for _ in range(n)]


def score_words(words, model):
    ids, share, _ = model.look_up(words.hash)
    return lm.score_ids(ids, words.n_words, lm.views(model.flat)) + share


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    flat = rng.normal(0, 0.1, lm.SIZE)
    context = rng.integers(0, lm.PAD + 1, (20, 2 * lm.SIDE))
    targets = rng.integers(0, lm.VOCABULARY, 20)
    grad = np.zeros(lm.SIZE)
    lm.gradient(lm.views(flat), lm.views(grad), context, targets)
    for k in rng.choice(np.flatnonzero(np.abs(grad) > 1e-5), 25):
        value = []
        for step in (1e-5, -1e-5):
            moved = flat.copy()
            moved[k] += step
            value.append(-lm.log_probabilities(lm.views(moved), context, targets).mean())
        assert grad[k] == pytest.approx((value[0] - value[1]) / 2e-5, rel=1e-3, abs=1e-8)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    p = lm.views(rng.normal(0, 0.3, lm.SIZE))
    context = np.repeat(rng.integers(0, lm.PAD + 1, (1, 2 * lm.SIDE)), lm.VOCABULARY, axis=0)
    assert np.exp(lm.log_probabilities(p, context, np.arange(lm.VOCABULARY))).sum() == pytest.approx(1)


def test_both_sides_are_seen():
    ids = np.arange(10, 16)
    lo, hi = np.array([0, 0, 0, 3, 3, 3]), np.array([3, 3, 3, 6, 6, 6])
    got = lm.contexts(ids, lo, hi, np.arange(6))
    pad = lm.PAD
    assert got.tolist() == [[pad, pad, 11, 12], [pad, 10, 12, pad], [10, 11, pad, pad],
                            [pad, pad, 14, 15], [pad, 13, 15, pad], [13, 14, pad, pad]]


def test_counts_cover_all_documents_and_training_learns_pairs(spark):
    texts = sentences(1500, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    start = lm.vocabulary(docs)
    counts = collections.Counter(w for t in texts for w in t.split())
    word = {w: int(Words(pa.array([w])).hash[0]) for w in counts}
    rank = {w: int(start.word_ids(np.array([word[w]], np.uint64))[0]) for w in counts}
    assert sorted(rank.values()) == list(range(len(counts)))
    assert [c for _, c in sorted((rank[w], n) for w, n in counts.items())] == sorted(counts.values(), reverse=True)

    model = lm.fit(docs, rounds=4, mask=2, batch=256, rate=0.01)
    held = Words(pa.array(sentences(50, 9)))
    rnd = random.Random(3)
    shuffled = Words(pa.array([" ".join(rnd.sample(t.split(), len(t.split()))) for t in sentences(50, 9)]))
    before, after = score_words(held, start).mean(), score_words(held, model).mean()
    assert after > before + 1.0
    assert after > score_words(shuffled, model).mean() + 1.0


def test_every_position_is_a_target_once():
    texts = ["one", "one two", "", "a b c d e f g h i j k", "a b c d e f g h i j k", "x " * 1000]
    words = Words(pa.array(texts))
    targets = np.concatenate([lm._masked(words.n_words, turn) for turn in range(lm.ROUNDS)])
    assert sorted(targets) == list(range(len(words.hash)))


def test_production_parameters_learn_pairs(spark):
    docs = spark.createDataFrame(list(enumerate(sentences(8_000, 1))), "doc_id long, text string").repartition(2)
    start, model = lm.vocabulary(docs), lm.fit(docs)
    held = Words(pa.array(sentences(50, 9)))
    rnd = random.Random(3)
    shuffled = Words(pa.array([" ".join(rnd.sample(t.split(), len(t.split()))) for t in sentences(50, 9)]))
    before, after = score_words(held, start).mean(), score_words(held, model).mean()
    assert after > before + 1.0
    assert after > score_words(shuffled, model).mean() + 1.0


def test_every_word_has_its_own_probability(spark, small):
    """One-word texts of 80,000 words: their probabilities (between the same
    neighbours, none) sum to one, and follow the counts."""
    n = 80_000
    count = [1 + n // (4 * (i + 1)) for i in range(n)]
    texts = [" ".join([f"w{i}"] * count[i]) for i in range(n)]
    docs = spark.read.parquet(small(documents={"doc_id": list(range(n)), "text": texts}) + "/documents.parquet")
    asked = spark.read.parquet(small(documents={
        "doc_id": [*range(n), -1], "text": [*(f"w{i}" for i in range(n)), "garbage"]}) + "/documents.parquet")
    for model, near in ((lm.vocabulary(docs), 0.35), (lm.fit(docs), None)):
        got = {r["doc_id"]: r["log_prob"] for r in lm.score(asked, model).collect()}
        unseen = got.pop(-1)
        assert np.exp(list(got.values())).sum() == pytest.approx(1, abs=0.01)
        ids = model.word_ids(Words(pa.array([*(f"w{i}" for i in range(n)), "garbage"])).hash)
        assert unseen < min(got[i] for i in np.flatnonzero(ids[:n] == ids[n]))
        for i in (0, 299, 4999, 9999, n - 1) if near else ():
            assert np.exp(got[i]) * sum(count) == pytest.approx(count[i], rel=near)


def test_query_sums_and_edges(spark, small):
    texts = [*sentences(40, 4), None, "", "%%%", "one", "again and again " * 20000, "one"]
    t = pa.table({"doc_id": pa.array([*range(len(texts) - 1), None], pa.int64()), "text": pa.array(texts),
                  "hash": pa.array(["h"] * len(texts)), "n": pa.array([1] * len(texts))})
    got = QUERIES["op6_masked_lm_scoring"](spark, small(documents=t)).collect()
    assert len(got) == len(texts)
    by = {r["doc_id"]: r for r in got}
    for i in (40, 41, 42):
        assert (by[i]["n_tokens"], by[i]["log_prob"], by[i]["mean_log_prob"]) == (0, 0.0, None)
    assert by[43]["log_prob"] == pytest.approx(by[None]["log_prob"], rel=1e-6) and by[43]["log_prob"] < 0
    assert by[44]["n_tokens"] == 60000
    assert all(r["mean_log_prob"] == pytest.approx(r["log_prob"] / r["n_tokens"]) for r in got if r["n_tokens"])
    assert QUERIES["op6_masked_lm_scoring"](spark, small(documents=t.slice(0, 0))).collect() == []


def test_scores_are_the_summed_log_probabilities(spark):
    """The query's sums, recomputed word by word with plain loops."""
    texts = [*sentences(30, 8), "one two three", "a0", None, "a0 zz a0 zz zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.fit(docs)
    p = lm.views(model.flat)
    counts = collections.Counter(w for t in texts for w in (t or "").split())
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    got = {r["doc_id"]: r["log_prob"] for r in lm.score(docs, model).collect()}
    for d in (0, 7, 30, 31, 33):
        words = texts[d].split()
        ids = [int(i) for i in model.word_ids(Words(pa.array([texts[d]])).hash)]
        total = 0.0
        for k, (w, i) in enumerate(zip(words, ids, strict=True)):
            near = [ids[k + o] if 0 <= k + o < len(ids) else lm.PAD for o in (-2, -1, 1, 2)]
            h = np.tanh(np.concatenate([p["embed"][x] for x in near]) @ p["hidden"] + p["hidden_bias"])
            c, inside = divmod(i, lm.CLASSES)
            total += np.log(softmax(h @ p["classes"] + p["class_bias"])[c])
            total += np.log(softmax(h @ p["words"][c] + p["word_bias"][c])[inside])
            if i >= lm.TOP:
                bucket = [v for x, v in counts.items() if model.word_ids(Words(pa.array([x])).hash)[0] == i]
                total += np.log(counts[w] / (sum(bucket) + lm.REST))
        assert got[d] == pytest.approx(total, rel=1e-4)


def test_a_softmax_is_taken_over_the_rows_of_all_classes_at_once(monkeypatch):
    """Not class by class (65 times a step, mostly of a few rows)."""
    sizes, one = [], lm._exponentials
    monkeypatch.setattr(lm, "_exponentials", lambda x, *how: sizes.append(len(x)) or one(x, *how))
    rng = np.random.default_rng(4)
    p = lm.views(rng.normal(0, 0.1, lm.SIZE).astype(np.float32))
    context, targets = rng.integers(0, lm.PAD + 1, (1000, 2 * lm.SIDE)), rng.integers(0, lm.VOCABULARY, 1000)
    lm.gradient(p, lm.views(np.zeros(lm.SIZE, np.float32)), context, targets)
    assert sizes == [1000, 1000]
    whole = lm.log_probabilities(p, context, targets)
    assert sizes == [1000] * 4
    monkeypatch.setattr(lm, "ROWS_AT_ONCE", 7)
    assert lm.log_probabilities(p, context, targets) == pytest.approx(whole, rel=1e-5)


def test_gradient_leaves_nothing_of_an_earlier_one():
    rng = np.random.default_rng(5)
    p = lm.views(rng.normal(0, 0.1, lm.SIZE))
    context, targets = rng.integers(0, lm.PAD + 1, (9, 2 * lm.SIDE)), rng.integers(0, lm.VOCABULARY, 9)
    fresh, used = np.zeros(lm.SIZE), np.full(lm.SIZE, 7.0)
    for grad in (fresh, used):
        lm.gradient(p, lm.views(grad), context, targets)
    assert np.array_equal(fresh, used)


def test_steps_are_those_of_adam():
    rng = np.random.default_rng(6)
    flat = rng.normal(0, 0.1, lm.SIZE).astype(np.float32)
    context, targets = rng.integers(0, lm.PAD + 1, (90, 2 * lm.SIDE)), rng.integers(0, lm.VOCABULARY, 90)
    trainer = lm.Trainer(flat, batch=40)
    trainer.add(context, targets)
    assert trainer.seen == 90
    plain, mean, square = flat.astype(float), 0.0, 0.0
    for step, part in enumerate((slice(0, 40), slice(40, 80), slice(80, 90)), 1):
        grad = np.zeros(lm.SIZE)
        lm.gradient(lm.views(plain), lm.views(grad), context[part], targets[part])
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        plain -= lm.RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * mean / (np.sqrt(square) + 1e-8)
    sure = square > 1e-12  # elsewhere float32's rounding decides
    assert sure.sum() > 10_000
    assert trainer.flat[sure] == pytest.approx(plain[sure], abs=1e-4)


def test_words_are_found_among_crowded_hashes():
    rng = np.random.default_rng(7)
    spread = rng.integers(0, 1 << 62, 3000, dtype=np.uint64) << np.uint64(2)
    crowd = np.uint64(1 << 63) + np.arange(0, 2000, 2, dtype=np.uint64)
    edges = np.array([0, 2**64 - 1], np.uint64)
    for head in (np.unique(np.concatenate([spread, crowd])), np.unique(np.concatenate([spread, crowd, edges])), crowd, spread[:1]):
        model = lm.Model(head, np.arange(len(head)) % lm.TOP, np.zeros(len(head)), np.zeros(lm.VOCABULARY), np.zeros(0))
        asked = np.concatenate([spread, crowd, crowd + np.uint64(1), edges, rng.integers(0, 1 << 63, 999, dtype=np.uint64)])
        ids, _, known = model.look_up(asked)
        assert np.array_equal(known, np.isin(asked, head))
        assert np.array_equal(ids[known], np.searchsorted(head, asked[known]) % lm.TOP)

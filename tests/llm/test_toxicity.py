import binascii
import random

import numpy as np
import pyarrow as pa

from lodestar.llm import toxicity
from lodestar.llm.queries import QUERIES
from lodestar.llm.words import Words, segment_sum

CLEAN = [f"{a}{b}" for a in "ba co du fe gi lo mu".split() for b in "nda rest lin tor mat pel".split()]


def held_out(i):
    return binascii.crc32(str(i).encode()) % 5 == 0


def corpus(n=600, seed=4):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(CLEAN) for _ in range(rnd.choice([6, 40, 200]))]
        toxic = int(rnd.random() < 0.3)
        if toxic:  # a stem under changing endings, so held-out spellings are new
            for _ in range(rnd.choice([1, 2])):
                words[rnd.randrange(len(words))] = "vilewort" + "".join(rnd.choice("aeioxyz") for _ in range(3))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def folder(small, docs, labels):
    return small(documents=pa.table({"doc_id": pa.array([d[0] for d in docs], pa.int64()),
                                     "text": pa.array([d[1] for d in docs], pa.string()),
                                     "toxic": pa.array([1] * len(docs)), "weight": pa.array(["w"] * len(docs))}),
                 labels=pa.table({"doc_id": pa.array([d[0] for d in labels], pa.int64()),
                                  "toxic": pa.array([d[1] for d in labels], pa.int32()),
                                  "text": pa.array(["no"] * len(labels))}))


def test_unseen_spellings_in_held_out_documents(spark, small):
    docs, labels = corpus()
    truth = dict(labels)
    labels += [(0, None), (7, 9), (9999, 1), (None, 1), labels[3]]
    extra = [(5000, None), (5001, ""), (5002, "%%% !!"), (5003, ("banda " * 30000) + "vileworty"), (None, "banda"),
             docs[1]]
    got = QUERIES["op9_subword_toxicity"](spark, folder(small, docs + extra, labels)).collect()
    assert len(got) == len(docs) + len(extra)
    by = {r["doc_id"]: r for r in got}
    own = [i for i in truth if held_out(i)]
    assert all(by[i]["held_out"] == held_out(i) for i in truth)
    assert np.mean([by[i]["predicted"] == truth[i] for i in own]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert by[5000]["score"] == by[5001]["score"] == by[5002]["score"]
    assert by[5003]["predicted"] == 1


def test_held_out_labels_do_not_train_and_missing_classes(spark, small):
    ids = [i for i in range(400) if held_out(i)]
    docs = [(i, "some words") for i in ids]
    q = QUERIES["op9_subword_toxicity"]
    assert max(r["score"] for r in q(spark, folder(small, docs, [(i, 1) for i in ids])).collect()) < 1e-6
    some = [(i, "some words") for i in range(20)]
    assert {r["predicted"] for r in q(spark, folder(small, some, [(i, 1) for i in range(20)])).collect()} == {1}
    assert q(spark, folder(small, [], [])).collect() == []


def test_filter_keeps_clean_rows_and_columns(spark):
    docs, labels = corpus(400, 9)
    d = spark.createDataFrame([(i, t, "s", 1.0) for i, t in docs], "doc_id long, text string, score string, p double")
    model = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = toxicity.drop_toxic(d, model)
    assert kept.columns == d.columns
    truth = dict(labels)
    left = [r["doc_id"] for r in kept.collect()]
    assert sum(truth[i] for i in left) <= 3 and len(left) >= sum(1 - t for t in truth.values()) - 3


def _plain_score(text, line, bias):
    """A document's score with plain loops over passages, words and n-grams."""
    words = Words(pa.array([text]))
    each = []
    for w in range(len(words.start)):
        grams, _ = toxicity.word_grams(words, np.array([w]))
        each.append(np.mean([line[g] for g in grams]))
    n = len(each)
    starts = sorted({min(s, max(n - 8, 0)) for s in range(0, max(n - 4, 1), 4)} | {max(n - 8, 0)})
    return 1 / (1 + np.exp(-(bias + max(np.mean(each[s:s + 8]) for s in starts))))


def test_scores_equal_plain_loops():
    rng = np.random.default_rng(3)
    line, rnd = rng.normal(size=toxicity.BUCKETS), random.Random(8)
    texts = [" ".join(rnd.choice(CLEAN) for _ in range(n)) for n in (1, 2, 7, 8, 9, 11, 12, 13, 16, 17, 50)]
    got = toxicity.score_texts(pa.array([*texts, None, ""]), (line, 0.3))
    assert np.allclose(got[:-2], [_plain_score(t, line, 0.3) for t in texts])
    assert np.allclose(got[-2:], 1 / (1 + np.exp(-0.3)))
    first, size, per_doc = toxicity.passages(np.array([0, 1, 8, 9, 20]))
    assert per_doc.tolist() == [0, 1, 1, 2, 4]
    assert list(zip(first.tolist(), size.tolist(), strict=True)) == [(0, 1), (1, 8), (9, 8), (10, 8), (18, 8), (22, 8), (26, 8), (30, 8)]


def test_gradient_matches_differences():
    rng = np.random.default_rng(4)
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(CLEAN) for _ in range(n)) for n in (3, 9, 20, 40)]
    block = toxicity.Block.of(pa.array([*texts, ""]), [1, 0, 1, 0, 1], [1.0, 2.0, 1.0, 0.5, 3.0])
    block = toxicity.Block.read(block.arrays())
    line = rng.normal(size=toxicity.BUCKETS)

    def loss(line, bias, attend=None):
        word = segment_sum(line[block.grams], block.per_word) / block.per_word
        score = toxicity.passage_scores(word[block.tokens], block.first, block.size)
        starts = np.cumsum(block.per_doc) - block.per_doc
        if attend is None:  # the weights of passages are held fixed
            attend = np.exp(2 * (score - np.repeat(np.maximum.reduceat(score, starts), block.per_doc)))
            attend /= np.repeat(segment_sum(attend, block.per_doc), block.per_doc)
        z = segment_sum(attend * score, block.per_doc) + bias
        return (block.weight * (np.logaddexp(0, z) - block.toxic * z)).sum(), attend
    _, attend = loss(line, 0.1)
    on_bucket, on_bias = block.gradient(line, 0.1, 2.0)
    for k in rng.choice(np.flatnonzero(np.abs(on_bucket) > 1e-4), 15):
        up, down = line.copy(), line.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        assert np.isclose(on_bucket[k], (loss(up, 0.1, attend)[0] - loss(down, 0.1, attend)[0]) / 2e-5, rtol=1e-4, atol=1e-7)
    assert np.isclose(on_bias, (loss(line, 0.1 + 1e-5, attend)[0] - loss(line, 0.1 - 1e-5, attend)[0]) / 2e-5, rtol=1e-4)


def test_blocks_hold_every_sampled_text_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 200)
    docs = [(i, " ".join([f"w{i}"] * (1 + i % 9))) for i in range(300)] + [(3, "another text"), (4, None), (5, ""), (6, "w6 " * 400)]
    sample = spark.createDataFrame([(i, i % 2, 1.0 + i % 2) for i in range(300)], "doc_id long, toxic int, weight double")
    rows = toxicity.training_blocks(spark.createDataFrame(docs, "doc_id long, text string"), sample).collect()
    blocks = [toxicity.Block.read([r[c] for c in toxicity._ARRAYS]) for r in rows]
    assert sum(len(b.n_words) for b in blocks) == 300 and len(blocks) > 24
    assert sum(r["total"] for r in rows) == 450.0 and max(len(r["tokens"]) for r in rows) <= 4 * 400
    fewer = toxicity.training_blocks(spark.createDataFrame(docs, "doc_id long, text string"), sample, train_bytes=2000).collect()
    small = [toxicity.Block.read([r[c] for c in toxicity._ARRAYS]) for r in fewer]
    assert 500 < sum(5 * len(b.tokens) for b in small) < 4000
    assert abs(sum(r["total"] for r in fewer) - 450.0) < 200
    assert sorted({r["batch"] for r in rows}) == list(range(toxicity.BATCHES))
    assert all(len(b.tokens) == b.n_words.sum() and len(b.per_word) == b.tokens.max() + 1 for b in blocks)

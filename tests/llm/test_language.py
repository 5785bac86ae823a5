import binascii
import random

import numpy as np
import pyarrow as pa

from lodestar.llm import language
from lodestar.llm.queries import QUERIES
from lodestar.llm.words import Words

VOCAB = {"aa": "the and house of water green hill stone river".split(),
         "bb": "der und haus von wasser grün hügel stein fluß".split(),
         "cc": "вода дом река камень зелёный холм мост утро".split()}


def text(rnd, lang, n):
    return " ".join(rnd.choice(VOCAB[lang]) for _ in range(n))


def held_out(i):
    return binascii.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy_and_edges(spark, small):
    rnd = random.Random(2)
    rows = [(i, text(rnd, lang := rnd.choice(sorted(VOCAB)), rnd.choice([4, 30, 300])), lang) for i in range(300)]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 %% 77", "cc"), (1003, "x" * 200_000, None),
           (None, text(rnd, "bb", 9), "bb"), (5, rows[5][1], rows[5][2])]
    data = rows + odd
    path = small(documents=pa.table({
        "doc_id": pa.array([r[0] for r in data], pa.int64()), "text": pa.array([r[1] for r in data]),
        "lang": pa.array([r[2] for r in data]), "lang_pred": pa.array(["zz"] * len(data)),
        "score": pa.array([9] * len(data))}))
    got = QUERIES["op4_language_mixture"](spark, path).collect()
    assert len(got) == len(data)
    by = {r["doc_id"]: r for r in got}
    for i, _, lang in rows:
        assert by[i]["held_out"] == held_out(i)
        assert by[i]["lang_pred"] == lang and by[i]["score"] > 0.5
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1000]["score"] == 0 and by[1003]["lang_pred"] in VOCAB
    assert by[None]["lang_pred"] == "bb" and by[None]["held_out"] is False


def test_held_out_labels_do_not_train(spark):
    ids = [i for i in range(200) if held_out(i)]
    docs = spark.createDataFrame([(i, "some text", "zz") for i in ids] + [(None, "x y", None)],
                                 "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == []
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []


def test_mixtures_are_recovered_and_filtered(spark):
    rnd = random.Random(5)
    docs = spark.createDataFrame([(i, text(rnd, lang, 60), lang) for i, lang in enumerate(sorted(VOCAB) * 40)],
                                 "doc_id long, text string, lang string")
    model = language.fit(docs)
    for share in (0.3, 0.5, 0.8):
        n = 400
        mixed = text(rnd, "aa", int(share * n)) + " " + text(rnd, "bb", n - int(share * n))
        p = dict(zip(model.languages, language.proportions(Words(pa.array([mixed])), model)[0], strict=True))
        assert abs(p["aa"] - share) < 0.1 and p["cc"] == 0
    third = " ".join(text(rnd, lang, 100) for lang in sorted(VOCAB))
    rows = [(1, text(rnd, "cc", 5), 7), (2, third, 7), (3, None, 7), (4, "12 34", 7), (1, text(rnd, "aa", 50), 7)]
    kept = language.drop_unidentified(spark.createDataFrame(rows, "doc_id long, text string, score int"), model)
    assert sorted(tuple(r) for r in kept.collect()) == sorted([rows[0], rows[4]])


def test_signs_of_numbers_are_no_letters():
    texts = ["² ½ ①", "Ⅷ", "½ 12", "①", "x²", "é", "漢", "ʰ", None, "", "_ 12 %"]
    assert language.has_letter(pa.array(texts)).tolist() == [
        any(c.isalpha() for c in t or "") for t in texts]
    model = language.Model(["aa"], np.zeros((language.BUCKETS, 1)))
    assert language.predict(pa.array(["² ½ ①", "Ⅷ"]), model)[0] == ["und", "und"]


def test_proportions_are_the_likeliest():
    """Against plain EM run for thousands of rounds, and the bound of what is left."""
    rng = np.random.default_rng(6)
    units = np.array([3, 40, 7, 1])
    like, times = rng.random((int(units.sum()), 3)) ** 3 + 1e-6, rng.integers(1, 4, int(units.sum()))
    first = 0
    share, value, gap = language._mixture(like, times, units, np.ones((4, 3)), 5000, 0.01)
    early = language._mixture(like, times, units, np.ones((4, 3)), 4)
    for d, n in enumerate(units):
        own, p = np.repeat(like[first:first + n], times[first:first + n], axis=0), np.full(3, 1 / 3)
        first += n
        for _ in range(5000):
            joint = own * p
            p = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        best = np.log(own @ p).sum()
        assert value[d] <= best + 1e-9 and best <= value[d] + gap[d] + 1e-9 and gap[d] <= 0.01
        assert early[1][d] <= best + 1e-9 <= early[1][d] + early[2][d] + 1e-6
        assert np.isclose(share[d].sum(), 1)


def _plain_log_like(word, model):
    text = b"\x01" + word.lower().encode() + b"\x01"
    text += b"\x01" * (language.GRAM - len(text))
    return sum(model.log_p[_bucket(text[i:i + language.GRAM])] for i in range(len(text) - language.GRAM + 1))


def _bucket(gram):
    h = np.array([gram[0]], dtype=np.uint64)
    for c in gram[1:]:
        h = h * np.uint64(0x100000001B3) + np.uint64(c)
    return int(language.mix(h)[0] & np.uint64(language.BUCKETS - 1))


def test_word_likelihoods_and_shares_against_plain_loops():
    """Single-language choice and proportions from plain per-word sums."""
    rng = np.random.default_rng(9)
    model = language.Model(["aa", "bb"], np.log(rng.dirichlet(np.ones(language.BUCKETS), 2).T + 1e-9) / language.GRAM)
    texts = ["Aber aber über x", "the the the quick fox", "é", "a b c d e f g " * 30]
    for t in texts:
        words = t.split()
        like = np.array([_plain_log_like(w, model) for w in words])
        alone = like.sum(axis=0)
        penalty = language.PENALTY * np.log(len(words) + 1)
        p = np.array([0.5, 0.5])
        for _ in range(4000):
            joint = np.exp(like - like.max(axis=1, keepdims=True)) * p
            p = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        mixed = np.logaddexp(like[:, 0] + np.log(p[0] + 1e-300), like[:, 1] + np.log(p[1] + 1e-300)).sum()
        want = p if mixed - 2 * penalty > alone.max() - penalty + 0.02 else np.eye(2)[alone.argmax()]
        got = language.proportions(Words(pa.array([t])), model)[0]
        assert np.allclose(got, want, atol=0.05), t

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import jaccard_join as jj
from lodestar.llm.queries import QUERIES
from lodestar.llm.words import Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def brute(rows):
    """Multiset of (doc_id, class_id, n_links)."""
    sets = [shingles(t) for _, t in rows]
    links = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j]
              and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    group = [None] * len(rows)
    for i in range(len(rows)):
        if group[i] is None:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            for j in seen:
                group[j] = seen
    least = [min((rows[j][0] for j in g if rows[j][0] is not None), default=None) for g in group]
    return sorted(((r[0], c, len(n)) for r, c, n in zip(rows, least, links, strict=True)), key=repr), group


def corpus(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "漢字"]
    doc = lambda n: [rnd.choice(vocab) for _ in range(n)]
    rows, i = [], 0

    def add(words):
        nonlocal i
        rows.append((i * 13 % 997, " ".join(words)))
        i += 1

    for _ in range(60):
        add(doc(rnd.choice([1, 4, 5, 6, 30, 300])))
    for size in (2, 3, 8, 60):  # groups of near copies, some just below the threshold
        base = doc(150)
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            add(w)
    chain = doc(200)
    for step in range(6):  # linked only to their neighbours
        add(chain[step * 12:step * 12 + 120])
    for w in (doc(40), doc(3)):
        for _ in range(7):
            add(w)
    rows += [(2000, None), (2001, ""), (2002, "%% !"), (2002, "%% !"), (None, rows[70][1]), (None, "lonely null id"),
             rows[62], rows[62], (2003, "Long text. " * 30000), (2004, "long TEXT! " * 30000)]
    return rows


@pytest.mark.parametrize("block", [jj.BLOCK, 7])
def test_links_and_classes_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jj, "BLOCK", block)
    rows = corpus()
    got = jj.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)[0]


@pytest.mark.parametrize("names", [("key", "label"), ("gone_id", "gone_key"), ("lodestar text key", "text_key"), ("again", "Gone_Id"), ("salt", "links")])
def test_one_document_of_each_group_stays(spark, names):
    rows = corpus(6)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], f"doc_id long, text string, `{names[0]}` int, `{names[1]}` string")
    kept = jj.drop_near_copies(d)
    assert kept.columns == d.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = {frozenset(g) for g in brute(rows)[1]}
    assert len(kept) == len(groups)
    left = sorted(kept, key=repr)
    want = []
    for g in groups:
        ids = [rows[j][0] for j in g if rows[j][0] is not None]
        want.append(min(ids) if ids else None)
    assert sorted((r[0] for r in left), key=repr) == sorted(want, key=repr)


def test_pruning_keeps_what_may_reach_the_threshold():
    # exact tail: P(Binomial(n, 0.8) < least) is the chance to lose a pair at the threshold
    from math import comb
    lost = sum(sum(comb(n, m) * 0.8**m * 0.2**(n - m) for m in range(least)) for n, least in jj.LEAST.items())
    assert lost < 1e-4 * 0.1
    assert all(0.4 * n < least < 0.8 * n for n, least in jj.LEAST.items())


def test_query_edges(spark, small):
    t = pa.table({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array(["a b c d e f g"] * 2),
                  "key": pa.array(["k"] * 2), "links": pa.array([0, 0])})
    q = QUERIES["op8_ngram_jaccard_join"]
    assert sorted(tuple(r) for r in q(spark, small(documents=t)).collect()) == [(1, 1, 1), (2, 1, 1)]
    assert q(spark, small(documents=t.slice(0, 0))).collect() == []
    assert jj.drop_near_copies(spark.read.parquet(small(documents=t.slice(0, 0)) + "/documents.parquet")).collect() == []
    assert np.all(np.array(list(jj.LEAST)) % jj.STEP == 0)


def test_words_that_collide_modulo_a_power_of_two_are_apart(spark):
    x = "a"
    while len(x) < 1024:  # equal under every polynomial modulo 2^64
        x += x.translate(str.maketrans("ab", "ba"))
    y = x.translate(str.maketrans("ab", "ba"))
    rows = [(i, f"one two three four five six {w}") for i, w in enumerate((x, y))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jj.linked_documents(df).collect())) == [(0, 0, 0), (1, 1, 0)]
    assert jj.drop_near_copies(df).count() == 2


def test_text_keys_are_those_of_the_word_sequence():
    texts = ["a b", " A\tb!", "ab", "", None, "a b a", "  ", "x" * 5000 + " y", "b", "é É", "é\nÉ", "a  b"]
    keys = Words(pa.array(texts)).text_keys()
    want = [tuple(WORD.findall((t or "").translate(LOWER))) for t in texts]
    for i, a in enumerate(want):
        assert (keys[i] is None) == (not a)
        for j, b in enumerate(want):
            assert (keys[i] == keys[j]) == (a == b)


def test_word_hashes_follow_the_bytes():
    words = ["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "abcdefgh" * 2, "abcdefgh" * 3, "x" * 255, "x" * 256, "x" * 257, "x" * 258]
    hashes = Words(pa.array([" ".join(words), " ".join(reversed(words))])).hash
    assert len(set(hashes.tolist())) == len(words)
    assert hashes[:len(words)].tolist() == hashes[len(words):][::-1].tolist()

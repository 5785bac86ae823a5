import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import fingerprints as fp


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() or "a" <= c <= "z" or ord(c) >= 128 else " "
                for c in text).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """{doc_id: (n_chars, edited text, successor's text)} in descending doc_id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, after = t or "", after or ""
        h = len(t) // 2
        out[i] = (len(t), t[:len(t) - h] + after[:h], after)
    return out


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_edited_texts_and_likeness(spark, ranges):
    rnd = random.Random(3)
    vocab = ["ab", "Ünï", "x", "漢字", "word", "tail", "q1", "zz"] + [f"w{i}" for i in range(200)]
    rows = [(i * 7 % 101, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 6, 40, 400, 3000]))))
            for i in range(101)]
    rows += [(200, None), (201, ""), (202, "%%"), (203, "a b"), (300, "long text " * 20000)]
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string"), ranges).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    texts = {i: t or "" for i, t in rows}
    errors = []
    for i, (n, edited, after) in want.items():
        assert got[i]["n_chars"] == n
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for col, other in (("near_edited", edited), ("near_next", after)):
            a, b = shingles(texts[i]), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert 0 <= got[i][col] <= 1
            errors.append(abs(got[i][col] - true))
    assert np.mean(errors) < 0.02 and max(errors) < 0.15
    by_text = {}
    for i, t in texts.items():
        assert by_text.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_densified_estimates_are_unbiased_for_small_sets():
    rnd = random.Random(1)
    errors = []
    for k in range(300):
        n = rnd.choice([2, 5, 20, 100, 1500])
        a = [f"a{rnd.random()}" for _ in range(n)]
        b = a[:n // 2] + [f"b{rnd.random()}" for _ in range(n - n // 2)]
        sa, sb = shingles(" ".join(a)), shingles(" ".join(b))
        low, has = fp.sketch(pa.array([" ".join(a), " ".join(b)]))
        est = fp.likeness(low[:1], has[:1], low[1:], has[1:])[0]
        errors.append(est - len(sa & sb) / len(sa | sb))
    assert abs(np.mean(errors)) < 0.02


def test_nulls_repeats_single_and_empty(spark):
    schema = "doc_id long, text string, place int"
    one = fp.edited_fingerprints(spark.createDataFrame([(1, "abcd", 3)], schema)).collect()
    assert [(r["doc_id"], r["n_chars"]) for r in one] == [(1, 4)]
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    rows = [(None, "x y", 1), (None, None, 1), (2, "same text", 2), (2, "same text", 2), (2, "other", 2)]
    got = fp.edited_fingerprints(spark.createDataFrame(rows, schema), 4).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (0, 3), (2, 5), (2, 9), (2, 9)]
    assert fp.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    f = fp.fingerprint(spark.createDataFrame(rows, schema)).collect()
    assert len(f) == 5 and len({r["fingerprint"] for r in f if r["doc_id"] == 2}) == 2

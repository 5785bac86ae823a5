import functools
import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import sentencepiece_codec as sc
from lodestar.llm.queries import QUERIES

PATH = sc.default_model_path()
PARTS = ["the", "Thing", "straße", "ñandú", "é", "漢字", "字", "𝕏", "ﬁ", "\n", "\t", " ", "  ", "     ", "12", "%%%", "x" * 80,
         "tion", "ing", "er", "\x00"]


@functools.cache
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*PARTS, " ", " "]), max_size=20).map("".join))
def test_ids_and_text_equal_the_library(text):
    ids = sc.codec(PATH).encode(text)
    assert ids == library().encode(text)
    assert sc.codec(PATH).decode(ids) == text == library().decode(ids)


def exhaustive(model, text):
    """Best total score over all segmentations, by plain dynamic programming."""
    pieces = {p: s for p, s, t in zip(model.pieces, model.scores, model.types, strict=True) if t == sc.NORMAL}
    unknown = min(pieces.values()) - 10
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(end):
            s = pieces.get(text[begin:end], unknown if end - begin == 1 else None)
            if s is not None and (best[end] is None or best[begin] + s > best[end]):
                best[end] = best[begin] + s
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcé▁", max_size=25), st.randoms(use_true_random=False))
def test_unigram_models_reach_the_best_score(text, rnd):
    words = ["a", "b", "ab", "abc", "bc", "c", "ca", "aab", "▁", "▁a", "▁ab", "▁▁"]
    chosen = rnd.sample(words, 8)
    model = sc.PieceModel(["<unk>", *chosen], [0.0, *[-float(rnd.randrange(1, 9)) for _ in chosen]],
                          [sc.UNKNOWN, *[sc.NORMAL] * len(chosen)], dummy_prefix=False)
    codec = sc.Codec(model)
    ids = codec.encode(text)
    score = sum(codec.unknown_score if i == 0 else model.scores[i] for i in ids)
    assert score == (exhaustive(model, codec.normalise(text)) or 0.0)
    assert len(codec.decode(ids)) >= 0


def test_query_matches_the_library(spark, small):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 40])))) for i in range(60)]
    rows += [(100, None), (101, ""), (101, ""), (None, "no id"), (102, "long words " * 15000), (103, "a▁b")]
    t = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows]),
                  "ids": pa.array(["x"] * len(rows)), "decoded": pa.array([1] * len(rows))})
    got = QUERIES["op10_sentencepiece_codec"](spark, small(documents=t)).collect()
    want = []
    for i, text in rows:
        ids = library().encode(text or "")
        back = (text or "").replace("▁", " ")
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()),
                     hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert QUERIES["op10_sentencepiece_codec"](spark, small(documents=t.slice(0, 0))).collect() == []


def test_encode_and_decode_frames(spark):
    docs = spark.createDataFrame([(1, "Hello wörld", 9), (2, None, 9)], "doc_id long, text string, ids int")
    coded = sc.encode(docs)
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {1: library().encode("Hello wörld"), 2: []}
    assert {r["doc_id"]: r["text"] for r in sc.decode(coded).collect()} == {1: "Hello wörld", 2: ""}


def test_last_pipeline_stage_decodes_its_ids(spark):
    import corpus_pipeline

    texts = {1: "Plain words, twice. Plain words.", 2: "  two  spaces ", 3: "", 4: None, 5: "\u2581 mark", 6: "caf\u00e9 \u6f22\u5b57 \U0001f600"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    own = sc.codec(sc.default_model_path())
    got = {r["doc_id"]: r for r in corpus_pipeline.encoded(spark, docs, "").collect()}
    assert sorted(got) == sorted(texts)
    for i, text in texts.items():
        assert got[i]["ids"] == own.encode(text) and got[i]["n_ids"] == len(got[i]["ids"])
        assert got[i]["lossless"] == (own.decode(got[i]["ids"]) == (text or ""))
    assert got[1]["lossless"]


def test_long_runs_of_spaces():
    codec = sc.Codec(sc.PieceModel.read(sc.default_model_path()))
    library = sentencepiece.SentencePieceProcessor(model_file=sc.default_model_path())
    texts = ["a" + " " * n + "b" for n in (1, 2, 3, 5, 17, 64, 100, 333)] + ["x  y   z " * 300, " " * 1000, "▁▁ ▁a  "]
    ids, n = codec.encode_texts(texts)
    first = 0
    for t, k in zip(texts, n, strict=True):
        assert ids[first:first + k].tolist() == library.encode(t), t[:20]
        first += k
    began = time.perf_counter()
    ids, n = codec.encode_texts([" " * 100_000 + "end"])
    assert time.perf_counter() - began < 20 and n[0] == len(library.encode(" " * 100_000 + "end"))

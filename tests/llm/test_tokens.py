import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import tokens
from lodestar.llm.queries import QUERIES

PATH = tokens.default_tokenizer_path()
PIECES = ["the", "Thing", "it's", "don't", "é", "ñandú", "漢字", "12", "3.5", "\n", "\t", " ", "  ", " ",
          "　", " ", "<|endoftext|>", "😀", "...", "%%%", "a" * 90, "\x1c", "\x85", "É", "x y", "\r\n"]


def library(text):
    return tokens._tokenizer(PATH).encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PIECES, " ", " ", " "]), max_size=25).map("".join), max_size=6))
def test_chunked_encoding_equals_the_library(texts):
    ids, n = tokens.chunk_encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])][:len(texts)] == [library(t) for t in texts] or not texts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=30), max_size=8))
def test_coding_round_trip(docs):
    coded = [tokens.encode_values(np.array(d, dtype=np.uint32)) for d in docs]
    control = [tokens.control_bytes(e) for e, _ in coded]
    back = tokens.decode_values(np.concatenate([*control, np.zeros(0, np.uint8)]), np.array([len(d) for d in docs], dtype=np.int64),
                                np.concatenate([*(d for _, d in coded), np.zeros(0, np.uint8)]))
    assert back.tolist() == [v for d in docs for v in d]
    assert sum(map(len, control)) == sum(-(-len(d) // 4) for d in docs)


@pytest.mark.parametrize("parts", [1, 5])
def test_query_against_the_library(spark, small, parts):
    rnd = random.Random(8)
    rows = [(i * 37 % 211 - 50, "".join(rnd.choice([*PIECES, " ", " "]) for _ in range(rnd.choice([0, 3, 50]))))
            for i in range(120)]
    rows += [(1000, None), (1001, ""), (1001, ""), (1002, "word and " * 20000)]
    path = small(documents=pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()),
                                     "text": pa.array([r[1] for r in rows], pa.string()),
                                     "start": pa.array([1] * len(rows)), "tie": pa.array(["t"] * len(rows))}))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = QUERIES["op5_token_files"](spark, path).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library(text or ""), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_null_ids_and_empty_table(spark, small):
    t = pa.table({"doc_id": pa.array([None, 3, None], pa.int64()), "text": pa.array(["a b", None, "c"])})
    got = QUERIES["op5_token_files"](spark, small(documents=t)).collect()
    assert sorted(r["start"] for r in got if r["doc_id"] is None)[0] == 0
    assert [r["start"] for r in got if r["doc_id"] == 3] == [5]
    assert QUERIES["op5_token_files"](spark, small(documents=t.slice(0, 0))).collect() == []


class Spy:
    """Counts what goes to the library."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def encoder(**limits):
    made = tokens.ChunkEncoder(PATH)
    made.tokenizer = Spy(made.tokenizer)
    for name, value in limits.items():
        setattr(made, name, value)
    return made


def check(made, texts):
    ids, n = made.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library(t) for t in texts]


def test_a_word_goes_to_the_library_once_whatever_follows_it():
    made, rnd = encoder(), random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(300)]
    for after in [" ", ", ", ".\n", "! ", "'s ", "...\n", "7 ", "\n", ") ", ": "]:
        check(made, ["x " + "".join(w + after.replace("\n", "\n- ") for w in words) + "x"])
    assert sum(map(len, made.tokenizer.given)) < 1.2 * sum(len(w) + 1 for w in words)


def test_the_library_is_not_asked_again_for_a_million_chunks():
    made = encoder()
    # more chunks than were kept before, all of them short
    for _ in range(2):
        for first in range(0, 1_100_000, 100_000):
            made.encode(pa.array(["x" + "".join(f" {i:x}" for i in range(first, first + 100_000))]))
        asked = len(made.tokenizer.given)
        made.tokenizer.given.clear()
    assert asked == 0


@pytest.fixture(scope="module")
def made():
    return encoder(), encoder(CACHED_CHUNKS=3, CACHED_BYTES=5)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \n\t\r'.,-(sldtvmreAZ09é¿ßñ漢́\u0085 　 😀\x7f\x1c", max_size=40), min_size=1, max_size=5))
def test_every_cut_is_one_of_the_library(made, texts):
    made[0].forget()
    check(made[0], texts)
    check(made[1], texts + texts[::-1])


def test_white_space_at_the_ends_of_neighbouring_texts():
    check(encoder(), ["b a ", " \nfoo", "b c\n", "\n\nd", "e ", " f", "\n", " ", "g\n"])


def test_other_patterns_are_cut_at_spaces_only(tmp_path):
    from tokenizers import Regex, Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = Sequence([Split(Regex(r"[A-Za-z]+[.,]*\n*| ?[^\sA-Za-z]+\n*| [A-Za-z]+|\s"), "isolated"),
                                    ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    made = tokens.ChunkEncoder(str(tmp_path / "other.json"))
    texts = ["well.\nthen, a word.\n- of 12,\nand\nmore..\nthe end"]
    ids, _ = made.encode(pa.array(texts))
    assert ids.tolist() == made.tokenizer.encode(texts[0], add_special_tokens=False).ids

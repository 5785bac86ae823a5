import hashlib
import random
import re

import pyarrow as pa
import pytest

from lodestar.llm import decontaminate
from lodestar.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(10, len(iw))
            windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    if item_id is not None:
                        found.add(str(item_id))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed=7):
    rnd = random.Random(seed)
    vocab = ["a", "B", "cc", "Dé", "e1", "ß", "x"]
    text = lambda n: rnd.choice(["", " ", "¶ "]) + rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 3, 9, 10, 11, 14, 40, 40, 25, 0])]
    items += [(3, items[6][1]), (20, None), (None, "only here one two three four five six seven eight nine"),
              (21, "was " * 30), (100, items[7][1])]
    docs = [(i, text(rnd.choice([0, 1, 5, 9, 10, 12, 60, 300]))) for i in range(60)]
    for i in range(60, 90):
        src = words(rnd.choice(items[4:9])[1])
        a = rnd.randrange(max(1, len(src) - 5))
        docs.append((i, text(30) + " " + " - ".join(src[a:a + rnd.randrange(5, 25)]).upper() + " " + text(20)))
    docs += [(90, None), (91, ""), (91, ""), (None, items[6][1]), (92, "WAS " * 200), (93, "%%%"),
             (94, "x only HERE one two three four five six seven eight nine"),
             (95, "word " * 30000 + items[6][1])]
    return docs, items


@pytest.mark.parametrize("block_chars", [10**9, 150])
def test_spans_and_items_match_brute_force(spark, block_chars):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leak_report(decontaminate.find_leaks(d, b, block_chars)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)
    clean = decontaminate.drop_leaks(d, b, block_chars).collect()
    assert sorted((tuple(r) for r in clean), key=repr) == sorted(
        [x for x in docs if not brute([x], items)[0][5]], key=repr)


def test_copies_of_an_item_are_indexed_once(spark):
    """A third of the benchmark's rows are one item: its copies neither fill a
    block nor add blocks."""
    items = [(f"i{k}", f"{k} " + " ".join(str(k * j) for j in range(40))) for k in range(100)]
    copies = [items[0]] * 50
    b = spark.createDataFrame(items + copies, "item_id string, text string")
    blocks = [index.value.ids for index in decontaminate.benchmark_blocks(b, 2000)]
    assert sorted(i for ids in blocks for i in ids) == sorted(i for i, _ in items)
    assert len(blocks) == len(list(decontaminate.benchmark_blocks(b.distinct(), 2000)))


def test_query_on_clashing_columns_and_empty_tables(spark, small):
    docs = pa.table({"doc_id": pa.array([1, None]), "text": pa.array(["a b", None]),
                     "n_words": pa.array([5, 6]), "spans": pa.array(["x", "y"])})
    none = pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    q = QUERIES["op2_winnowing_decontamination"]
    rows = sorted((tuple(r)[:4] for r in q(spark, small(documents=docs, benchmark=none)).collect()), key=repr)
    assert rows == [(1, 2, 0, 0), (None, 0, 0, 0)]
    empty = small(documents=docs.slice(0, 0), benchmark=none)
    assert q(spark, empty).collect() == []

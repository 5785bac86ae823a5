import random
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import merkle
from lodestar.llm.queries import ORACLES, QUERIES

NAME = "op13_merkle_manifest"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def walk(levels, at):
    """(place in its run, run) on the way up."""
    for nodes in levels[:-1]:
        run = nodes[at // 2 * 2:at // 2 * 2 + 2]
        yield at % 2, run
        at //= 2


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    made = []
    for doc, text, lang, source, n in rows:
        leaf = H(field(doc), field(source), field(lang), field(n), field(text))
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0
        claimed = H(field(doc), field(source), field(lang), field(None if n is None else n + 1), field(text)) if tampered else leaf
        made.append(((lang is not None, (lang or "").encode()), (doc is not None, doc or 0, leaf), doc, leaf, claimed))
    trees = {}
    for tree, order, *rest in sorted(made):
        trees.setdefault(tree, []).append(rest)
    below = {t: levels([leaf for _, leaf, _ in v]) for t, v in trees.items()}
    above = levels([below[t][-1][0] for t in sorted(below)])
    out = []
    for k, t in enumerate(sorted(below)):
        for i, (doc, leaf, claimed) in enumerate(trees[t]):
            folded, sib = claimed, []
            for at, run in [*walk(below[t], i), *walk(above, k)]:
                sib += [x for j, x in enumerate(run) if j != at]
                folded = H(*[folded if j == at else x for j, x in enumerate(run)])
            root = above[-1][0]
            out.append((doc, leaf, below[t][-1][0], root, H(*sib), folded, folded == root))
    return sorted(out, key=repr)


def table(rows):
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "text": pa.array(cols[1], pa.string()),
                     "lang": pa.array(cols[2], pa.string()), "source": pa.array(cols[3], pa.string()),
                     "n_chars": pa.array(cols[4], pa.int64()), "part": ["x"] * len(rows), "hash": [1] * len(rows),
                     "tree": [None] * len(rows)})


def documents():
    rnd = random.Random(11)
    rows = [(i, f"text {i} é" * rnd.randrange(4), rnd.choice(["en", "en", "en", "de", "fr"]), "web", i) for i in range(700)]
    rows += [(1000 + i, "t", f"l{i:03d}", None, i) for i in range(90)]  # trees of one leaf
    rows += [(5, "copy", "en", "hot", 4)] * 60 + [(5, "other", "en", "hot", 4)] * 3
    rows += [(None, None, None, None, None), (None, "a", None, "s", 1), (7, "", "", "", 0), (-3, "a:-", "\U0001f600", "é", 2**63 - 1),
             (8, "x" * 200_000, "￿", "s", 200_000), (2**62, "b", None, None, None)]
    rnd.shuffle(rows)
    return rows


def result(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("part_bits, merged_bits", [(12, 9), (3, 1), (5, 2)])
def test_against_brute_force(spark, small, monkeypatch, part_bits, merged_bits):
    monkeypatch.setattr(merkle.Manifest.__init__, "__defaults__", (part_bits, merged_bits))
    rows = documents()
    assert result(QUERIES[NAME](spark, small(documents=table(rows)))) == plain(rows)


def test_sql_agrees_on_odd_rows(spark, small):
    rows = documents()
    path = small(documents=table(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet')")
    assert sorted(con.execute(ORACLES[NAME]).fetchall(), key=repr) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(3, "only", "en", "s", 4)], [(None, None, None, None, None)], [(1, "a", "x", "s", 1), (2, "b", "y", "s", 1)]])
def test_smallest_tables(spark, small, rows):
    assert result(QUERIES[NAME](spark, small(documents=table(rows)))) == plain(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(0, n - 1), min_size=1))))
def test_the_fetched_nodes_suffice_and_none_is_spare(case):
    n, own = case
    all_levels = levels([H(str(i)) for i in range(n)])
    places = np.array(sorted(own))
    missing = merkle.missing_nodes(places, n)

    def top(fetched):
        known = [{} for _ in range(merkle.height(n) + 1)]
        known[0] = {i: all_levels[0][i] for i in own}
        for level, at in fetched:
            known[level][at] = all_levels[level][at]
        merkle.derive(known, n)
        return known
    known = top(missing)
    assert known[-1] == {0: all_levels[-1][0]}
    for i in own:
        path = merkle.siblings(known, i)
        assert merkle.fold(all_levels[0][i], path) == all_levels[-1][0]
        assert [x for _, x in path if x] == [x for at, run in walk(all_levels, i) for j, x in enumerate(run) if j != at]
    for spare in missing:
        assert not top([m for m in missing if m != spare])[-1]


def test_a_part_asks_for_two_nodes_a_level_at_most():
    for lo, hi, n in ((4096, 8192, 10**6), (5000, 9096, 10**6), (0, 4096, 4097), (123_456, 127_552, 123_457 + 4096)):
        assert len(merkle.missing_nodes(np.arange(lo, hi), n)) <= 2 * merkle.height(n)


def test_texts_and_trees_are_not_shuffled_by_tree(spark):
    plan = QUERIES[NAME](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "hashpartitioning(lang" not in plan and "hashpartitioning(tree_key" not in plan

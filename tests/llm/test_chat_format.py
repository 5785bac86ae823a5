import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.llm import chat_format
from lodestar.llm.queries import ORACLES, QUERIES

NAME = "op11_chat_prefix_examples"
SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", " ", "</s>", "[INST] x [/INST]", "<\\/s>", "<\\\\s>", "[\\ROLE]\\", "[[ROLE]]", "a</s", "s>", "<s>[ROLE]assistant[/ROLE]no</s>",
       "é\n \U0001f600", "$1 \\1", "\x00", "[ROLE", "</s></s>"]


def conversations():
    rnd = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "assistant", "system"]),
                         "".join(rnd.choice(ODD) for _ in range(rnd.randrange(4)))))
    rows += [(100, None, "user", "first"), (100, 0, "assistant", "b"), (100, 0, "assistant", "a"), (100, 0, "assistant", "a"),
             (101, 0, None, None), (101, 1, "assistant", None), (102, 0, "user", "no reply"), (None, 0, "user", "x"),
             (None, 1, "assistant", "y"), (103, 0, "a[/ROLE]</s>", "t"), (104, 0, "assistant", "z" * 300_000), (104, 1, "Assistant", "k")]
    rows += [(200, t, ("user", "assistant")[t % 2], f"turn {t} </s>") for t in range(600)]
    rnd.shuffle(rows)
    return rows


def plain(rows):
    """Per conversation: its sorted (role, text) turns."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(v)] for c, v in by.items()}


def escaped(text):
    return re.sub(r"([<\[])(\\*)(/?(?:s>|ROLE\]|INST\]))", r"\1\\\2\3", text)


def piece(role, text):
    return f"<s>[ROLE]{escaped(role)}[/ROLE]{escaped(text)}</s>"


def test_every_reply_is_an_example_of_all_before_it(spark):
    rows = conversations()
    got = {(r["conv_id"], r["example"]): r for r in chat_format.examples(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {}
    for conv, turns in plain(rows).items():
        pieces = [piece(*t) for t in turns]
        ends = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        if not ends or ends[-1] < len(turns) - 1:
            ends.append(len(turns) - 1)
        for n, i in enumerate(ends):
            loss = escaped(turns[i][1]) if turns[i][0] == "assistant" else ""
            want[conv, n + 1] = ("".join(pieces[:i + 1]), loss, i == len(turns) - 1)
    assert {k: (r["text"], r["text"][r["loss_start"]:r["loss_end"]], r["last"]) for k, r in got.items()} == want


def test_digests_against_plain_python_and_duckdb(spark, small):
    rows = conversations()
    names = ["conv_id", "turn", "role", "text"]
    columns = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
    path = small(conversations=pa.table({**columns, "example": ["x"] * len(rows), "piece": [1] * len(rows)}))
    planted = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = []
    for conv, turns in plain(rows + planted).items():
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        loss = "".join(t for r, t in turns if r == "assistant")
        ends, at = [], 0
        for i, t in enumerate(turns):
            at += len(piece(*t))
            if t[0] == "assistant" or i == len(turns) - 1:
                ends.append(at)
        want.append((conv, len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(ends)))
    got = sorted((tuple(r) for r in QUERIES[NAME](spark, path).collect()), key=repr)
    assert got == sorted(want, key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet')")
    assert got == sorted(con.execute(ORACLES[NAME]).fetchall(), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "ROLE]", "INST]", "x", "</s>", "\n"]), max_size=8).map("".join),
                min_size=1, max_size=40))
def test_escaping_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat_format.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not re.search(r"</?s>|\[/?(ROLE|INST)\]", r["e"])


def test_turns_are_read_back(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("user", x) for x in ODD] + [(x, "assistant") for x in ODD])]
    last = chat_format.examples(spark.createDataFrame(rows, SCHEMA)).where("last")
    turns = last.select(chat_format.parse_turns(F.col("text")).alias("t")).first()["t"]
    assert [tuple(t) for t in turns] == [(r, t) for _, _, r, t in rows]


def test_empty_table(spark, small):
    path = small(conversations=pa.table({"conv_id": pa.array([], pa.int64()), "turn": pa.array([], pa.int64()),
                                         "role": pa.array([], pa.string()), "text": pa.array([], pa.string())}))
    (row,) = QUERIES[NAME](spark, path).collect()
    assert row["conv_id"] == -1 and row["n_turns"] == 2


def test_one_shuffle_and_no_python(spark):
    plan = QUERIES[NAME](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("missing", ["text", "role"])
def test_whole_column_null(spark, missing):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA).withColumn(missing, F.lit(None).cast("string"))
    (row,) = chat_format.digests(chat_format.examples(df)).collect()
    assert row["n_turns"] == 2

"""The significant-digit rounding gives the same bits in Spark and DuckDB."""

import random

import duckdb
from pyspark.sql import functions as F

from lodestar.functions.numeric import sig_round, sql_sig_round


def test_sig_round_matches_duckdb(spark):
    rnd = random.Random(7)
    vals = [0.0, 1.0, -1.0, 123456.789, -0.000123456789]
    vals += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-8, 12) for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r["i"]: r["r"] for r in df.select("i", sig_round("v", 9).alias("r")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = dict(con.execute(f"SELECT i, {sql_sig_round('v', 9)} FROM t").fetchall())
    diff = [(i, vals[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert diff == []

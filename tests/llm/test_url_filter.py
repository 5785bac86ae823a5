import random
import re

import duckdb
import pyarrow as pa
import pytest

from lodestar.llm import url_filter
from lodestar.llm.queries import ORACLES, QUERIES

NAME = "op7_bloom_url_filter"


def table(urls):
    return pa.table({"page_id": pa.array(range(len(urls)), pa.int64()), "url": pa.array(urls, pa.string()),
                     "rule": pa.array(["x"] * len(urls)), "canonical": pa.array([1] * len(urls))})


def sample():
    rnd = random.Random(4)
    hosts = ["a.example.net", "example.net", "EXAMPLE.com", "m.example.com", "x.org", "org", "net", "xnet", "notexample.net",
             "spam-farm.example.org", "www.spam-farm.example.org", "free-bets.example.com:443", "u@free-bets.example.com",
             "example.com:80", "casino-win.io", ""]
    paths = ["", "/", "/en/1", "/EN/1", "/de/7/", "/fr/x.html", "/en", "/es/9//"]
    tails = ["", "?b=2&a=1", "?utm_source=f", "?utm_x", "#top", "?a=1&utm_m=2&b=2#x", "?", "?&&", "?q=http://other.net/en/"]
    urls = [rnd.choice(["http://", "https://", "ftp://"]) + h + p + t for h in hosts for p in paths for t in tails]
    return urls + [None, "", "no scheme", "://net/x", "x://y\n.net/a\nb?c", "//net/", "HTTP://A.ORG/fr/", urls[3], urls[3],
                   "http://a.org/" + "x" * 50000]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, verdict


def test_against_duckdb_and_plain_python(spark, small):
    path = small(pages=table(sample()))
    got = sorted((tuple(r) for r in QUERIES[NAME](spark, path).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/pages.parquet')")
    cursor = con.execute(ORACLES[NAME])
    assert [d[0] for d in cursor.description] == QUERIES[NAME](spark, path).columns
    assert got == sorted(cursor.fetchall())
    for page_id, host, p, rule, verdict in got:
        want = expected(sample()[page_id])
        assert (host, p, rule) == want[:3]
        assert verdict == want[3] or want[3] is None


@pytest.mark.parametrize("bits", [0.01, 3, 12])
def test_false_positives_are_removed_and_no_listed_url_is_missed(spark, bits):
    urls = [f"https://h{i % 7}.io/p/{i}?x={i}" for i in range(3000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = pages.where("page_id % 5 = 0").select(url_filter.canonical(pages.url).alias("canonical"))
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, listed, (), bits).collect()}
    assert got == {i: "block" if i % 5 == 0 else "allow" for i in range(3000)}


def test_filter_rejects_most_other_urls(spark):
    urls = spark.range(20000).selectExpr("concat('h/', id) AS canonical", "id % 2 = 0 AS listed")
    blocks = 10000 * url_filter.BITS_PER_URL // 512 + 1
    bloom = url_filter.bloom_filter(urls.where("listed"), blocks)
    found = urls.withColumn("block", url_filter._block(urls.canonical, blocks)).join(bloom, "block", "left")
    rows = found.select("listed", url_filter.passes(found.words, found.canonical).alias("p")).groupBy("listed", "p").count()
    n = {(r["listed"], r["p"]): r["count"] for r in rows.collect()}
    assert n.get((True, False), 0) == 0 and n.get((False, True), 0) < 300


def test_empty_tables(spark, small):
    assert QUERIES[NAME](spark, small(pages=table([]))).collect() == []

import duckdb
import pytest
from pyspark.sql import functions as F

from fintide.llm import oracles, queries
from fintide.llm import url_filter as U


def duck(sf, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op1_url_filter(spark, sf)
    want = duck(sf, "pages").execute(oracles.OP1)
    cols = [d[0] for d in want.description]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key)
    b = sorted(want.fetchall(), key=key)
    assert a == b and sum(r[cols.index("listed")] for r in a) > 10


URLS = [None, "", "no scheme", "http://", "https://Example.ORG/en/1x?q#f", "http://a.example.org/es/", "http://a.example.org/es",
        "https://org", "https://x.org?y", "http://notorg/", "http://com/fr/", "http://B.com/de/x://y", "ftp://h.net:80/p//",
        "http://www.h.net/p?utm_a=1&utm_b=2&c=3&utm_d=4#z", "http://h.net/p?c=3", "x://y://z", "http://É.com/FR/", "http://h/\n#a\nb"]


def test_edges(spark):
    pages = spark.createDataFrame([(i, u, "keep", "mine") for i, u in enumerate(URLS + URLS[:4])],
                                  "page_id long, url string, extra string, verdict string")
    listed = spark.createDataFrame([("h.net/p?c=3",), ("h.net/p?c=3",), (None,), ("org",), ("gone",)], "canonical string")
    rows = {}
    for r in U.judge(pages, listed).collect():
        assert r.extra == "keep"
        rows.setdefault(r.page_id % len(URLS), []).append((r.host, r.path, r.rule, r.verdict))
    assert [rows[i][0] for i in range(len(URLS))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("example.org", "/en/1x", "example.org/en/1", "block"), ("a.example.org", "/es/", "example.org/es/", "block"),
        ("a.example.org", "/es", "org/", "allow"), ("org", "", None, "block"), ("x.org", "", None, "allow"), ("notorg", "/", None, "allow"),
        ("com", "/fr/", "com/fr/", "allow"), ("b.com", "/de/x://y", "com/de/", "block"), ("h.net:80", "/p//", None, "allow"),
        ("www.h.net", "/p", None, "block"), ("h.net", "/p", None, "block"), ("y:", "//z", None, "allow"), ("É.com", "/FR/", None, "allow"),
        ("h", "/\n", None, "allow")]
    assert all(len(set(v)) == 1 for v in rows.values()) and sum(map(len, rows.values())) == len(URLS) + 4
    assert U.judge(pages.limit(0), listed).count() == 0
    assert U.judge(pages, listed.limit(0)).filter("listed").count() == 0


@pytest.mark.parametrize("broadcast", [8 << 20, 0])
def test_filter_has_no_false_negatives_and_few_positives(spark, monkeypatch, broadcast):
    monkeypatch.setattr(U, "BROADCAST_BYTES", broadcast)
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("c"))
    rows = spark.range(20_000).select("id", F.concat(F.lit("h/"), "id").alias("u"))
    got = U.possible(rows, "u", listed, "c").groupBy((F.col("id") < 5000).alias("on")).agg(
        F.avg(F.col("_possible").cast("int")).alias("p"), F.count("*").alias("n")).collect()
    share = {r.on: (r.p, r.n) for r in got}
    assert share[True] == (1.0, 5000) and share[False][1] == 15_000 and share[False][0] < 0.02

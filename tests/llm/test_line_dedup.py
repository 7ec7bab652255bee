import collections

from fintide.llm import line_dedup as L
from fintide.llm import oracles, queries
from test_url_filter import duck


def brute(rows, ratio, least):
    pages, on = collections.defaultdict(set), collections.defaultdict(set)
    for host, text in rows:
        pages[host].add(text)
        for line in (text or "").split("\n") if text is not None else []:
            bare = line.strip(" \t\n\x0b\x0c\r")
            if bare:
                on[host, bare].add(text)
    bad = {(h, x) for (h, x), t in on.items() if len(t) >= least and len(t) > ratio * len(pages[h])}

    def clean(host, text):
        if text is None:
            return None
        return "\n".join(x for x in text.split("\n") if (host, x.strip(" \t\n\x0b\x0c\r")) not in bad)

    return [clean(h, t) for h, t in rows]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], brute([(r.source, r.text) for r in rows], L.MAX_RATIO, L.MIN_PAGES)))
    out = L.drop_boilerplate(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == want and any(want[r.doc_id] != r.text for r in rows)


EDGES = [
    ("a", "menu\nown 1"), ("a", " menu \nown 2"), ("a", "menu\n\nown 3"), ("a", "own 4"), ("a", None), ("a", ""),
    ("b", "menu"), ("b", "menu\nx"), (None, "foot\n1"), (None, "foot\n2"), (None, "foot\t\n3"), (None, "foot\n3"),
    ("copies", "same\ntext"), ("copies", "same\ntext"), ("copies", "same\ntext"), ("copies", "same\ntext"), ("copies", "other"),
    ("long", "l\n" * 50_000), ("long", "l\nk"), ("long", "l"),
]


def test_edges(spark):
    docs = spark.createDataFrame([(i, h, t, 7, "x") for i, (h, t) in enumerate(EDGES)],
                                 "doc_id long, source string, text string, line long, host string")
    want = brute(EDGES, 0.4, 3)
    out = L.drop_boilerplate(docs, max_ratio=0.4)
    assert out.columns == docs.columns
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == want and {(r.line, r.host) for r in rows} == {(7, "x")}
    counted = L.drop_boilerplate(docs, max_ratio=0.4, counts=True).collect()
    for r in counted:
        n = 0 if EDGES[r.doc_id][1] is None else EDGES[r.doc_id][1].count("\n") + 1
        assert r.n_lines == n
        if r.text:
            assert r.n_lines - r.n_dropped == r.text.count("\n") + 1
    assert L.drop_boilerplate(docs.limit(0)).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.1"
    want = duck(sf, "documents").execute(oracles.OP6)
    cols = [d[0] for d in want.description]
    got = sorted(tuple(r[c] for c in cols) for r in queries.op6_line_dedup(spark, sf).collect())
    assert got == sorted(want.fetchall()) and any(r[cols.index("n_dropped")] for r in got)

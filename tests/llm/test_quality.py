import collections
import re

import pytest
from pyspark.sql import functions as F

from fintide.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    words = WORD.findall(t)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_base_counts_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = Q.judge(docs, Q.trusted(labels)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert tuple(r[c] for c in COLUMNS) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    quality = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    clean = [r for r in rows if quality.get(r.doc_id) == (1, 0) and not r.base_failed]
    junk = [r for r in rows if quality.get(r.doc_id, (None,))[0] == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(r.kept for r in junk) <= 0.1 * len(junk)


def test_verdict_on_rows_that_were_not_trusted(spark):
    """Held-out: the even labels fit the target, the odd ones are judged."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.judge(docs, Q.trusted(labels.filter("doc_id % 2 = 0"))).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    got = rows.filter("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    kept = {r.quality: r.k for r in got}
    assert kept[1] > 0.9 and kept[0] < 0.2


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b c d e a b c d e"), (5, "x " * 12), (6, "a b c d e f g h i j"),
    (7, "l\nl\n\nl \n"), (8, "#*$%&|<> #"), (None, "é ü ß " * 20), (9, "w" * 100_000), (9, "w" * 100_000),
    (10, " ".join(f"w{i}" for i in range(30_000)) + " " + " ".join(f"w{i}" for i in range(9_000))),
]


def test_edges_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "mine", 5) for i, t in EDGES], "doc_id long, text string, n_words string, extra int")
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = Q.judge(docs, Q.trusted(labels)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows), key=key)
    assert got == sorted(((i, *base(t)) for i, t in EDGES), key=key)
    assert all(r.extra == 5 for r in rows)
    kept = Q.quality_filter(docs, labels)
    assert kept.columns == docs.columns and all(r.n_words == "mine" for r in kept.collect())


@pytest.mark.parametrize("empty", ["docs", "labels"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    if empty == "docs":
        assert Q.judge(docs.limit(0), Q.trusted(labels)).count() == 0
    else:
        r = Q.judge(docs, Q.trusted(labels.limit(0))).head()
        assert r.kept and r.llr_score == 0.0


def test_score_against_brute_force(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 40))) for i in range(1, 12)],
                                 "doc_id long, text string")
    good = spark.createDataFrame([(3,), (4,), (5,)], "doc_id long")
    hashed = docs.select("doc_id", Q.hashed_words(F.split("text", " ")).alias("h"))
    pairs = {r.doc_id: [x % Q.BUCKETS for x in r.h + r.p] for r in
             hashed.select("doc_id", "h", Q.chained(F.col("h"), 1).alias("p")).collect()}
    import math

    raw = collections.Counter(b for g in pairs.values() for b in g)
    target = collections.Counter(b for i in (3, 4, 5) for b in pairs[i])
    share = sum(target.values()) / sum(raw.values())
    w = {b: math.log((target[b] + Q.PRIOR_COUNT) / (raw[b] * share + Q.PRIOR_COUNT)) for b in raw}
    for r in Q.judge(docs, good).collect():
        g = pairs[r.doc_id]
        assert r.llr_score == pytest.approx(sum(w[b] for b in g) / (len(g) + Q.PRIOR_GRAMS), abs=1e-5)

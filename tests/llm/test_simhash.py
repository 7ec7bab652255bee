import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fintide.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids):
    x = np.array(prints, dtype=np.uint64)
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 2) + i + 1:
            a, b = find(i), find(int(j))
            if a != b:
                root[b] = a
    groups = {}
    for i in range(len(x)):
        groups.setdefault(find(i), []).append(ids[i])
    low = {r: min((v for v in g if v is not None), default=None) for r, g in groups.items()}
    return [low[find(i)] for i in range(len(x))]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip(prints, brute_components(prints, [r.doc_id for r in rows]))))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in S.components(docs).collect()}
    assert got == want


def test_native_hash_is_the_same(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("das ist ü")).alias("h")).head()
    assert r.h % (1 << 64) == xxhash.xxh64_intdigest("das ist ü".encode(), 42)


def random_prints(seed, n, hot):
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(n)]
    out = []
    for _ in range(hot):  # one dense family: halves are shared by many different fingerprints
        x = bases[0]
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(32, 64)
        out.append(x)
    for b in bases:
        for _ in range(3):
            x = b
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("seed,limit", [(1, 32), (2, 2), (3, 1)])
def test_links_with_crowded_buckets(spark, seed, limit):
    prints = random_prints(seed, 60, 150)
    signed = [int(np.uint64(x).view(np.int64)) for x in prints]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = S.links(nodes, max_bucket=limit)
    for r in edges.collect():
        assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 2
    label = {r.node: r.root for r in S.connected(edges).collect()}
    want = brute_components(prints, signed)
    got = [label.get(x, x) for x in signed]
    # Same partition: roots are smallest members.
    assert got == want


def test_connected_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    label = {r.node: r.root for r in S.connected(edges).collect()}
    assert all(label[i] == 0 for i in range(n + 1)) and label[1000] == label[1001] == 1000


def test_edges(spark):
    rows = [(5, None), (4, ""), (6, " \n"), (7, "One two"), (8, "one  TWO"), (None, "one two"), (9, "É x y z"), (9, "É x y z"),
            (10, "é x y z"), (11, "w " * 50_000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fp % (1 << 64), r.component_id) for r in S.components(docs).collect())
    prints = [brute_print(t) for _, t in rows]
    want = brute_components(prints, [i for i, _ in rows])
    assert got == sorted((i if i is not None else -1, p, c) for (i, _), p, c in zip(rows, prints, want))
    kept = S.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in want})
    assert S.components(docs.limit(0)).count() == 0 and S.near_dedup(docs.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [r.component_id for r in S.components(alone).collect()] == [None, None]
    assert S.near_dedup(alone).count() == 1

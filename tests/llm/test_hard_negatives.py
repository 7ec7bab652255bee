import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fintide.llm import hard_negatives as H


def brute(rows, is_anchor, positives=5, negatives=10, band=(30, 90)):
    rows, out = sorted(set(rows)), []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        others = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in rows if b != a)
        for s, pid, _ in [o for o in others if o[2] == a[1]][:positives]:
            near = [o for o in others if o[2] != a[1] and band[0] * -s <= 100 * -o[0] <= band[1] * -s][:negatives]
            out += [(a[0], pid, i, n[1], -s, -n[0]) for i, n in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, schema="vec_id long, label int, v array<double>", anchors="id % 5 = 0", **args):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id"), F.col("label"), F.col("v"), F.expr(anchors), **args).collect())


@pytest.mark.parametrize("bound,depth", [(3, 4), (900, 70), (2_000_000, 6), (500_000_000, 5)])
def test_against_brute_force(spark, bound, depth):
    rnd = random.Random(bound)
    rows = [(i, rnd.randint(0, 3), tuple(float(rnd.randint(-bound, bound) // 2 + (bound if j == 0 else 0)) for j in range(depth))) for i in range(120)]
    rows += rows[:4] + [(7, 1, rows[0][2]), (1000, 0, (0.0,) * depth)]  # repeated rows, a second row of an id, a zero vector
    want = brute([(i, l, tuple(int(x) for x in v)) for i, l, v in rows], lambda i: i % 5 == 0)
    assert len(want) > 100 and mined(spark, rows) == want
    assert mined(spark, rows, block_rows=16, block_anchors=4) == want


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high, depth in ((-150, 150, 64), (-(2**27), 2**27, 600), (-5, 5, 1), (-251, 251, 257)):
        a, b = rng.integers(low, high + 1, (7, depth)), rng.integers(low, high + 1, (9, depth))
        a[0], b[0], b[1] = high, high, low  # the largest sums of both signs
        primes = H.primes_for(max(1, depth * high * high))
        got = H.product([H.residues(a.astype(np.int32), p) for p in primes], [H.residues(b.astype(np.int32), p) for p in primes], primes)
        assert (got == a.astype(np.int64) @ b.astype(np.int64).T).all()
    assert len(H.primes_for(2**62)) <= len(H.PRIMES) and max(H.PRIMES) ** 2 / 4 * H.DEPTH < 2**24


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, 0, (10.0, 0.0)) for i in range(20)] + [(100 + i, 1, (5.0, float(i % 2))) for i in range(30)]
    got = mined(spark, rows, anchors="id = 10", block_rows=8)
    assert [r[1:4] for r in got if r[1] == 0] == [(0, i + 1, 100 + i) for i in range(10)]
    assert {r[1] for r in got} == {0, 1, 2, 3, 4}


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 0, [4.0, 1.0]), (1, 0, [4.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 1, [-4.0, 1.0])]
    bad = [(4, None, [4.0, 1.0]), (5, 0, None), (6, 1, [2.0, None]), (7, 1, [nan, 2.0]), (8, 0, [inf, 1.0]), (9, 0, [4.0]),
           (None, 1, [2.0, 0.0]), (11, 1, [2.0**31, 0.0]), (12, 0, [])]
    assert mined(spark, good + bad, anchors="id = 0") == [(0, 1, 1, 2, 16, 8)]
    assert mined(spark, [], anchors="id = 0") == []
    assert mined(spark, bad, anchors="id = 0") == []


def test_floor_and_clashing_columns(spark):
    df = spark.createDataFrame([(x,) for x in (1.5, -1.5, 1e300, float("inf"), None)], "x double").select(H.floored(F.col("x")).alias("f"))
    assert [r.f for r in df.collect()] == [1.0, -2.0, 1e300, float("inf"), None]
    rows = [(0, 0, [4.0], 1, "k"), (1, 0, [4.0], 2, "k"), (2, 1, [2.0], 3, "k")]
    got = mined(spark, rows, "vec_id long, label int, v array<double>, id int, key string", anchors="id = 0")
    assert got == [(0, 1, 1, 2, 16, 8)]

import datetime as dt
import decimal
import itertools
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fintide import config as C
from fintide.operators.scoring import (cache_fills, cache_hits, cache_lookup, encode_requests, hit_rate, request_key,
                                       split_valid, validate_requests)
from fintide.functions.columns import feature_vector, plain_number
from fintide.operators.sampling import expand_allocation

BASE = ("CLT001", 85.0, 10.0, 5.0, 5, 3.0, 85.0, "Young")


def _req(spark, rows):
    return spark.createDataFrame(rows, C.SCORE_REQUEST_SCHEMA)


def test_validation_rejects_like_the_service(spark):
    rows = [BASE, ("C2", 150.0, 10.0, 5.0, 5, 3.0, 85.0, "Young"), ("C3", 85.0, 10.0, 5.0, 5, 3.0, 85.0, "Baby"),
            ("C4", 85.0, None, None, None, None, None, None), ("C5", 85.0, 10.0, 5.0, 0, 3.0, -1.0, "Senior")]
    valid, rejected = split_valid(_req(spark, rows))
    assert [r.client_id for r in valid.collect()] == ["CLT001"]
    reasons = {r.client_id: r.reasons for r in rejected.collect()}
    assert reasons["C2"] == ["equity_pct: out of range"]
    assert reasons["C3"] == ["age_group: must be one of Young/Middle-Aged/Senior"]
    assert len(reasons["C4"]) == 6 and all(x.endswith("required") for x in reasons["C4"])
    assert set(reasons["C5"]) == {"total_num_funds: out of range", "aum_lakh: out of range"}
    assert valid.count() + rejected.count() == len(rows)


def test_encode_features(spark):
    df = encode_requests(validate_requests(_req(spark, [BASE])))
    vec = df.select(feature_vector().alias("v")).first().v
    assert len(vec) == 7 and vec[0] == 85.0 and vec[6] == 0.0


def test_cache_key_deterministic(spark):
    df = _req(spark, [BASE, BASE]).withColumn("k", request_key())
    k1, k2 = [r.k for r in df.collect()]
    assert k1 == k2 and "CLT001" in k1 and k1.startswith("portfolio:risk:")
    import hashlib
    assert k1.endswith(hashlib.md5(b"85.0_10.0_5.0_5_3.0_85.0_Young").hexdigest())


def _events(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, k, t0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, k string, ts timestamp_ntz")


def _fold(rows, ttl):
    expiry, out = {}, {}
    for i, (k, s) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        hit = k in expiry and s < expiry[k]
        if not hit:
            expiry[k] = s + ttl
        out[i] = hit
    return out


def test_ttl_fold_golden(spark):
    secs = [0, 10, 3599, 3600, 3700, 7300]
    df = _events(spark, [("a", s) for s in secs])
    got = [r.from_cache for r in cache_hits(df, "k", "ts", "event_id", 3600).orderBy("event_id").collect()]
    assert got == [False, True, True, False, True, False]


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_ttl_fold_matches_sequential_with_hot_key(spark, seed):
    rnd = random.Random(seed)
    rows = [("hot", rnd.randint(0, 50_000)) for _ in range(300)]
    rows += [(f"k{rnd.randint(0, 5)}", rnd.randint(0, 50_000)) for _ in range(100)]
    df = _events(spark, rows)
    got = {r.event_id: r.from_cache for r in cache_hits(df, "k", "ts", "event_id", 600).collect()}
    assert got == _fold(rows, 600)


def test_hit_rate(spark):
    df = spark.createDataFrame([(True,), (True,), (False,), (True,)], "from_cache boolean")
    r = hit_rate(df).first()
    assert (r.requests, r.hits, r.misses, r.hit_rate) == (4, 3, 1, 0.75)


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_ttl_fold_with_other_slices(spark, seed):
    # Results must not depend on the width of the slices.
    rnd = random.Random(seed)
    rows = [("hot", rnd.randint(0, 3_000)) for _ in range(200)] + [("k1", rnd.randint(0, 20_000)) for _ in range(40)]
    df = _events(spark, rows)
    got = {r.event_id: r.from_cache for r in cache_hits(df, "k", "ts", "event_id", 600, slice_ttls=rnd.choice([1, 3, 50])).collect()}
    assert got == _fold(rows, 600)


def test_ttl_fold_of_a_long_hot_key(spark):
    # One key of 200,000 requests, with quiet stretches; a run of misses spans thousands of slices.
    rnd = random.Random(8)
    gaps = [rnd.choice([0, 1, 1, 2, 5, 30, 61]) if i % 5000 else 500 for i in range(200_000)]
    secs = list(itertools.accumulate(gaps))
    df = spark.createDataFrame(pd.DataFrame({"event_id": range(len(secs)), "s": secs})).select(
        "event_id", F.lit("hot").alias("k"), F.timestamp_micros(F.col("s") * 1_000_000).alias("ts"))
    got = cache_fills(df, "k", "ts", "event_id", 60).select("event_id", "from_cache", "filled_us").toPandas().sort_values("event_id")
    expiry, hits, fills = None, [], []
    for s in secs:
        hit = expiry is not None and s < expiry
        expiry = expiry if hit else s + 60
        hits.append(hit)
        fills.append((expiry - 60) * 1_000_000)
    assert got["from_cache"].tolist() == hits and got["filled_us"].tolist() == fills and hits.count(False) > 15_000


def test_ttl_entries_carry_over(spark):
    rows = [("a", 0), ("a", 4000), ("b", 4000), (None, 4100), (None, 4200)]
    df = _events(spark, rows).unionByName(spark.createDataFrame([(9, "a", None)], "event_id long, k string, ts timestamp_ntz"))
    t0 = 1_704_067_200_000_000
    entries = spark.createDataFrame([("a", t0 + 10 * 10**6), ("c", t0)], "k string, expiry_us long")
    got = {r.event_id: (r.from_cache, r.filled_us and (r.filled_us - t0) // 10**6) for r in
           cache_fills(df, "k", "ts", "event_id", 3600, entries).collect()}
    assert got == {0: (True, -3590), 1: (False, 4000), 2: (False, 4000), 3: (False, 4100), 4: (True, 4100), 9: (False, None)}
    assert [r.from_cache for r in cache_hits(df, "k", "ts", "event_id", 0).collect()] == [False] * 6


def test_store_with_one_row_per_key_is_a_plain_join(spark):
    reqs = _events(spark, [("a", 0), ("a", 100), ("a", 5000), ("b", 10)])
    store = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 1), "x")], "k string, at timestamp_ntz, v string")
    plain = cache_lookup(reqs, store, "k", "ts", "at", ["v"], 3600, one_per_key=True)
    asof = cache_lookup(reqs, store, "k", "ts", "at", ["v"], 3600)
    assert sorted(plain.select(asof.columns).collect(), key=str) == sorted(asof.collect(), key=str)
    assert {r.event_id: (r.v, r.from_cache) for r in plain.collect()} == {0: (None, False), 1: ("x", True), 2: ("x", False), 3: (None, False)}
    assert "Window" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_key_text_keeps_every_digit_and_never_fails(spark):
    values = [1e30, -1e30, 25.00000000001, 25.00000000002, 85.0, 1e7, 12345678.9, 0.00025, 1.5e-10, -2.5e-7, 0.0, 1e16, 1.7976931348623157e308, 100.1]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", plain_number("v").alias("t"))
    for r in df.collect():
        assert "E" not in r.t and "." in r.t and float(r.t) == r.v
        assert r.t.lstrip("-") == format(decimal.Decimal(repr(abs(r.v))), "f") or "." not in format(decimal.Decimal(repr(abs(r.v))), "f")
    texts = {r.v: r.t for r in df.collect()}
    assert texts[25.00000000001] != texts[25.00000000002] and texts[1e7] == "10000000.0" and texts[85.0] == "85.0"
    rows = [("C", 85.0, 10.0, 5.0, 5, 3.0, 1e30, "Young")]
    out = validate_requests(_req(spark, rows)).withColumn("k", request_key()).head()
    assert out.is_valid and out.k.startswith("portfolio:risk:C:")


def test_nan_is_rejected_in_every_numeric_field(spark):
    nan = float("nan")
    rows = [("A", nan, 10.0, 5.0, 5, 3.0, 85.0, "Young"), ("B", 85.0, nan, 5.0, 5, 3.0, 85.0, "Young"),
            ("C", 85.0, 10.0, nan, 5, 3.0, 85.0, "Young"), ("D", 85.0, 10.0, 5.0, 5, nan, 85.0, "Young"),
            ("E", 85.0, 10.0, 5.0, 5, 3.0, nan, "Young")]
    got = {r.client_id: r.reasons for r in validate_requests(_req(spark, rows)).collect()}
    fields = ["equity_pct", "debt_pct", "gold_pct", "years_invested", "aum_lakh"]
    assert got == {c: [f"{f}: out of range"] for c, f in zip("ABCDE", fields)}


def test_unknown_profile_draws_from_the_fallback_pool(spark):
    df = spark.createDataFrame([(f"c{i}", p) for i in range(40) for p in ("Balanced", None, "Aggressive")],
                               "client_id string, risk_profile string")
    got = {}
    for r in expand_allocation(df).collect():
        got.setdefault((r.client_id, r.slot), set()).add(r.fund_type)
    assert all(len(kinds) == 1 and None not in kinds for kinds in got.values())


def test_training_and_requests_share_one_feature_table(spark, monkeypatch):
    from fintide.plans import q_scoring as Q
    from fintide.plans import views as V

    made, features = [], V.features
    monkeypatch.setattr(V, "features", lambda *a: made.append(1) or features(*a))
    monkeypatch.setattr(Q.ML, "fit_risk_model", lambda train: None)
    monkeypatch.setattr(Q.S, "score_requests", lambda model, valid: valid)
    assert Q.score_requests(spark, SF_SMALL).count() > 0 and len(made) == 1

import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fintide.operators.timeseries import asof_join, depth_bounds, depth_chunk, lag_chunked, value_holdings, weekdays_only


def _dates(rnd, n, span=400):
    d0 = dt.date(2020, 1, 1)
    return [d0 + dt.timedelta(days=rnd.randint(0, span)) for _ in range(n)]


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_asof_join_matches_merge_asof(spark, seed):
    rnd = random.Random(seed)
    funds = ["A", "B", "C"]
    right = {(f, d): rnd.random() for f in funds for d in _dates(rnd, 40)}
    rrows = [(f, d, v) for (f, d), v in right.items()]
    lrows = [(i, rnd.choice(funds + ["Z"]), d) for i, d in enumerate(_dates(rnd, 120, span=460))]
    left = spark.createDataFrame(lrows, "id long, fund string, d date")
    r = spark.createDataFrame(rrows, "fund string, nav_date date, nav double")
    got = {row.id: (row.nav_date, row.nav) for row in asof_join(left, r, ["fund"], "d", "nav_date", ["nav"]).collect()}
    lp = pd.DataFrame(lrows, columns=["id", "fund", "d"]).assign(d=lambda x: pd.to_datetime(x.d)).sort_values("d")
    rp = pd.DataFrame(rrows, columns=["fund", "nav_date", "nav"]).assign(
        nav_date=lambda x: pd.to_datetime(x.nav_date)).sort_values("nav_date")
    m = pd.merge_asof(lp, rp, left_on="d", right_on="nav_date", by="fund", direction="backward")
    want = {int(row.id): (None if pd.isna(row.nav_date) else row.nav_date.date(),
                          None if pd.isna(row.nav) else row.nav) for row in m.itertuples()}
    assert got == want


def test_lag_chunked_equals_plain_lag(spark):
    rnd = random.Random(7)
    rows = [(f, d, rnd.random()) for f in ["A", "B"] for d in sorted(set(_dates(rnd, 200, 900)))]
    df = spark.createDataFrame(rows, "fund string, d date, v double")
    got = lag_chunked(df, ["fund"], "d", ["v"])
    w = Window.partitionBy("fund").orderBy("d")
    want = df.withColumns({"prev_d": F.lag("d").over(w), "prev_v": F.lag("v").over(w)})
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count()


def test_weekdays_only(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "nav_date date")
    assert [r.nav_date.weekday() for r in weekdays_only(df).collect()] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("chunk", ["day", "week", "year", "month", "depth"])
def test_results_do_not_depend_on_the_chunk(spark, chunk):
    rnd = random.Random(11)
    rrows = sorted({("A", d): rnd.random() for d in _dates(rnd, 120, 200)}.items())
    rrows = [(f, d, v) for (f, d), v in rrows]
    lrows = [(i, "A", d) for i, d in enumerate(_dates(rnd, 150, 230))]
    left = spark.createDataFrame(lrows, "id long, fund string, d date")
    r = spark.createDataFrame(rrows, "fund string, nav_date date, nav double")
    small = asof_join(left, r, ["fund"], "d", "nav_date", ["nav"], chunk=chunk)
    big = asof_join(left, r, ["fund"], "d", "nav_date", ["nav"])
    assert small.count() == len(lrows)
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0
    df = spark.createDataFrame(rrows, "fund string, d date, v double")
    w = Window.partitionBy("fund").orderBy("d")
    want = df.withColumns({"prev_d": F.lag("d").over(w), "prev_v": F.lag("v").over(w)})
    got = lag_chunked(df, ["fund"], "d", ["v"], chunk=chunk)
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_ties_in_time_are_ordered_by_value(spark):
    day = dt.date(2024, 1, 2)
    right = spark.createDataFrame([("A", day, 1.0), ("A", day, 3.0), ("A", day, 2.0)], "fund string, nav_date date, nav double")
    left = spark.createDataFrame([(1, "A", day), (2, "A", day + dt.timedelta(days=90))], "id long, fund string, d date")
    got = asof_join(left, right.repartition(3), ["fund"], "d", "nav_date", ["nav"]).collect()
    assert [r.nav for r in got] == [3.0, 3.0]
    lagged = lag_chunked(right.repartition(3), ["fund"], "nav_date", ["nav"]).orderBy("nav").collect()
    assert [r.prev_nav for r in lagged] == [None, 1.0, 2.0]


def test_valuation_windows_only_distinct_pairs(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    nav = spark.createDataFrame([("A", d, float(i)) for i, d in enumerate(days[::3])], "fund_name string, nav_date date, nav double")
    held = spark.createDataFrame([(i, "A", 2.0, days[i % 40]) for i in range(200)] + [(900, None, 1.0, days[0]), (901, "A", 1.0, None)],
                                 "id long, fund_name string, units double, buy_date date")
    out = {r.id: r for r in value_holdings(held, nav, days[-1]).collect()}
    assert len(out) == 202 and out[900].nav_at_buy is None and out[901].nav_at_buy is None
    assert all(out[i].nav_at_buy == (i % 40) // 3 for i in range(200))


def test_one_key_within_a_day_is_spread_over_tasks(spark):
    left = spark.range(200_000).select("id", F.lit("HOT").alias("k"), F.timestamp_micros(F.lit(1_709_251_200_000_000) + F.col("id") * 400_000).alias("t"))
    right = spark.range(2_000).select(F.lit("HOT").alias("k"), F.timestamp_micros(F.lit(1_709_251_200_000_000) + F.col("id") * 43_000_000).alias("at"),
                                      F.col("id").cast("double").alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        instants = left.select("k", F.col("t").alias("_t"))
        bounds = depth_bounds(instants, "_t")
        dealt = instants.withColumn("c", depth_chunk(bounds, "_t")).repartition("k", "c").groupBy(F.spark_partition_id()).count().collect()
        assert len(bounds) > 200 and len(dealt) == 16 and max(r["count"] for r in dealt) < 200_000 / 5
        got = asof_join(left, right, ["k"], "t", "at", ["v"])
        wrong = got.filter(F.col("v") != F.floor(F.col("id") * 400_000 / 43_000_000)).count()
        assert wrong == 0 and got.count() == 200_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_many_rows_at_one_instant_and_nulls(spark):
    day = dt.date(2024, 1, 2)
    left = spark.createDataFrame([(i, "A", day) for i in range(500)] + [(900, None, day), (901, "A", None), (902, "A", dt.date(2023, 1, 1))],
                                 "id long, fund string, d date")
    right = spark.createDataFrame([("A", day, 1.0, "x"), ("A", day, 2.0, "a"), (None, day, 9.0, "z"), ("A", None, 8.0, "y")],
                                  "fund string, nav_date date, nav double, note string")
    got = {r.id: (r.nav_date, r.nav, r.note) for r in asof_join(left, right, ["fund"], "d", "nav_date", ["nav", "note"]).collect()}
    assert len(got) == 503 and all(got[i] == (day, 2.0, "a") for i in range(500))
    assert got[900] == got[901] == got[902] == (None, None, None)
    empty = asof_join(left, right.limit(0), ["fund"], "d", "nav_date", ["nav"])
    assert empty.count() == 503 and empty.filter("nav IS NOT NULL").count() == 0
    assert asof_join(left.limit(0), right, ["fund"], "d", "nav_date", ["nav"]).count() == 0

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fintide.functions.columns import hash_hex
from fintide.operators.features import (class_weights, exact_medians, impute_median, rank_within, split_quotas,
                                        stratified_split)
from fintide.operators.sampling import sample_n, shuffle


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)), min_size=1, max_size=60))
def test_exact_median_matches_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_medians(df, ["x"])["x"]
    vals = [x for x in xs if x is not None]
    if not vals:
        assert got is None
    else:
        assert got == float(np.median(vals))


def test_impute_all_null_column_falls_back(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    filled, report = impute_median(df, ["a", "b"])
    assert sorted(r.a for r in filled.collect()) == [1.0, 2.0, 3.0]
    assert {r.b for r in filled.collect()} == {0.0}
    rep = {r.column: (r.null_count, r.median) for r in report.collect()}
    assert rep == {"a": (1, 2.0), "b": (3, None)}


def _hashed(spark, n, hot=3):
    """n rows with payload columns; group 'hot' holds all but every ``hot``-th row."""
    return spark.range(n).select(
        F.concat(F.lit("id"), "id").alias("id"), F.when(F.col("id") % hot == 0, F.concat(F.lit("g"), F.col("id") % 7))
        .otherwise("hot").alias("g"), (F.col("id") * 1.5).alias("a"), F.col("id").cast("string").alias("b"),
    ).withColumn("h", hash_hex("id"))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_rank_within_keeps_payload_and_gives_every_rank(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = _hashed(spark, 200_000)
        got = rank_within(df, ["g"], "h", ["id"], "rk")
        want = df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")).cast("long"))
        cols = ["id", "g", "a", "b", "h", "rk"]
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0
        spread = got.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("rk").alias("d"), F.max("rk").alias("m")).collect()
        assert all(r.n == r.d == r.m for r in spread)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_split_counts_with_all_columns_kept(spark):
    df = _hashed(spark, 200_000).withColumn("y", F.when(F.col("id") < "id3", "A").otherwise("B"))
    quota = {r.y: r.n_test for r in split_quotas(df, "y", 0.2).collect()}
    one = stratified_split(df, "id", "y", 0.2, 42)
    assert set(one.columns) == {*df.columns, "split"}
    got = {r.y: r["count"] for r in one.filter("split = 'test'").groupBy("y").count().collect()}
    assert got == quota and one.count() == 200_000
    again = stratified_split(df.repartition(13), "id", "y", 0.2, 42)
    assert one.select("id", "split").exceptAll(again.select("id", "split")).count() == 0


def test_shuffle_and_sample_of_whole_rows(spark):
    df = _hashed(spark, 30_000)
    placed = shuffle(df, "id")
    r = placed.agg(F.count("*").alias("n"), F.countDistinct("position").alias("d"), F.max("position").alias("m")).head()
    assert r.n == r.d == r.m == 30_000
    for n in (0, 1, 777, 30_000, 40_000):
        got = {x.id for x in sample_n(df, "id", n).collect()}
        assert got == {x.id for x in df.orderBy("h", "id").limit(n).collect()}
    assert sample_n(df, "id", 5).columns == df.columns


def test_stratified_split_exact_counts(spark):
    rows = [(f"id{i}", "A" if i % 10 < 2 else ("B" if i % 10 < 5 else "C")) for i in range(997)]
    df = spark.createDataFrame(rows, "id string, y string")
    split = stratified_split(df, "id", "y", 0.2, 42)
    assert split.count() == 997
    assert split.filter("split = 'test'").count() == 200  # ceil(0.2 * 997)
    q = {r.y: r.n_test for r in split_quotas(df, "y", 0.2).collect()}
    got = {r.y: r["count"] for r in split.filter("split = 'test'").groupBy("y").count().collect()}
    assert got == q
    for y, n_test in q.items():
        n = sum(1 for _, c in rows if c == y)
        assert abs(n_test - 0.2 * n) < 1


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] * 1, "y string")
    w = {r.y: r.weight for r in class_weights(df, "y").collect()}
    assert w == {"a": 10 / (3 * 6), "b": 10 / (3 * 3), "c": 10 / (3 * 1)}


def test_exact_median_refines_small_brackets(spark):
    # A coarse sketch forces several rounds; ties and an even count included.
    xs = [float(i % 37) for i in range(2000)] + [1000.0] * 7
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert exact_medians(df, ["x"], accuracy=100)["x"] == float(np.median(xs))
    ys = [float(i) for i in range(1001)]
    df2 = spark.createDataFrame([(y,) for y in ys], "x double")
    assert exact_medians(df2, ["x"], accuracy=100)["x"] == 500.0


def test_exact_median_heavy_ties_terminate(spark):
    # Half zeros, half ones: the two middle ranks sit on the two ends of the bracket.
    xs = [0.0] * 500 + [1.0] * 500
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert exact_medians(df, ["x"], accuracy=100)["x"] == 0.5
    ys = [0.0] * 300 + [1.0] * 400 + [2.0] * 301
    df2 = spark.createDataFrame([(y,) for y in ys], "x double")
    assert exact_medians(df2, ["x"], accuracy=100)["x"] == float(np.median(ys))


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 400), st.integers(0, 400), st.lists(st.floats(0.01, 0.99), max_size=120))
def test_exact_median_with_heavy_end_ties(spark, low, high, middle):
    xs = [0.0] * low + middle + [1.0] * high
    df = spark.createDataFrame([(x, -x, None) for x in xs], "x double, y double, z double")
    got = exact_medians(df, ["x", "y", "z"], accuracy=20)
    assert got == {"x": float(np.median(xs)), "y": float(np.median([-x for x in xs])), "z": None}


def test_integer_columns_are_filled_with_the_true_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n long")
    filled, report = impute_median(df, ["n"])
    assert sorted(r.n for r in filled.collect()) == [1.0, 1.5, 2.0] and report.head().median == 1.5


def test_imputation_computes_its_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def row(i):
        made.add(1)
        return (i, float(i) if i % 3 else None)

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(60), 2).map(row), "id long, x double")
    filled, report = impute_median(df, ["x"])
    assert filled.filter("x IS NULL").count() == 0 and report.first()["null_count"] == 20
    assert made.value == 60

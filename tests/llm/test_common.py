from pyspark.sql import functions as F

from fintide.llm import common


def test_first_by_hash_is_the_head_of_the_order(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    want = [r.k for r in df.orderBy(F.xxhash64(F.lit(3), "k"), "k").collect()]
    for limit in (1, 40, 1000, 4999, 9000):
        assert [r.k for r in common.first_by_hash(df, "k", 5000, limit, 3).collect()] == want[:limit]
    assert common.first_by_hash(df.limit(0), "k", 0, 10).count() == 0


def test_box_and_unbox(spark):
    df = spark.createDataFrame([(1, "x", None)], "a long, _row string, `odd name` string")
    out = common.boxed(df, key=F.col("a") + 1).select(*common.unboxed(df.columns, a=F.col("key")))
    assert out.columns == df.columns and out.collect() == [(2, "x", None)]

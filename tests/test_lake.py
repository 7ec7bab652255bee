import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide.operators import reports
from fintide.session import work_path
from fintide.sources import io
from fintide.sources import merge as M
from fintide.sources import publish as P

from conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.IntegerType()),
                       T.StructField("note", T.StringType())])


@pytest.mark.parametrize("a,b,want", [
    ("int", "long", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "float", "double"),
    ("long", "double", "string"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "long", "decimal(21,2)"),
    ("decimal(38,0)", "decimal(10,5)", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ("map<string,int>", "map<string,double>", "map<string,double>"), ("string", "array<int>", "string")])
def test_wider_types(spark, a, b, want):
    x, y = (T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b))
    assert M.wider(x, y).simpleString() == M.wider(y, x).simpleString() == want


def test_merged_lake_keeps_every_column_and_value(spark):
    path = work_path(spark, "generations")
    write = lambda sql, part: spark.sql(sql).write.mode("append").parquet(f"{path}/year={part}")
    write("SELECT 1 AS id, 'a' AS name, named_struct('x', 1) AS s, array(1, 2) AS l, true AS z", "2020")
    write("SELECT 2147483648L AS ID, 2.5D AS score, named_struct('x', 5000000000L, 'y', 'q') AS s, array(5000000000L) AS l, 7 AS z", "2021")
    write("SELECT 3 AS id, CAST(NULL AS STRUCT<x: INT>) AS s, map('k', 1) AS m", "2021b")
    write("SELECT 4 AS id, 'd' AS name, named_struct('x', 4) AS s, array(4) AS l, false AS z", "2021b")  # the first schema again
    got = {r.id: r.asDict(recursive=True) for r in M.read_merged(spark, path).collect()}
    assert sorted(got) == [1, 3, 4, 2147483648]
    assert got[1] == {"id": 1, "name": "a", "s": {"x": 1, "y": None}, "l": [1, 2], "z": "true", "score": None, "m": None, "year": "2020"}
    assert got[2147483648] | {"id": 0} == {"id": 0, "name": None, "s": {"x": 5000000000, "y": "q"}, "l": [5000000000], "z": "7",
                                           "score": 2.5, "m": None, "year": "2021"}
    assert got[3]["s"] is None and got[3]["m"] == {"k": 1} and got[3]["year"] == "2021b"
    assert len(M.generations(spark, path)) == 3
    report = M.schema_report(spark, path)
    status = {(r.file.split("year=")[1].split("/")[0], r.column): r.status for r in report.filter("file NOT LIKE '%2021b%'").collect()}
    assert status["2020", "score"] == "missing" and status["2020", "id"] == "widened" and status["2021", "id"] == "same"
    assert report.select("file").distinct().count() == 4
    plan = M.read_merged(spark, path).filter("year = '2020' AND name = 'a'").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan and "PartitionFilters: [isnotnull(year" in plan  # pruned and pushed down


def lines(spark, path, *text):
    spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.mode("append").text(path)


def test_every_line_is_a_row_or_malformed(spark):
    path = work_path(spark, "faulty")
    lines(spark, path, "id,x,y,note", "1,2.5,6,ok", "2,abc,6,b", "3,1.0", "4,1.0,2,c,more", "5,,,", '6,1.0,2,"q, r"', "7,1.0,99999999999,big", "8,1,1,z")
    rows, bad = io.read_csv_quarantined(spark, path, SCHEMA)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2.5, 6, "ok"), (5, None, None, None), (6, 1.0, 2, "q, r"), (8, 1.0, 1, "z")]
    assert sorted(r.line for r in bad.collect()) == ["2,abc,6,b", "3,1.0", "4,1.0,2,c,more", "7,1.0,99999999999,big"]
    assert rows.select("id").count() == rows.count() == 4 and bad.select("file").distinct().count() == 1  # whatever columns are read


def test_header_with_a_quoted_comma(spark):
    path = work_path(spark, "quoted_header")
    lines(spark, path, 'id,"x, in EUR"', "1,2.5")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x, in EUR", T.DoubleType())])
    assert [tuple(r) for r in io.read_csv_checked(spark, path, schema).collect()] == [(1, 2.5)]
    with pytest.raises(io.HeaderMismatch):
        io.read_csv_checked(spark, path, SCHEMA)


ROWS = [(1, "a", 1.5, dt.date(2024, 1, 1), "p"), (2, None, -0.0, None, "q"), (3, "c", float("nan"), dt.date(2024, 1, 3), "q"), (3, "c", float("nan"), dt.date(2024, 1, 3), "q"),
        (4, "d", None, None, None)]
ROW = "id long, name string, v double, day date, part string"


def test_a_changed_cell_is_noticed(spark):
    df, path = spark.createDataFrame(ROWS, ROW), work_path(spark, "verified")
    written = P.write_verified(df, path, ["part"])
    assert written.total == 5 and P.verify(spark, path, written).count() == 5
    assert P.fingerprint(df.repartition(4).select("part", "v", "name", "id", "day"), ["part"]) == written  # whatever order of rows and columns
    for changed in (F.when(F.col("id") == 2, "x").otherwise(F.col("name")).alias("name"), F.coalesce("name", F.lit("")).alias("name")):
        other = work_path(spark, "changed")
        df.select("id", changed, "v", "day", "part").write.partitionBy("part").parquet(other)
        with pytest.raises(P.VerificationError, match="5 rows, wrote 5"):
            P.verify(spark, other, written)
    swapped = work_path(spark, "swapped")  # the same cells in other rows
    df.withColumn("day", F.when(F.col("id") == 1, None).when(F.col("id") == 4, dt.date(2024, 1, 1)).otherwise(F.col("day"))).write.partitionBy("part").parquet(swapped)
    with pytest.raises(P.VerificationError):
        P.verify(spark, swapped, written)


def test_readers_see_the_old_rows_until_a_load_is_verified(spark):
    root, df = work_path(spark, "published"), spark.createDataFrame(ROWS, ROW)
    name = "readers_" + root.rsplit("-", 1)[-1]
    first = P.publish(df.filter("id < 3"), "wealth_test", name, root, ["part"], required=["id"])
    table = f"wealth_test.{name}"
    assert sorted(r.id for r in spark.table(table).collect()) == [1, 2]
    running = spark.table(table)  # a reader that has begun
    with pytest.raises(P.VerificationError, match="name"):
        P.publish(df, "wealth_test", name, root, ["part"], required=["id", "name"])
    with pytest.raises(Exception, match="(?i)divide"):
        P.publish(df.withColumn("v", F.expr("1 / (id - 3)")), "wealth_test", name, root, ["part"])
    assert sorted(r.id for r in spark.table(table).collect()) == [1, 2]
    second = P.publish(df, "wealth_test", name, root, ["part"], required=["id"])
    assert spark.table(table).count() == 5 and running.count() == 2
    assert P.release_old(spark, "wealth_test", name, second) == [first]
    assert spark.table(table).count() == 5
    spark.sql(f"DROP VIEW {table}")
    spark.sql(f"DROP TABLE {table}__{second}")


def test_footer_profile_reads_no_rows(spark):
    path = work_path(spark, "footers")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 != 0, F.col("id") / 7).alias("v"), F.lit("s").alias("name"))
    df.write.partitionBy("g").parquet(path)
    got = reports.footer_profile(spark, path, "g", ["id", "v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "PushedGroupBy: [g" in plan
    want = reports.profile(spark.read.parquet(path), "g", ["id", "v"])
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect()) and got.count() == 3
    assert "false" in spark.conf.get("spark.sql.parquet.aggregatePushdown").lower()
    with pytest.raises(ValueError, match="name"):
        reports.footer_profile(spark, path, "g", ["name"])


def test_large_faulty_files_are_landed_with_a_header_each(spark):
    from fintide.plans import q_io

    size = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(size)
    want = [tuple(r) for r in q_io.ingest_quarantine_report(spark, SF_SMALL).collect()]
    spark.conf.set(size, "4096")  # the client file is read, and landed, by several tasks
    try:
        landed = spark.read.text(q_io._landed_with_faults(spark, SF_SMALL)).withColumn("file", F.col("_metadata.file_path"))
        per_file = landed.groupBy("file").agg(F.count_if(F.col("value").startswith("client_id,")).alias("headers")).collect()
        assert len(per_file) > 1 and {r.headers for r in per_file} == {1}
        assert [tuple(r) for r in q_io.ingest_quarantine_report(spark, SF_SMALL).collect()] == want
    finally:
        spark.conf.set(size, was)

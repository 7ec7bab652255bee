"""Sources and sinks: header-checked CSV, partitioned lake tables, SQL tables, run records.

Paths are Hadoop-FS URIs (local, HDFS, object stores) passed in by the caller.
The lake format is a parameter: ``delta`` when that connector is on the
classpath, otherwise ``parquet`` with directory partitioning.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide.session import ensure_checkpoint_dir


def lake_format(spark: SparkSession) -> str:
    """``delta`` when the session is configured with the Delta extension, otherwise ``parquet``."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "DeltaSparkSessionExtension" in extensions else "parquet"


class HeaderMismatch(ValueError):
    """The CSV header does not name the declared schema's columns in order."""


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "",
                     check_header: bool = True) -> DataFrame:
    """CSV with a header, bound to a declared schema; '' reads as NULL.

    Spark binds CSV columns to a declared schema by position, so a file whose
    columns differ from the schema would be read silently wrong.  The first
    header line is compared with the schema (one small read), and
    ``enforceSchema=false`` makes every file's header be validated as it is
    scanned.
    """
    if check_header:
        first = spark.read.text(path).limit(1).collect()
        if first:
            header = [h.strip() for h in next(csv.reader([first[0][0]]))]
            if header != schema.fieldNames():
                raise HeaderMismatch(f"CSV header {header} at {path} does not match schema {schema.fieldNames()}")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", not check_header)
        .option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


BAD = "_malformed"


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "") -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): CSV bound to a declared schema, with the lines that do not fit it kept apart.

    A line is malformed if a value does not parse as its column's type, or if it has too few or too many
    fields.  ``malformed`` has (file, line).  Every line but the header is in exactly one of the two.

    Whether a value parses is known only if it is read, so all columns are parsed once and the outcome is
    written to the shared checkpoint folder; both results read it.
    """
    ensure_checkpoint_dir(spark)
    read_csv_checked(spark, path, schema, null_value)  # the header check
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = (
        spark.read.schema(whole).option("header", True).option("enforceSchema", False).option("nullValue", null_value)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("columnPruning", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        .select("*", F.col("_metadata.file_path").alias("_file")).checkpoint()
    )
    rows = parsed.filter(F.col(BAD).isNull()).drop(BAD, "_file")
    return rows, parsed.filter(F.col(BAD).isNotNull()).select(F.col("_file").alias("file"), F.col(BAD).alias("line"))


def read_csv_inferred(spark: SparkSession, path: str, null_value: str = "") -> DataFrame:
    """CSV with a header and an inferred schema (one extra pass over the data; prefer a declared schema)."""
    return (spark.read.option("header", True).option("inferSchema", True).option("nullValue", null_value)
            .csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, values written verbatim (no whitespace trimming), NULL as empty."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_lake(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str | None = None,
               name: str = "lake_write") -> int:
    """Overwrite a (partitioned) table, replacing its schema; returns the rows written.

    The row count is observed during the write itself (no second pass).
    """
    fmt = fmt or lake_format(df.sparkSession)
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        # Few files per partition value; adaptive execution splits the large values and joins the small ones.
        observed = observed.hint("rebalance", *partition_by)
    writer = observed.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def read_lake(spark: SparkSession, path: str, fmt: str | None = None, base_path: str | None = None) -> DataFrame:
    """Read a lake table; Parquet directories recover partition columns from ``key=value`` folders."""
    reader = spark.read.format(fmt or lake_format(spark))
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.load(path)


def read_back(spark: SparkSession, path: str, expected_rows: int, fmt: str | None = None) -> DataFrame:
    """Re-read a written table and fail if its row count differs from what was written."""
    df = read_lake(spark, path, fmt)
    n = df.count()
    if n != expected_rows:
        raise AssertionError(f"read-back of {path}: {n} rows, wrote {expected_rows}")
    return df


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int,
                   partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Write a catalog table bucketed (and sorted) by ``key`` at ``path``.

    Tables bucketed the same way on the join key are joined later without any
    exchange: the shuffle is paid once at write time instead of on every join.
    """
    writer = (df.repartition(buckets, key).write.format(fmt).mode("overwrite").option("path", path)
              .bucketBy(buckets, key).sortBy(key))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def register_table(spark: SparkSession, database: str, name: str, path: str, comment: str = "",
                   fmt: str = "parquet", partitioned: bool = False) -> str:
    """Create the namespace if missing, drop and re-create an external table over files; returns its name.

    ``partitioned`` tables recover their partitions (a failure to do so is raised).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full = f"`{database}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    text = comment.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {full} USING {fmt} OPTIONS (path '{path}') COMMENT '{text}'")
    if partitioned and fmt == "parquet":
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    return f"{database}.{name}"


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append record rows (run metadata) as JSON lines."""
    df.write.mode(mode).json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)

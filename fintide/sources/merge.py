"""Lakes whose files were written with different schemas.

Columns come and go and types grow over the years.  ``read_merged`` reads all
files as one table with the union of their columns, every column in the
narrowest type that holds all its files' values; ``schema_report`` tells which
files lack or widen which column.

The schema of a file is in its footer.  Files of one write job carry the job's
id in their names and share a schema, so one footer a write is read (of other
files one each), by Spark jobs, ``READERS`` at a time.  Rows are read by one scan
for each distinct schema, with the columns it has.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READERS = 8
JOB = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")

WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # decimal digits


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both: whole numbers, decimals, floating point and dates grow within
    their kind as long as nothing is rounded; structs, arrays and maps grow inside; anything else meets as text."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    kinds = {type(a), type(b)}
    if kinds <= set(WHOLE):
        return max(a, b, key=lambda t: WHOLE[type(t)])
    if kinds <= {*WHOLE, T.DecimalType}:
        digits = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE[type(t)], 0) for t in (a, b)]
        before, after = max(d[0] for d in digits), max(d[1] for d in digits)
        return T.DecimalType(before + after, after) if before + after <= 38 else T.StringType()
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds <= {T.FloatType, T.ByteType, T.ShortType} and T.FloatType in kinds:
        return T.FloatType()
    if kinds <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of all schemas in order of their first appearance (names without regard to case), in wide enough types."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.get(f.name.lower())
            fields[f.name.lower()] = T.StructField(known.name, wider(known.dataType, f.dataType)) if known else T.StructField(f.name, f.dataType)
    return T.StructType(list(fields.values()))


@dataclass
class Generation:
    """Files of one schema."""

    schema: T.StructType
    files: list[str]


def generations(spark: SparkSession, path: str) -> list[Generation]:
    """The distinct schemas (without partition columns) of the files under ``path``, by the first file's name."""
    files = sorted(r.file for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct().collect())
    writes: dict[str, list[str]] = {}  # the driver holds the names anyway: Spark's file listing does
    for file in files:
        job = JOB.search(file.rsplit("/", 1)[-1])
        writes.setdefault(job.group(1) if job else file, []).append(file)
    with ThreadPoolExecutor(READERS) as pool:
        footers = list(pool.map(lambda of: spark.read.parquet(of[0]).schema, writes.values()))
    found: dict[str, Generation] = {}
    for of, schema in zip(writes.values(), footers):
        found.setdefault(schema.json(), Generation(schema, [])).files.extend(of)
    return list(found.values())


def converted(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in its wider type."""
    if have == want:
        return col
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        inner = [(converted(col[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*inner))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: converted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keyed = F.transform_keys(col, lambda k, _: converted(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: converted(v, have.valueType, want.valueType))
    return F.to_json(col) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else col.cast(want)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All files under ``path`` as one table: partition columns last, columns that a file lacks NULL."""
    parts = generations(spark, path)
    whole = merged_schema([g.schema for g in parts])
    own = {f.name.lower() for f in whole.fields}
    folders = [f for f in spark.read.parquet(path).schema.fields if f.name.lower() not in own]
    out = None
    for g in parts:
        have = {f.name.lower(): f for f in g.schema.fields}
        rows = spark.read.schema(T.StructType([*g.schema.fields, *folders])).option("basePath", path).parquet(*g.files)
        rows = rows.select(*[(converted(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType)
                              if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in whole.fields],
                           *[f"`{f.name}`" for f in folders])
        out = rows if out is None else out.unionByName(rows)
    return out


def schema_report(spark: SparkSession, path: str) -> DataFrame:
    """(file, column, file_type, lake_type, status): every column of the merged table in every file; status is
    'same', 'widened' or 'missing'."""
    parts = generations(spark, path)
    whole = merged_schema([g.schema for g in parts])
    rows = []
    for g in parts:
        have = {f.name.lower(): f.dataType for f in g.schema.fields}
        for f in whole.fields:
            found = have.get(f.name.lower())
            status = "missing" if found is None else "same" if found == f.dataType else "widened"
            rows += [(file, f.name, found.simpleString() if found else None, f.dataType.simpleString(), status) for file in g.files]
    return spark.createDataFrame(rows, "file string, column string, file_type string, lake_type string, status string")

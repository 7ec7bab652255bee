"""Tables that are verified before readers see them.

``write_verified`` observes an order-free fingerprint of the rows while they are
written (their number and the sum of their hashes, for each of ``PARTS`` groups of
partition values) and ``verify`` computes it again from the files, so a changed
cell is noticed even where the number of rows is right.

``publish`` puts a load into a folder and a catalog table of its own, verifies it
there, and only then points the published name, a view, at it: one catalog
call.  Readers see the old rows or the new ones.  A load that fails leaves the
name as it was.  Old versions stay until ``release_old`` drops them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide.sources.io import lake_format, read_lake, register_table

PARTS = 16
ALL = 1 << 64


class VerificationError(AssertionError):
    """A written table does not hold what was written, or a load breaks its rules."""


@dataclass(frozen=True)
class Fingerprint:
    """Rows and sum of row hashes (mod 2^64) for each group of partition values."""

    rows: tuple[int, ...]
    sums: tuple[int, ...]
    partition_by: tuple[str, ...] = ()

    @property
    def total(self) -> int:
        return sum(self.rows)


def row_hash(schema: T.StructType, partition_by: Sequence[str] = ()) -> Column:
    """Hash of a row whatever the order of its columns; partition values count as text, as folder names hold them."""
    parts = []
    for f in sorted(schema.fields, key=lambda f: f.name):
        col = F.col(f"`{f.name}`")
        if f.name in partition_by:
            col = col.cast("string")
        elif isinstance(f.dataType, (T.MapType, T.VariantType)):
            col = F.to_json(col)
        parts += [F.lit(f.name), col.isNull(), col]
    return F.xxhash64(*parts)


def _sum(hash_: Column) -> Column:
    return F.sum(hash_.cast("decimal(20,0)"))


def _measures(schema: T.StructType, partition_by: Sequence[str]) -> list[Column]:
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in partition_by]
    part = F.pmod(F.xxhash64(*values), PARTS) if partition_by else F.lit(0)
    hash_ = row_hash(schema, partition_by)
    return [c for i in range(PARTS if partition_by else 1) for c in (
        F.count_if(part == i).alias(f"rows_{i}"), F.coalesce(_sum(F.when(part == i, hash_)), F.lit(0)).alias(f"sum_{i}"))]


def _fingerprint(found: dict, partition_by: Sequence[str]) -> Fingerprint:
    n = len(found) // 2
    return Fingerprint(tuple(int(found[f"rows_{i}"]) for i in range(n)), tuple(int(found[f"sum_{i}"]) % ALL for i in range(n)), tuple(partition_by))


def write_verified(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str | None = None) -> Fingerprint:
    """Write a (partitioned) table; its fingerprint is observed during the write itself (no second pass)."""
    obs = Observation(f"fingerprint-{uuid.uuid4().hex[:8]}")
    rows = df.observe(obs, *_measures(df.schema, partition_by))
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.format(fmt or lake_format(df.sparkSession)).mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return _fingerprint(obs.get, partition_by)


def fingerprint(df: DataFrame, partition_by: Sequence[str] = ()) -> Fingerprint:
    """The fingerprint of a table's rows, in one aggregate."""
    return _fingerprint(df.agg(*_measures(df.schema, partition_by)).first().asDict(), partition_by)


def verify(spark: SparkSession, path: str, expected: Fingerprint, fmt: str | None = None) -> DataFrame:
    """Re-read a written table; fails if any group of partition values holds other rows than were written."""
    df = read_lake(spark, path, fmt)
    found = fingerprint(df, expected.partition_by)
    wrong = [i for i in range(len(found.rows)) if (found.rows[i], found.sums[i]) != (expected.rows[i], expected.sums[i])]
    if wrong:
        raise VerificationError(f"{path}: {found.total} rows, wrote {expected.total}; groups of partitions that differ: {wrong}")
    return df


def partition_fingerprints(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """(partition columns, rows, fingerprint) of every partition."""
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows"), _sum(row_hash(df.schema, partition_by)).alias("_s")).select(
        *partition_by, "rows", F.pmod("_s", F.lit(Decimal(ALL))).cast("string").alias("fingerprint"))


def publish(df: DataFrame, database: str, name: str, root: str, partition_by: Sequence[str] = (), required: Sequence[str] = (),
            comment: str = "") -> str:
    """Publish ``df`` under ``database.name``; returns the version.  ``required`` columns must have no NULL.

    The load is written to ``root``/<version>, read back and verified as ``name__<version>``; then the view
    ``name`` is replaced.  Whatever fails before that leaves the published rows as they are.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex[:12]
    path, table = f"{root}/{version}", f"{name}__{version}"
    expected = write_verified(df, path, partition_by, "parquet")
    stored = verify(spark, path, expected, "parquet")
    if required:
        gaps = stored.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict()
        if any(gaps.values()):
            raise VerificationError(f"{path}: NULL in required columns {({c: n for c, n in gaps.items() if n})}")
    register_table(spark, database, table, path, comment, partitioned=bool(partition_by))
    if spark.table(f"`{database}`.`{table}`").count() != expected.total:
        raise VerificationError(f"{database}.{table} does not show the {expected.total} rows that were written")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM `{database}`.`{table}`")
    return version


def release_old(spark: SparkSession, database: str, name: str, keep: str) -> list[str]:
    """Drop the catalog tables of all versions of a published name but ``keep``; returns them.  Their files stay."""
    old = [t.tableName for t in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{name}__*'").collect() if t.tableName != f"{name}__{keep}"]
    for table in old:
        spark.sql(f"DROP TABLE `{database}`.`{table}`")
    return sorted(t.removeprefix(f"{name}__") for t in old)

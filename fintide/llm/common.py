"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fintide.session import work_path

#: Words are maximal runs of anything but these six white-space characters.
SPACE = r"[\x20\x09-\x0D]"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared work folder and read it back (cuts lineage, survives lost executors)."""
    path = work_path(df.sparkSession, f"llm/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; NULL and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression: ``body`` sees an evaluated value, not a copy of the expression."""
    return F.transform(F.array(value), body)[0]


def first_by_hash(df: DataFrame, key: str, rows: int, limit: int, seed: int = 0) -> DataFrame:
    """The ``limit`` rows of ``df`` (of ``rows``) that come first in the order of a hash of ``key``.

    A bound on the hash lets about one and a half times ``limit`` rows through, so
    the last sort sees a bounded number however large the table is.
    """
    h = F.xxhash64(F.lit(seed), F.col(key))
    share = (1.5 * limit + 64) / rows if rows else 1.0
    few = df if share >= 1.0 else df.filter(h < int(share * 2**64) - 2**63)
    return few.orderBy(h, key).limit(limit)


def boxed(df: DataFrame, **needed: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``_row``, beside the ``needed`` ones: no name of ``df`` can clash with an internal one."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, *[value.alias(name) for name, value in needed.items()])


def unboxed(columns: list[str], **replaced: Column) -> list[Column]:
    """The columns of a boxed frame again, some of them replaced."""
    return [replaced.get(c, F.col("_row").getField(c)).alias(c) for c in columns]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Distributions, allocation reports, table profiles and the BI SQL reports.

Every report is a grouped aggregate (partial + final hash aggregate, one
exchange).  Windows appear only on already-aggregated rows (one per group),
never over raw rows, so no single task sees more than the group count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide import config as C


def distribution(df: DataFrame, key: str, with_pct: bool = True, digits: int = 2) -> DataFrame:
    """Rows per key, descending by count then key; optional percent of all rows."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    if with_pct:
        total = F.sum("count").over(Window.partitionBy())  # over the (few) group rows only
        out = out.withColumn("pct", F.round(F.col("count") * 100.0 / total, digits))
    return out.orderBy(F.desc("count"), F.asc(key))


def allocation_report(summary: DataFrame, by: str = "risk_profile", digits: int = 1) -> DataFrame:
    """Average equity / debt / gold / gain-loss percentages per group, rounded, ordered by group."""
    return (
        summary.groupBy(by)
        .agg(
            F.round(F.avg("equity_pct"), digits).alias("avg_equity_pct"),
            F.round(F.avg("debt_pct"), digits).alias("avg_debt_pct"),
            F.round(F.avg("gold_pct"), digits).alias("avg_gold_pct"),
            F.round(F.avg("gain_loss_pct"), digits).alias("avg_gain_loss_pct"),
        )
        .orderBy(by)
    )


def profile(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Per partition value: row count, and min / max / NULL count of each column (file-stats view)."""
    aggs = [F.count(F.lit(1)).alias("num_records")]
    for c in columns:
        aggs += [
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
            F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"),
        ]
    return df.groupBy(by).agg(*aggs)


FOOTER_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_profile(spark: SparkSession, path: str, by: str, columns: Sequence[str]) -> DataFrame:
    """``profile`` of a Parquet table by one of its partition columns, from the statistics in the files' footers.

    Counts, minima and maxima are pushed into the scan, so no row is read.  Only columns of
    ``FOOTER_TYPES`` have exact statistics there; others are refused.
    """
    own = spark.newSession()  # the settings are this query's, not the caller's
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    unfit = [c for c in columns if not isinstance(table.schema[c].dataType, FOOTER_TYPES)]
    if unfit:
        raise ValueError(f"no exact statistics in the footers for {unfit}")
    aggs = [F.count(F.lit(1)).alias("num_records")]
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count(c).alias(f"_held_{c}")]
    found = table.groupBy(by).agg(*aggs)
    return found.select(by, "num_records", *[x for c in columns for x in (
        f"min_{c}", f"max_{c}", (F.col("num_records") - F.col(f"_held_{c}")).alias(f"nulls_{c}"))])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULL count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def top_n(df: DataFrame, order_col: str, n: int, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The n rows with the largest ``order_col`` (ties by key) — a top-k report."""
    out = df.select(*columns) if columns else df
    return out.orderBy(F.desc(order_col), F.asc(key)).limit(n)


# BI reports: SQL rendered from column specifications (output name, aggregate, source column, unit, digits).

ROWS, MEAN, TOTAL = "count(1)", "avg", "sum"


def report_sql(source: str, measures: Sequence[tuple], by: str | None = None, descending: str | None = None) -> str:
    """SQL text of one report over the placeholder ``{source}``; a measure is (name, ROWS) or (name, aggregate, column, unit, digits)."""
    rendered = [f"{m[1]} AS {m[0]}" if m[1] == ROWS else f"round({m[1]}({m[2]}) / {m[3]}, {m[4]}) AS {m[0]}" for m in measures]
    text = f"SELECT {', '.join([by, *rendered] if by else rendered)} FROM {{{source}}}"
    if by:
        text += f" GROUP BY {by}"
    return f"{text} ORDER BY {descending} DESC" if descending else text


_TOTAL_CRORE = ("total_aum_crore", TOTAL, "aum", C.CRORE, 1)
CLIENT_TOTALS_SQL = report_sql("clients", [
    _TOTAL_CRORE, ("avg_aum_lakh", MEAN, "aum", C.LAKH, 1), ("total_clients", ROWS)])
TIER_REPORT_SQL = report_sql("clients", [_TOTAL_CRORE, ("total_clients", ROWS)], by="aum_tier", descending=_TOTAL_CRORE[0])
PORTFOLIO_AVERAGES_SQL = report_sql("portfolios", [
    ("total_clients", ROWS), ("avg_funds", MEAN, "total_num_funds", 1, 1),
    *[(f"avg_{kind}_pct", MEAN, f"{kind}_pct", 1, 1) for kind in C.FUND_TYPES]])


def sql_report(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run report SQL with ``{name}`` placeholders bound to DataFrames (no global view names)."""
    return spark.sql(sql, **views)

"""Fund NAV time series: weekday filter, daily returns, volatility, as-of valuation.

Windows keyed only by fund would put a whole fund's history in one task (and a
few funds in total means a few tasks).  Both ``lag_chunked`` and
``asof_join`` therefore window over (key, time chunk) and stitch chunk
boundaries with a summary of one row per (key, chunk).  ``asof_join`` cuts time at
quantiles of the data (``depth``), ``lag_chunked`` at a fixed chunk (``month``
unless the caller names another of ``CHUNKS`` or ``depth``); results do not depend on it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fintide.session import ensure_checkpoint_dir


def weekdays_only(df: DataFrame, date_col: str = "nav_date") -> DataFrame:
    """Drop Saturdays and Sundays (Spark ``weekday``: Monday 0 … Sunday 6)."""
    return df.filter(F.weekday(F.col(date_col)) < 5)


CHUNKS = ("day", "week", "month", "quarter", "year")


def chunk_of(c: str | Column, chunk: str = "month") -> Column:
    """First day of the time chunk that holds ``c``."""
    if chunk not in CHUNKS:
        raise ValueError(f"chunk must be one of {CHUNKS}")
    x = (F.col(c) if isinstance(c, str) else c).cast("date")
    return x if chunk == "day" else F.trunc(x, chunk)


DEPTH = 256  # equi-depth chunks


def depth_bounds(times: DataFrame, column: str, chunks: int = DEPTH) -> list:
    """Bounds that cut the rows of ``times`` into about ``chunks`` chunks of equal numbers of rows (``chunks`` values at most)."""
    shares = [i / chunks for i in range(1, chunks)]
    found = times.agg(F.percentile_approx(column, shares, 20 * chunks).alias("q")).first()["q"] or []
    return sorted(set(found))


def depth_chunk(bounds: Sequence, column: str) -> Column:
    """Number of the chunk that holds ``column``: how many of the bounds lie before it."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(column))) if bounds else F.lit(0)


def lag_chunked(df: DataFrame, key: Sequence[str], order: str, values: Sequence[str],
                prefix: str = "prev_", chunk: str = "month", ties: Sequence[str] = ()) -> DataFrame:
    """Previous row's ``order`` and ``values`` per key (``prev_<col>``), computed per time chunk.

    Rows of one key at one instant are ordered by ``ties``, then by the values.

    Inside a chunk: ``lag``.  For a chunk's first row: the last row of the
    latest earlier non-empty chunk of the key, from a one-row-per-chunk table.
    ``depth`` chunks are cut at quantiles of ``order`` over all keys, so a key with
    many rows inside a month is spread as well (``df`` is then written once).
    """
    keys = list(key)
    if chunk == "depth":
        df = df.checkpoint()
        cut = depth_chunk(depth_bounds(df, order), order)
    else:
        cut = chunk_of(order, chunk)
    packed = F.struct(F.col(order).alias("o"), *[F.col(v).alias(v) for v in values])
    withc = df.withColumn("_chunk", cut).withColumn("_row", packed)
    total = [order, *ties, *values]
    w = Window.partitionBy(*keys, "_chunk").orderBy(*total)
    inner = withc.withColumn("_prev", F.lag("_row").over(w))
    lasts = withc.groupBy(*keys, "_chunk").agg(F.max_by("_row", F.struct(*total)).alias("_last"))
    carry = lasts.select(*keys, "_chunk",
                         F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_carry"))
    out = inner.join(carry, on=[*keys, "_chunk"], how="left").withColumn("_p", F.coalesce("_prev", "_carry"))
    cols = {f"{prefix}{order}": F.col("_p.o")}
    cols.update({f"{prefix}{v}": F.col(f"_p.{v}") for v in values})
    return out.withColumns(cols).drop("_chunk", "_row", "_prev", "_carry", "_p")


def nav_returns(nav: DataFrame, fund: str = "fund_name", date_col: str = "nav_date",
                value: str = "nav") -> DataFrame:
    """Daily return nav / previous nav − 1 per fund, over weekdays only."""
    wk = weekdays_only(nav, date_col)
    lagged = lag_chunked(wk, [fund], date_col, [value])
    return lagged.withColumn("daily_return", F.try_divide(F.col(value), F.col(f"prev_{value}")) - 1)


def nav_volatility(returns: DataFrame, fund: str = "fund_name", digits: int = 8) -> DataFrame:
    """Per fund: number of returns, mean and sample standard deviation of daily returns."""
    return returns.groupBy(fund).agg(
        F.count("daily_return").alias("n_returns"),
        F.round(F.avg("daily_return"), digits).alias("mean_return"),
        F.round(F.stddev_samp("daily_return"), digits).alias("stddev_return"),
    )


def last_at_instants(instants: DataFrame, right: DataFrame, keys: Sequence[str], right_on: str, right_cols: Sequence[str],
                     chunk: str) -> DataFrame:
    """(keys, _t, _p) of distinct ``instants`` (keys, _t): the last right row at or before each, as a struct (_rt, ``right_cols``)."""
    entries = right.select(*keys, F.col(right_on).alias("_t"), F.struct(F.col(right_on).alias("_rt"), *right_cols).alias("_r"))
    entries = entries.dropna(subset=[*keys, "_t"]).groupBy(*keys, "_t").agg(F.max("_r").alias("_r"))
    rtype = entries.schema["_r"].dataType
    both = instants.withColumns({"_kind": F.lit(1), "_r": F.lit(None).cast(rtype)}).unionByName(entries.withColumn("_kind", F.lit(0)))
    if chunk == "depth":
        both = both.checkpoint()  # read for the bounds as well
        both = both.withColumn("_chunk", depth_chunk(depth_bounds(both, "_t"), "_t"))
    else:
        both = both.withColumn("_chunk", chunk_of("_t", chunk))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    matched = (both.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
               .filter(F.col("_kind") == 1).drop("_r"))
    # Boundary carry: last right row per (by, chunk), propagated to later chunks of left instants.
    r_last = both.filter(F.col("_kind") == 0).groupBy(*keys, "_chunk").agg(
        F.max("_r").alias("_last"))  # by time first, then by value
    l_chunks = matched.select(*keys, "_chunk").distinct().withColumn("_last", F.lit(None).cast(rtype))
    # Left-chunk rows sort before the same chunk's right summary, so only earlier chunks precede them.
    wc = Window.partitionBy(*keys).orderBy(F.col("_chunk"), F.col("_is_left").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = (l_chunks.withColumn("_is_left", F.lit(True))
             .unionByName(r_last.withColumn("_is_left", F.lit(False)))
             .withColumn("_carry", F.last("_last", ignorenulls=True).over(wc))
             .filter("_is_left").select(*keys, "_chunk", "_carry"))
    return matched.join(carry, on=[*keys, "_chunk"], how="left").select(*keys, "_t", F.coalesce("_m", "_carry").alias("_p"))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              right_cols: Sequence[str], chunk: str = "depth") -> DataFrame:
    """Left rows with the last right row of the same ``by`` whose ``right_on`` ≤ ``left_on``.

    Adds ``right_on`` and ``right_cols`` (NULL when nothing qualifies, or a key or time is NULL).  Of several
    right rows at one instant the one with the greatest ``right_cols`` (in order) counts.

    Only the distinct (by, instant) pairs of both sides are unioned and windowed, per (by, chunk); a right
    instant equal to the left one counts as "on or before".  A left instant with no right one earlier in its
    chunk takes the last right row of the latest earlier chunk, found on a table of one row per (by, chunk).
    Left rows take their answer with an equi-join, so many rows at one instant are no one task's work.

    ``depth`` chunks are cut at quantiles of all instants: however rows are spread over keys and time, no
    (by, chunk) holds more than a ``DEPTH``-th of them.  The other chunks are those of ``CHUNKS``.
    """
    keys = list(by)
    answers = last_at_instants(left.select(*keys, F.col(left_on).alias("_t")).dropna().distinct(), right, keys, right_on, right_cols, chunk)
    answers = answers.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = F.col(left_on) == F.col("_t")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    lcols = left.columns
    extra = {right_on if right_on not in lcols else f"right_{right_on}": F.col("_p._rt")}
    extra.update({c: F.col(f"_p.{c}") for c in right_cols})
    return left.join(answers, same, "left").withColumns(extra).select(*lcols, *extra)


def latest_on_or_before(right: DataFrame, by: Sequence[str], right_on: str, value_cols: Sequence[str],
                        as_of: dt.date | str) -> DataFrame:
    """One row per key: the last right row on or before a single date (max_by, partial aggregate)."""
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    packed = F.struct(F.col(right_on).alias(right_on), *[F.col(c).alias(c) for c in value_cols])
    return (right.filter(F.col(right_on) <= F.lit(d))
            .groupBy(*by).agg(F.max(packed).alias("_p"))  # by date first, then by value
            .select(*by, *[F.col(f"_p.{c}").alias(c) for c in [right_on, *value_cols]]))


def value_holdings(holdings: DataFrame, nav: DataFrame, as_of: dt.date | str, fund: str = "fund_name") -> DataFrame:
    """Each holding valued at the NAV on/before its buy date and at the NAV on/before ``as_of``.

    Only the distinct (fund, buy date) pairs meet the price history; holdings
    take their price with an equi-join, so they are never sorted or windowed.
    """
    ensure_checkpoint_dir(holdings.sparkSession)
    # Both sides of the as-of join are read more than once: written once, they cost one scan of their lineage each.
    nav = nav.select(fund, "nav_date", "nav").checkpoint()
    pairs = holdings.select(fund, F.col("buy_date").alias("_t")).dropna().distinct().checkpoint()
    # A month of a fund holds 31 distinct dates of either side at most.
    priced = last_at_instants(pairs, nav, [fund], "nav_date", ["nav"], "month")
    p = priced.select(F.col(fund).alias("_fund"), F.col("_t").alias("_date"), F.col("_p._rt").alias("nav_date_at_buy"), F.col("_p.nav").alias("nav_at_buy"))
    at_buy = holdings.join(p, (F.col(fund) == F.col("_fund")) & (F.col("buy_date") == F.col("_date")), "left").drop("_fund", "_date")
    current = latest_on_or_before(nav, [fund], "nav_date", ["nav"], as_of).withColumnsRenamed(
        {"nav_date": "current_nav_date", "nav": "current_nav"})
    return at_buy.join(current, on=fund, how="left").withColumns({
        "invested_value": F.round(F.col("units") * F.col("nav_at_buy"), 2),
        "current_value": F.round(F.col("units") * F.col("current_nav"), 2),
    })

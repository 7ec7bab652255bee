"""Transaction analytics: suspicious-activity rules, same-minute bursts, mix, rule quality, unit math.

All grouped work is a ``groupBy`` with map-side partial aggregation, so a
client or channel holding a third of all rows is collapsed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import clip, score


def suspicious_rules(amount: float = C.SUSPICIOUS_AMOUNT, hours: tuple[int, int] = C.SUSPICIOUS_HOURS,
                     channels: Sequence[str] = tuple(C.SUSPICIOUS_CHANNELS), ts_col: str = "txn_ts"
                     ) -> dict[str, Column]:
    return {
        "rule_amount": F.col("amount") >= amount,
        "rule_hour": F.hour(ts_col).between(hours[0], hours[1]),
        "rule_channel": F.col("channel").isin(list(channels)),
    }


def flag_suspicious(df: DataFrame, min_rules: int = 3, **rule_args) -> DataFrame:
    """Add one boolean per rule, the number of rules hit, and ``is_suspicious`` (≥ ``min_rules``)."""
    rules = suspicious_rules(**rule_args)
    out = df.withColumns(rules)
    out = out.withColumn("rules_hit", score([F.col(r) for r in rules]))
    return out.withColumn("is_suspicious", F.col("rules_hit") >= min_rules)


def bursts(df: DataFrame, min_txns: int = 2, ts_col: str = "txn_ts") -> DataFrame:
    """Clients with at least ``min_txns`` transactions inside the same clock minute."""
    return (
        df.groupBy("client_id", F.date_trunc("minute", F.col(ts_col)).alias("minute"))
        .agg(F.count(F.lit(1)).alias("n_txn"), F.sum("amount").cast("double").alias("total_amount"))
        .filter(F.col("n_txn") >= min_txns)
    )


def burst_sessions(df: DataFrame, gap_seconds: int = 60, min_txns: int = 2, ts_col: str = "txn_ts") -> DataFrame:
    """Runs of at least ``min_txns`` transactions of a client, each at most ``gap_seconds`` after the one before.

    Unlike ``bursts`` a run is not split where a clock minute ends.  Session windows merge in the shuffle's
    sorted order; ``df`` may be a stream with a watermark on ``ts_col``.
    """
    # A session window ends one gap after its last row, and a row at that very instant still belongs to it.
    window = F.session_window(F.col(ts_col), f"{gap_seconds} seconds")
    return (
        df.groupBy("client_id", window.alias("w"))
        .agg(F.count("txn_id").alias("n_txn"), F.sum("amount").cast("double").alias("total_amount"))
        .filter(F.col("n_txn") >= min_txns)
        .select("client_id", F.col("w.start").alias("burst_start"),
                (F.col("w.end") - F.make_dt_interval(secs=F.lit(gap_seconds))).alias("burst_end"), "n_txn", "total_amount")
    )


def transaction_mix(df: DataFrame, digits: int = 2) -> DataFrame:
    """Count, amount and share of transactions per (type, channel)."""
    agg = df.groupBy("txn_type", "channel").agg(
        F.count(F.lit(1)).alias("n_txn"), F.sum("amount").cast("double").alias("total_amount"))
    share = F.round(F.col("n_txn") * 100.0 / F.sum("n_txn").over(Window.partitionBy()), digits)
    return agg.withColumn("share_pct", share)  # the window runs over the (type, channel) groups only


def rule_quality(df: DataFrame, predictions: Mapping[str, Column], label: str = "is_flagged",
                 digits: int = 6) -> DataFrame:
    """Per named predictor: tp, fp, fn, precision, recall against the label — one aggregate pass."""
    aggs = []
    for i, p in enumerate(predictions.values()):
        p = F.coalesce(p, F.lit(False))
        aggs += [
            F.count_if(p & F.col(label)).alias(f"tp{i}"),
            F.count_if(p & ~F.col(label)).alias(f"fp{i}"),
            F.count_if(~p & F.col(label)).alias(f"fn{i}"),
        ]
    one = df.agg(*aggs)
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                 F.col(f"fn{i}").alias("fn"))
        for i, name in enumerate(predictions)
    ])).alias("r")).select("r.*")
    return rows.withColumns({
        "precision": F.round(F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")),
                                        F.lit(0.0)), digits),
        "recall": F.round(F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")),
                                     F.lit(0.0)), digits),
    })


def nav_for_event(id_col: str = "txn_id") -> Column:
    """A deterministic NAV per transaction (0 for every 50th, to exercise the zero guard)."""
    n = F.substring(F.col(id_col), 4, 64).cast("bigint")
    return F.when(n % 50 == 0, F.lit(0.0)).otherwise(F.lit(10.0) + (n % 90) * 1.5)


def transaction_units(df: DataFrame, settle_days: int = 3, lo: float = 1_000.0, hi: float = 500_000.0) -> DataFrame:
    """units = round(amount / nav, 3) (NULL on a zero NAV), settlement date, clipped amount, hour, contact."""
    nav = nav_for_event()
    amount = F.col("amount").cast("double")
    return df.select(
        "txn_id", "client_id",
        nav.alias("nav_at_txn"),
        F.round(F.try_divide(amount, nav), 3).alias("units"),
        F.date_add(F.col("txn_ts").cast("date"), settle_days).alias("settlement_date"),
        clip(amount, lo, hi).alias("amount_clipped"),
        F.hour("txn_ts").alias("txn_hour"),
        F.concat(F.lower(F.translate("fund_name", "#", ".")), F.lit("@funds.example")).alias("fund_contact"),
    )


def inject_pattern_rows(df: DataFrame, scale: int = 100, hour: int = 3) -> DataFrame:
    """Rows copied from flagged transactions into the documented fraud pattern (large, at night, API)."""
    night = F.col("txn_ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(hour))
    return df.filter(F.col("is_flagged")).select(
        F.concat(F.lit("INJ"), F.substring("txn_id", 4, 64)).alias("txn_id"),
        "client_id", "fund_name", F.lit("BUY").alias("txn_type"),
        (F.col("amount") * scale).cast("decimal(18,2)").alias("amount"),
        night.alias("txn_ts"), F.lit("API").alias("channel"), F.lit(True).alias("is_flagged"),
    )


def combine(normal: DataFrame, injected: DataFrame) -> DataFrame:
    """Row union by column name (same schema)."""
    return normal.unionByName(injected)

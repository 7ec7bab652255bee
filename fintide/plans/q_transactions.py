"""Transaction queries: suspicious rules, rule quality, bursts, mix, unit math, injected-row union."""

from __future__ import annotations

from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators import transactions as TX
from fintide.plans.catalog import register
from fintide.plans.oracle_views import rnd, with_views
from fintide.sources import testviews as tv

_RULES_SQL = f"""
  SELECT *, CAST((CASE WHEN rule_amount THEN 1 ELSE 0 END) + (CASE WHEN rule_hour THEN 1 ELSE 0 END)
                 + (CASE WHEN rule_channel THEN 1 ELSE 0 END) AS INTEGER) AS rules_hit
  FROM (SELECT *, amount >= {C.SUSPICIOUS_AMOUNT} AS rule_amount,
               hour(txn_ts) BETWEEN {C.SUSPICIOUS_HOURS[0]} AND {C.SUSPICIOUS_HOURS[1]} AS rule_hour,
               channel IN ({', '.join(f"'{c}'" for c in C.SUSPICIOUS_CHANNELS)}) AS rule_channel
        FROM transactions) t"""


@register("suspicious_transactions", with_views("""
SELECT txn_id, client_id, CAST(amount AS DOUBLE) AS amount, txn_ts, channel, rule_amount, rule_hour, rule_channel,
       rules_hit, rules_hit >= 3 AS is_suspicious, is_flagged
FROM flagged""", "transactions", extra=[("flagged", _RULES_SQL)]))
def suspicious_transactions(spark, d):
    f = TX.flag_suspicious(tv.transactions(spark, d))
    return f.select("txn_id", "client_id", F.col("amount").cast("double").alias("amount"), "txn_ts", "channel",
                    "rule_amount", "rule_hour", "rule_channel", "rules_hit", "is_suspicious", "is_flagged")


_PREDICTORS = ["rule_amount", "rule_hour", "rule_channel", "all_rules"]


def _quality_sql() -> str:
    rows = []
    for name in _PREDICTORS:
        p = "rules_hit >= 3" if name == "all_rules" else name
        rows.append(f"""SELECT '{name}' AS rule, CAST(count_if({p} AND is_flagged) AS BIGINT) AS tp,
            CAST(count_if({p} AND NOT is_flagged) AS BIGINT) AS fp,
            CAST(count_if(NOT ({p}) AND is_flagged) AS BIGINT) AS fn FROM flagged""")
    return with_views(f"""
SELECT rule, tp, fp, fn,
       {rnd('CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END', 6)} AS precision,
       {rnd('CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END', 6)} AS recall
FROM ({' UNION ALL '.join(rows)}) q""", "transactions", extra=[("flagged", _RULES_SQL)])


@register("rule_quality", _quality_sql())
def rule_quality(spark, d):
    f = TX.flag_suspicious(tv.transactions(spark, d))
    preds = {n: F.col(n) for n in _PREDICTORS[:-1]}
    preds["all_rules"] = F.col("rules_hit") >= 3
    return TX.rule_quality(f, preds)


@register("burst_transactions", with_views("""
SELECT client_id, date_trunc('minute', txn_ts) AS minute, count(*) AS n_txn,
       CAST(sum(amount) AS DOUBLE) AS total_amount
FROM transactions GROUP BY 1, 2 HAVING count(*) >= 2""", "transactions"))
def burst_transactions(spark, d):
    return TX.bursts(tv.transactions(spark, d))


SESSIONS_SQL = with_views("""
SELECT client_id, min(txn_ts) AS burst_start, max(txn_ts) AS burst_end, count(*) AS n_txn, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM (SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY txn_ts, txn_id) AS island
      FROM (SELECT *, CASE WHEN txn_ts - lag(txn_ts) OVER (PARTITION BY client_id ORDER BY txn_ts, txn_id) <= INTERVAL 60 SECOND
                           THEN 0 ELSE 1 END AS opens FROM transactions) o) i
GROUP BY client_id, island HAVING count(*) >= 2""", "transactions")


@register("burst_sessions", SESSIONS_SQL)
def burst_sessions(spark, d):
    """Bursts that a clock minute does not split: at most a minute between neighbouring transactions."""
    return TX.burst_sessions(tv.transactions(spark, d))


@register("transaction_mix", with_views(f"""
SELECT txn_type, channel, n_txn, total_amount, {rnd('CAST(n_txn AS DOUBLE) * 100.0 / sum(n_txn) OVER ()', 2)}
       AS share_pct
FROM (SELECT txn_type, channel, count(*) AS n_txn, CAST(sum(amount) AS DOUBLE) AS total_amount
      FROM transactions GROUP BY 1, 2) t""", "transactions"))
def transaction_mix(spark, d):
    return TX.transaction_mix(tv.transactions(spark, d))


@register("transaction_units", with_views(f"""
SELECT txn_id, client_id, nav AS nav_at_txn,
       {rnd('CASE WHEN nav = 0 THEN NULL ELSE CAST(amount AS DOUBLE) / nav END', 3)} AS units,
       CAST(txn_ts AS DATE) + 3 AS settlement_date,
       least(greatest(CAST(amount AS DOUBLE), 1000.0), 500000.0) AS amount_clipped,
       CAST(hour(txn_ts) AS INTEGER) AS txn_hour,
       lower(replace(fund_name, '#', '.')) || '@funds.example' AS fund_contact
FROM (SELECT *, CASE WHEN CAST(substr(txn_id, 4) AS BIGINT) % 50 = 0 THEN 0.0::DOUBLE
                     ELSE 10.0 + (CAST(substr(txn_id, 4) AS BIGINT) % 90) * 1.5::DOUBLE END AS nav
      FROM transactions) t""", "transactions"))
def transaction_units(spark, d):
    return TX.transaction_units(tv.transactions(spark, d))


@register("transactions_combined", with_views("""
SELECT txn_id, client_id, fund_name, txn_type, CAST(amount AS DOUBLE) AS amount, txn_ts, channel, is_flagged
FROM transactions
UNION ALL
SELECT 'INJ' || substr(txn_id, 4), client_id, fund_name, 'BUY', CAST(CAST(amount * 100 AS DECIMAL(18,2)) AS DOUBLE),
       CAST(CAST(txn_ts AS DATE) AS TIMESTAMP) + INTERVAL 3 HOUR, 'API', true
FROM transactions WHERE is_flagged""", "transactions"))
def transactions_combined(spark, d):
    t = tv.transactions(spark, d)
    out = TX.combine(t, TX.inject_pattern_rows(t))
    return out.withColumn("amount", F.col("amount").cast("double"))

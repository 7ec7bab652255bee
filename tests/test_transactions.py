import datetime as dt
from decimal import Decimal

from fintide.operators.transactions import bursts, flag_suspicious, rule_quality, transaction_mix

SCHEMA = ("txn_id string, client_id string, fund_name string, txn_type string, amount decimal(18,2), "
          "txn_ts timestamp_ntz, channel string, is_flagged boolean")


def _tx(spark):
    t = dt.datetime(2024, 1, 1, 3, 15, 5)
    rows = [("T1", "C1", "F", "BUY", Decimal("2000000"), t, "API", True),
            ("T2", "C1", "F", "BUY", Decimal("10"), t + dt.timedelta(seconds=20), "APP", False),
            ("T3", "C2", "F", "SIP", Decimal("1000000"), t.replace(hour=5), "API", False),
            ("T4", "C2", "F", "SIP", Decimal("999999.99"), t.replace(hour=2, minute=0), "WEB", True)]
    return spark.createDataFrame(rows, SCHEMA)


def test_flags_and_rules_hit(spark):
    out = {r.txn_id: r for r in flag_suspicious(_tx(spark)).collect()}
    assert out["T1"].rules_hit == 3 and out["T1"].is_suspicious
    assert out["T3"].rules_hit == 2 and not out["T3"].is_suspicious  # 05:xx is outside 2-4
    assert (out["T4"].rule_amount, out["T4"].rule_hour, out["T4"].rule_channel) == (False, True, False)


def test_same_minute_bursts(spark):
    b = bursts(_tx(spark)).collect()
    assert len(b) == 1 and b[0].client_id == "C1" and b[0].n_txn == 2


def test_mix_and_quality(spark):
    mix = {(r.txn_type, r.channel): r.share_pct for r in transaction_mix(_tx(spark)).collect()}
    assert mix[("BUY", "API")] == 25.0 and abs(sum(mix.values()) - 100) < 1e-9
    from pyspark.sql import functions as F
    q = rule_quality(flag_suspicious(_tx(spark)), {"all": F.col("is_suspicious")}).first()
    assert (q.tp, q.fp, q.fn, q.precision, q.recall) == (1, 0, 1, 1.0, 0.5)

"""Streaming queries: transaction monitor, bursts, request log, TTL cache, prediction reuse, model scoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide.operators import metrics as M
from fintide.plans.catalog import register
from fintide.plans.oracle_views import with_views
from fintide.plans.q_scoring import (_ANSWERED_SQL, _RULE, _WALK, TTL_US, _answered, events_of_clients, keyed_requests, requests,
                                     timed_requests, trained_with_features)
from fintide.plans.q_transactions import _RULES_SQL, SESSIONS_SQL
from fintide.session import work_path
from fintide.sources import testviews as tv
from fintide.streaming import stream as ST


@register("stream_transaction_monitor", with_views("""
SELECT client_id, date_trunc('hour', txn_ts) AS window_start, date_trunc('hour', txn_ts) + INTERVAL 1 HOUR
       AS window_end, count(*) AS n_txn, CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(count_if(rules_hit >= 3) AS BIGINT) AS n_suspicious
FROM flagged GROUP BY 1, 2""", "transactions", extra=[("flagged", _RULES_SQL)]))
def stream_transaction_monitor(spark, d):
    """Transactions arrive as files; hourly per-client windows are emitted once the watermark closes them.

    A closing row in the control folder ends the stream, so every window of the data is emitted.
    """
    txn = tv.transactions(spark, d)
    src, control = ST.stage_files(txn, work_path(spark, "txn_stream_in")), work_path(spark, "txn_stream_control")
    stream = ST.read_stream(spark, src, txn.schema, control=control)
    return ST.run_to_the_end(spark, ST.stream_monitor(stream), "txn_monitor", txn, control, "txn_ts", "3 HOURS")


@register("stream_burst_sessions", SESSIONS_SQL)
def stream_burst_sessions(spark, d):
    """Bursts that cross a clock minute, from transactions that arrive out of order over several micro-batches."""
    txn = tv.transactions(spark, d)
    control, out, ckpt = (work_path(spark, n) for n in ("burst_control", "bursts_out", "bursts_ckpt"))
    for src in ST.arrivals(txn, work_path(spark, "burst_in"), 3, _disordered("txn_ts", "txn_id")):
        bursts = ST.stream_bursts(ST.read_stream(spark, src, txn.schema, control=control))
        ST.run_to_table(spark, bursts, "bursts", ckpt=ckpt, out=out)
    return ST.run_to_the_end(spark, bursts, "bursts", txn, control, "txn_ts", "3 HOURS", ckpt, out)


def _disordered(ts_col, id_col):
    """Arrival order of a stream whose rows come up to 45 minutes late."""
    late = F.pmod(F.xxhash64(id_col), 45 * 60).cast("int")
    return F.col(ts_col) + F.make_dt_interval(secs=late)


@register("stream_scoring")
def stream_scoring(spark, d):
    features, model = trained_with_features(spark, d)
    reqs = requests(spark, d, features)
    src = ST.stage_files(reqs, work_path(spark, "requests_stream_in"))
    stream = ST.read_stream(spark, src, reqs.schema, max_files=1)
    return ST.run_to_table(spark, ST.stream_scores(stream, model), "scoring")


@register("stream_scoring_answers", _ANSWERED_SQL)
def stream_scoring_answers(spark, d):
    """Every valid request of the stream answered once."""
    return _answered(stream_scoring(spark, d))


@register("stream_request_log", with_views(f"""
SELECT client_id, CASE WHEN len(reasons) = 0 THEN 'answered' ELSE 'rejected' END AS sink,
       array_to_string(reasons, '; ') AS reasons, CASE WHEN len(reasons) = 0 THEN {_RULE} END AS risk_profile,
       1::BIGINT AS times
FROM validated""", "validated"))
def stream_request_log(spark, d):
    """Every request of the stream in exactly one of two sinks: answered (by the allocation rule) or rejected with its reasons."""
    reqs = requests(spark, d)
    src, log = ST.stage_files(reqs, work_path(spark, "log_in")), work_path(spark, "request_log")
    answers, rejections = f"{log}/answers", f"{log}/rejections"
    handle = ST.answer_batches(lambda df: df.withColumn("risk_profile", M.rule_prediction()).select("client_id", "risk_profile"), answers, rejections)
    ST.run_batches(ST.read_stream(spark, src, reqs.schema, max_files=1), handle, f"{log}/ckpt")
    answered = ST.read_batches(spark, answers, T.StructType.fromDDL("client_id string, risk_profile string"))
    refused = ST.read_batches(spark, rejections, T.StructType.fromDDL("client_id string, reasons array<string>"))
    both = answered.select("client_id", F.lit("answered").alias("sink"), F.lit("").alias("reasons"), "risk_profile").unionByName(
        refused.select("client_id", F.lit("rejected").alias("sink"), F.concat_ws("; ", "reasons").alias("reasons"),
                       F.lit(None).cast("string").alias("risk_profile")))
    return both.groupBy("client_id", "sink", "reasons", "risk_profile").agg(F.count(F.lit(1)).alias("times"))


@register("stream_cache_hits", with_views("""
SELECT r.event_id, r.cache_key, epoch_us(r.ts) AS t_us, w.hit AS from_cache
FROM timed_requests r JOIN walk w ON r.event_id = w.event_id""", "timed_requests", extra=_WALK, recursive=True))
def stream_cache_hits(spark, d):
    """The TTL replay on a stream of requests that come up to 45 minutes late, in several micro-batches."""
    reqs = timed_requests(spark, d).select("event_id", "cache_key", "ts")
    control, base = work_path(spark, "cache_control"), work_path(spark, "cache_stream")
    for src in ST.arrivals(reqs, work_path(spark, "cache_in"), 3, _disordered("ts", "event_id")):
        stream = ST.read_stream(spark, src, reqs.schema, control=control)
        ST.stream_cache(stream, "cache_stream", checkpoint=base)
    ST.close_stream(spark.read.schema(reqs.schema).parquet(src), control, "ts", "24 HOURS")
    return ST.stream_cache(stream, "cache_stream", checkpoint=base).drop("batch_id")


@register("stream_scored_once", with_views(f"""
SELECT r.event_id, r.cache_key, CAST(floor(epoch_us(r.ts) / {TTL_US}.0) AS BIGINT) AS slice, 1::BIGINT AS answers,
       1::BIGINT AS predictions, v.profile AS risk_profile
FROM timed_requests r JOIN (SELECT client_id, {_RULE} AS profile FROM validated) v ON v.client_id = r.client_id""",
                                           "timed_requests", "validated"))
def stream_scored_once(spark, d):
    """All requests of the stream answered, with one prediction per (key, slice of one TTL) whatever micro-batches its requests come in."""
    ruled = keyed_requests(spark, d).withColumn("profile", M.rule_prediction()).select("client_id", "cache_key", "profile")
    reqs = events_of_clients(spark, d).join(ruled, on="client_id")
    out, ckpt = work_path(spark, "scored_once_out"), work_path(spark, "scored_once_ckpt")
    for src in ST.arrivals(reqs, work_path(spark, "once_in"), 3, _disordered("ts", "event_id")):
        stream = ST.read_stream(spark, src, reqs.schema)
        scored = ST.stream_reuse(stream, lambda df: df.withColumn("risk_profile", F.col("profile")), ["risk_profile"])
        done = ST.run_to_table(spark, scored, "scored_once", ckpt=ckpt, out=out)
    answers = done.groupBy("event_id", "cache_key", "slice").agg(F.count(F.lit(1)).alias("answers"), F.min("risk_profile").alias("risk_profile"))
    made = done.groupBy("cache_key", "slice").agg(F.countDistinct("scored_by").alias("predictions"))
    return answers.join(made, ["cache_key", "slice"]).select("event_id", "cache_key", "slice", "answers", "predictions", "risk_profile")

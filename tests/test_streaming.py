import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fintide.operators.scoring import cache_hits
from fintide.operators.transactions import burst_sessions
from fintide.plans.q_scoring import requests, timed_requests
from fintide.session import work_path
from fintide.streaming import stream as ST

from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
REQS = "event_id long, cache_key string, ts timestamp_ntz"


def at(i, key, seconds):
    return i, key, T0 + dt.timedelta(seconds=seconds)


def land(spark, path, *batches, schema=REQS):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame([], schema).schema


def cached(spark, stream, reqs, control, base):
    ST.stream_cache(stream, "cache", checkpoint=base)
    ST.close_stream(reqs, control, "ts", "24 HOURS")
    return ST.stream_cache(stream, "cache", checkpoint=base)


def test_stream_cache_equals_batch_replay_in_any_order(spark):
    # A hot key over many slices, rows up to 50 minutes late, four micro-batches.
    rnd = random.Random(2)
    rows = [at(i, "hot" if i % 3 else f"k{i % 7}", rnd.randint(0, 150_000)) for i in range(600)]
    rows.sort(key=lambda r: r[2] + dt.timedelta(seconds=rnd.randint(0, 3000)))
    src, control, base = (work_path(spark, n) for n in ("hot_in", "hot_control", "hot"))
    schema = land(spark, src, *[rows[i : i + 150] for i in range(0, 600, 150)])
    reqs = spark.createDataFrame(rows, REQS)
    stream = ST.read_stream(spark, src, schema, max_files=1, control=control)
    got = cached(spark, stream, reqs, control, base)
    want = cache_hits(reqs, "cache_key", "ts", "event_id").select("event_id", "from_cache")
    assert got.count() == 600 and got.select("event_id", "from_cache").exceptAll(want).count() == 0
    assert got.select("batch_id").distinct().count() >= 3 and want.filter("from_cache").count() > 100
    assert spark.read.parquet(src).count() == 600  # closing the stream leaves the source alone


def test_one_key_is_held_by_several_tasks(spark):
    src, control = work_path(spark, "one_in"), work_path(spark, "one_control")
    schema = land(spark, src, [at(i, "hot", 3000 * i) for i in range(200)])
    stream = ST.closed_slices(ST.read_stream(spark, src, schema, control=control))
    done = ST.run_to_the_end(spark, stream, "held", spark.read.parquet(src), control, "ts", "24 HOURS")
    assert done.count() == 200 and done.select(F.col("_metadata.file_path")).distinct().count() > 3


def test_late_rows_miss_and_fill_nothing(spark):
    src, control, base = (work_path(spark, n) for n in ("late_in", "late_control", "late"))
    schema = land(spark, src, [at(1, "k", 100)], [at(2, "k", 200_000)], [at(3, "k", 150), at(4, "k", 200_100)], [at(5, "k", 203_600)])
    stream = ST.read_stream(spark, src, schema, max_files=1, control=control)
    got = {r.event_id: r.from_cache for r in cached(spark, stream, spark.read.parquet(src), control, base).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True, 5: False}


def test_a_replayed_batch_reads_the_same_entries(spark):
    answers, entries = work_path(spark, "again_answers"), work_path(spark, "again_entries")
    handle = ST.cache_batches(answers, entries)
    rows = [("k", 0, 10), ("k", 0, 14_000), ("k", 1, 14_500), ("k", 1, 20_000)]
    df = spark.createDataFrame([(k, s, t * 1_000_000, i) for i, (k, s, t) in enumerate(rows)], ST.CLOSED)
    for _ in range(2):
        handle(df.filter("slice = 0"), 0)
    for _ in range(2):
        handle(df.filter("slice = 1"), 1)
    got = {r.event_id: r.from_cache for r in ST.read_batches(spark, answers, ST.CACHE_OUT).collect()}
    assert got == {0: False, 1: False, 2: True, 3: False}
    handle(df.limit(0), 2)  # an empty batch hands the entries on
    assert ST.read_batches(spark, f"{entries}/of", ST.ENTRIES).filter("batch_id = 2").count() == 1


def test_every_request_is_in_one_sink_when_a_batch_fails_between_the_writes(spark):
    reqs = requests(spark, SF_SMALL)
    src, log = ST.stage_files(reqs, work_path(spark, "log_in"), files=3), work_path(spark, "log")
    answers, rejections = f"{log}/answers", f"{log}/rejections"
    failed = []

    def score(df):
        return df.select("client_id")

    handle = ST.answer_batches(score, answers, rejections)

    def breaks(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            ST.write_once(batch.select("client_id"), answers, batch_id)  # more than belongs there, then the batch dies
            raise RuntimeError("lost")
        handle(batch, batch_id)

    stream = ST.read_stream(spark, src, reqs.schema, max_files=1)
    with pytest.raises(Exception, match="lost"):
        ST.run_batches(stream, breaks, f"{log}/ckpt")
    ST.run_batches(stream, breaks, f"{log}/ckpt")
    ids = [ST.read_batches(spark, p, spark.createDataFrame([], "client_id string").schema).select("client_id") for p in (answers, rejections)]
    assert failed and ids[0].count() > 0 and ids[1].count() > 0
    assert sorted(r.client_id for r in ids[0].unionByName(ids[1]).collect()) == sorted(r.client_id for r in reqs.select("client_id").collect())


def test_one_prediction_per_key_and_slice_across_batches(spark):
    rows = [at(1, "a", 10), at(2, "a", 3500), at(3, "a", 20), at(4, "b", 30), at(5, "a", 3700), at(6, "a", 7100)]
    src = work_path(spark, "reuse_in")
    schema = land(spark, src, rows[:2], rows[2:4], rows[4:])
    stream = ST.read_stream(spark, src, schema, max_files=1)
    scored = ST.stream_reuse(stream, lambda df: df.withColumn("v", F.concat(F.lit("by "), "event_id")), ["v"])
    got = ST.run_to_table(spark, scored, "reuse").collect()
    assert sorted(r.event_id for r in got) == [1, 2, 3, 4, 5, 6]
    by = {}
    for r in got:
        by.setdefault((r.cache_key, r.slice), set()).add(r.v)
    assert len(by) == 3 and all(len(v) == 1 for v in by.values())


def test_bursts_across_the_minute(spark):
    secs = [0, 59, 61, 121.5, 200, 259, 319.000001]
    rows = [(f"T{i}", "c", 1.0, T0 + dt.timedelta(seconds=x)) for i, x in enumerate(secs)] + [("X", "d", 2.0, T0)]
    df = spark.createDataFrame(rows, "txn_id string, client_id string, amount double, txn_ts timestamp_ntz")
    got = sorted((r.n_txn, (r.burst_start - T0).total_seconds(), (r.burst_end - T0).total_seconds()) for r in burst_sessions(df).collect())
    assert got == [(2, 200, 259), (3, 0, 61)]


def test_timed_requests_reach_the_stream_job_whole(spark):
    reqs = timed_requests(spark, SF_SMALL).select("event_id", "cache_key", "ts")
    src = ST.stage_files(reqs, work_path(spark, "staged"), files=3, order_by="ts")
    assert spark.read.parquet(src).exceptAll(reqs).count() == 0 and spark.read.parquet(src).count() == reqs.count()


@pytest.mark.parametrize("query", ["stream_scored_once", "stream_burst_sessions", "stream_cache_hits"])
def test_tables_of_many_files_lose_no_rows_to_lateness(spark, query):
    from fintide.plans import q_streaming as Q
    from fintide.sources.testviews import SCAN_PARTITIONS

    run = getattr(Q, query)
    want = sorted(tuple(r) for r in run(spark, SF_SMALL).collect())
    spark.conf.set(SCAN_PARTITIONS, "6")  # a slice is written by several tasks
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(tuple(r) for r in run(spark, SF_SMALL).collect()) == want
    finally:
        spark.conf.unset(SCAN_PARTITIONS)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

"""Structured Streaming jobs: scoring, transaction monitoring, TTL cache with keyed state.

Sources are file streams (``readStream`` with a declared schema); sinks are
append-mode Parquet with a checkpoint folder, or batch folders that a replayed
micro-batch overwrites (``write_once``), so a restarted query resumes exactly
where it stopped.  ``run_available`` and ``run_batches`` drive a query with the
``availableNow`` trigger (process what exists, then stop).

Windows and slices close when the watermark passes them.  At the end of a stream
nothing moves the watermark on; ``close_stream`` does, with a row in a control
folder that the query reads beside its source (``read_stream``), never in the
source itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fintide import config as C
from fintide.operators import ttl as TTL
from fintide.operators.scoring import cache_fills, epoch_micros, score_requests, validate_requests
from fintide.operators.transactions import burst_sessions, flag_suspicious
from fintide.session import work_path


def arrivals(df: DataFrame, path: str, slices: int, order_by: str | Column) -> Iterator[str]:
    """Rows arriving as Parquet files in ``path``, slice by slice in the order of ``order_by`` (a time).

    Yields ``path`` after each slice, for the caller to run its query over what has come: a micro-batch then
    holds whole slices, whatever number of files the tasks that hold their rows write.  (A limit on the files of a
    trigger would cut a large slice into many micro-batches, in no order of time: its rows would come late.)
    Slices are cut at quantiles of the column.
    """
    held = df.checkpoint()
    at = F.unix_micros((F.col(order_by) if isinstance(order_by, str) else order_by).cast("timestamp"))
    cuts = held.agg(F.percentile_approx(at, [i / slices for i in range(1, slices)], 1000).alias("q")).first()["q"] or []
    bounds = [None, *cuts, None]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = held if low is None else held.filter(at > low)
        part = part if high is None else part.filter(at <= high)
        part.write.mode("overwrite" if i == 0 else "append").parquet(path)
        yield path


def stage_files(df: DataFrame, path: str, files: int = 4, order_by: str | Column | None = None) -> str:
    """Materialise a frame as Parquet files a file-stream source can pick up; with ``order_by`` as ``arrivals`` of ``files`` slices."""
    if order_by is None:
        df.repartition(files).write.mode("overwrite").parquet(path)
    else:
        for _ in arrivals(df, path, files, order_by):
            pass
    return path


def close_stream(df: DataFrame, path: str, ts_col: str, after: str) -> None:
    """Write a closing row ``after`` (an interval) the last ``ts_col`` of ``df`` to the control folder ``path``.

    It carries the watermark past every window of the data, so the last ones
    are emitted as well; all other columns are NULL, so no job emits anything for it.
    """
    last = df.agg((F.max(ts_col) + F.expr(f"INTERVAL {after}")).alias(ts_col))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != ts_col else F.col(ts_col).cast(f.dataType)
             for f in df.schema]
    last.select(*nulls).write.mode("append").parquet(path)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                control: str | None = None) -> DataFrame:
    """File stream of ``path``, together with the closing rows of the control folder if one is given."""
    reader = spark.readStream.schema(schema)
    if control:
        # The folder has to exist when the query starts; it holds no row until the stream is closed.
        spark.createDataFrame([], schema).write.mode("append").parquet(control)
    data = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
    return data.unionByName(spark.readStream.schema(schema).parquet(control)) if control else data


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def prefer_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk, checkpointed) unless the
    session already chose a provider; the default in-heap store grows with the number of keys."""
    current = spark.conf.get(STATE_PROVIDER, None)
    if current is None or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)


def run_available(df: DataFrame, out_path: str, checkpoint: str, timeout_s: float | None = None,
                  output_mode: str = "append") -> None:
    """Run a streaming frame to an append Parquet sink until all available input is processed.

    Waits as long as that takes unless the caller sets ``timeout_s``.
    """
    prefer_rocksdb_state(df.sparkSession)
    q = (df.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
         .option("path", out_path).trigger(availableNow=True).start())
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() is None
        if not finished:
            raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, timeout_s: float | None = None) -> None:
    """Run a streaming frame through ``handle(batch, batch_id)`` until all available input is processed."""
    prefer_rocksdb_state(df.sparkSession)
    q = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() is None
        if not finished:
            raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()


def write_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch's rows to its own folder; a replay of the batch replaces them."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_once`` wrote, with the ``batch_id`` of every row."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).option("basePath", path).parquet(path)


def stream_monitor(stream: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Tumbling per-client windows with the suspicious-rule flags; windows close at the watermark."""
    ts_type = stream.schema["txn_ts"].dataType
    # Watermarks need an instant (TIMESTAMP); wall-clock (NTZ) input is read in the session time zone.
    flagged = flag_suspicious(stream).withColumn("_event_time", F.col("txn_ts").cast("timestamp"))
    return (
        flagged.withWatermark("_event_time", watermark)
        .groupBy(F.window("_event_time", window).alias("w"), "client_id")
        .agg(
            F.count("txn_id").alias("n_txn"),
            F.sum("amount").cast("double").alias("total_amount"),
            F.count_if(F.col("is_suspicious")).alias("n_suspicious"),
        )
        .filter(F.col("n_txn") > 0)  # a closing row has no transaction (a filter on its key would be pushed below the watermark)
        .select("client_id", F.col("w.start").cast(ts_type).alias("window_start"),
                F.col("w.end").cast(ts_type).alias("window_end"), "n_txn", "total_amount", "n_suspicious")
    )


def stream_bursts(stream: DataFrame, gap_seconds: int = 60, min_txns: int = 2, watermark: str = "1 hour") -> DataFrame:
    """Runs of transactions of a client with at most ``gap_seconds`` between neighbours; emitted once the watermark closes them."""
    ts_type = stream.schema["txn_ts"].dataType
    timed = stream.withColumn("txn_ts", F.col("txn_ts").cast("timestamp")).withWatermark("txn_ts", watermark)
    found = burst_sessions(timed, gap_seconds, min_txns)
    return found.withColumns({c: F.col(c).cast(ts_type) for c in ("burst_start", "burst_end")})


def stream_scores(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """Validate each arriving request; score the valid ones (stateless, per micro-batch)."""
    valid = validate_requests(stream).filter("is_valid")
    return score_requests(model, valid)


def answer_batches(score: Callable[[DataFrame], DataFrame], answers: str, rejections: str) -> Callable[[DataFrame, int], None]:
    """Handler of micro-batches of requests with two sinks: valid requests are scored by ``score`` and written to
    ``answers``, the others to ``rejections`` with their reasons.  Every request is in exactly one of them, also
    when a batch that failed between the two writes is run again."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = validate_requests(batch).persist()  # read by both sinks; recomputed from the batch if lost
        try:
            write_once(score(checked.filter("is_valid")), answers, batch_id)
            write_once(checked.filter("NOT is_valid").drop("is_valid"), rejections, batch_id)
        finally:
            checked.unpersist()

    return handle


# ------------------------------------------------------------------ one prediction per key


def stream_reuse(stream: DataFrame, score: Callable[[DataFrame], DataFrame], value_cols: list[str], key: str = "cache_key",
                 ts_col: str = "ts", id_col: str = "event_id", ttl_seconds: int = C.CACHE_TTL_SECONDS, lateness_seconds: int = 3600) -> DataFrame:
    """Requests with ``value_cols`` of one prediction per (key, slice of one TTL), and ``scored_by``, the request that was scored.

    The first request to arrive of every (key, slice) is let through by ``dropDuplicatesWithinWatermark`` and
    scored; a stream-stream join hands its prediction to all requests of the slice, whichever micro-batch they
    come in.  The watermark trails by a TTL and the lateness, so a slice is remembered until its last request.
    """
    micros = epoch_micros(ts_col, stream.schema[ts_col].dataType)
    timed = stream.withColumns({"slice": F.floor(micros / F.lit(ttl_seconds * 1_000_000)).cast("long"), "_event_time": F.col(ts_col).cast("timestamp")})
    timed = timed.withWatermark("_event_time", f"{ttl_seconds + lateness_seconds} seconds")
    firsts = timed.filter(F.col(id_col).isNotNull()).dropDuplicatesWithinWatermark([key, "slice"])
    scored = score(firsts).select(F.col(key).alias("_key"), F.col("slice").alias("_slice"), F.col(id_col).alias("scored_by"),
                                  F.col("_event_time").alias("_scored_time"), *value_cols)
    near = F.expr(f"_scored_time BETWEEN _event_time - INTERVAL {ttl_seconds} SECONDS AND _event_time + INTERVAL {ttl_seconds} SECONDS")
    same = (F.col(key) == F.col("_key")) & (F.col("slice") == F.col("_slice"))
    return timed.join(scored, same & near, "inner").drop("_key", "_slice", "_event_time", "_scored_time")


# ------------------------------------------------------------------ TTL cache

HELD = "t long, id long"
CLOSED = "cache_key string, slice long, t long, id long"


class HoldSlice(StatefulProcessor):
    """Holds the requests of one (key, slice of time) until the watermark has passed the slice, then emits them in order of time.

    A request of a slice that the watermark has passed already is emitted at once, without a slice.
    """

    def __init__(self, width_us: int):
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", HELD)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        end_ms = (key[1] + 1) * self.width_us // 1000
        late = end_ms <= timerValues.getCurrentWatermarkInMs()
        for r in rows:
            if r.id is None:  # a closing row only moves the watermark
                continue
            if late:
                yield Row(cache_key=key[0], slice=None, t=r.t, id=r.id)
            else:
                self.rows.appendValue((r.t, r.id))
        if not late and self.rows.exists():
            self.handle.registerTimer(end_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = sorted((r[0], r[1]) for r in self.rows.get())
        self.rows.clear()
        for t, i in held:
            yield Row(cache_key=key[0], slice=key[1], t=t, id=i)

    def close(self) -> None:
        pass


def closed_slices(stream: DataFrame, key: str = "cache_key", ts_col: str = "ts", id_col: str = "event_id",
                  ttl_seconds: int = C.CACHE_TTL_SECONDS, watermark: str = "1 hour") -> DataFrame:
    """(cache_key, slice, t, id): the requests of every (key, slice of time) once the watermark has passed it, whatever order they
    came in; those that came later than that have no slice."""
    width = TTL.SLICE_TTLS * ttl_seconds * 1_000_000
    timed = stream.select(
        F.col(key).alias("cache_key"), epoch_micros(ts_col, stream.schema[ts_col].dataType).alias("t"), F.col(id_col).cast("long").alias("id"),
        F.col(ts_col).cast("timestamp").alias("_event_time")).withColumn("slice", F.floor(F.col("t") / F.lit(width)).cast("long"))
    return timed.withWatermark("_event_time", watermark).groupBy("cache_key", "slice").transformWithState(
        statefulProcessor=HoldSlice(width), outputStructType=CLOSED, outputMode="Append", timeMode="EventTime")


CACHE_OUT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("cache_key", T.StringType()),
                          T.StructField("t_us", T.LongType()), T.StructField("from_cache", T.BooleanType())])
ENTRIES = T.StructType([T.StructField("cache_key", T.StringType()), T.StructField("expiry_us", T.LongType())])


def cache_batches(answers: str, entries: str, ttl_seconds: int = C.CACHE_TTL_SECONDS) -> Callable[[DataFrame, int], None]:
    """Handler of micro-batches of ``closed_slices``: the requests are answered by the batch replay, starting with the
    entries that the batch before handed over, and the entries after them are handed on.

    A key's slices are replayed in several tasks, and come in order over the batches.  Answers and entries are
    folders per batch, so a replayed batch reads the same entries and replaces its own results.
    """
    ttl = ttl_seconds * 1_000_000
    width = TTL.SLICE_TTLS * ttl

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        came = batch.select("cache_key", F.timestamp_micros("t").alias("ts"), F.col("id").alias("event_id"), "slice").checkpoint()
        closed, late = came.filter("slice IS NOT NULL"), came.filter("slice IS NULL").withColumn("from_cache", F.lit(False))
        known = read_batches(spark, f"{entries}/of", ENTRIES).filter(F.col("batch_id") == batch_id - 1) if batch_id else None
        done = cache_fills(closed, "cache_key", "ts", "event_id", ttl_seconds, known).checkpoint()
        write_once(done.unionByName(late, allowMissingColumns=True).select("event_id", "cache_key", F.unix_micros("ts").alias("t_us"), "from_cache"),
                   answers, batch_id)
        last = done.groupBy("cache_key").agg((F.max("filled_us") + ttl).alias("expiry_us"))
        if known is not None:
            last = last.unionByName(known.select("cache_key", "expiry_us")).groupBy("cache_key").agg(F.max("expiry_us").alias("expiry_us"))
        # Slices still to come end after the last one here: an entry that ends before they begin is of no use.
        begin = closed.agg(F.max("slice")).first()[0]
        write_once(last if begin is None else last.filter(F.col("expiry_us") > begin * width), f"{entries}/of", batch_id)

    return handle


def stream_cache(stream: DataFrame, name: str, key: str = "cache_key", ts_col: str = "ts", id_col: str = "event_id",
                 ttl_seconds: int = C.CACHE_TTL_SECONDS, watermark: str = "1 hour", checkpoint: str | None = None) -> DataFrame:
    """TTL cache replay on a stream, run over all available input; returns the answers (``CACHE_OUT`` and ``batch_id``).

    Requests may come in any order within the watermark: they are held as keyed state per (key, slice of time)
    until the watermark has passed the slice, and answered as the batch replay answers them.  Requests of slices
    that have been closed are misses that fill nothing.  Requests of slices that are still open stay in the state.
    """
    spark = stream.sparkSession
    base = checkpoint or work_path(spark, name)
    answers, entries = f"{base}/answers", f"{base}/entries"
    run_batches(closed_slices(stream, key, ts_col, id_col, ttl_seconds, watermark), cache_batches(answers, entries, ttl_seconds), f"{base}/ckpt")
    return read_batches(spark, answers, CACHE_OUT)


def run_to_table(spark: SparkSession, stream_df: DataFrame, name: str, timeout_s: float | None = None, ckpt: str | None = None,
                 out: str | None = None) -> DataFrame:
    """Run a streaming frame with availableNow into a work folder (a fresh one, unless given) and return the result table."""
    out = out or work_path(spark, f"{name}_out")
    run_available(stream_df, out, ckpt or work_path(spark, f"{name}_ckpt"), timeout_s)
    return spark.read.schema(stream_df.schema).parquet(out)


def run_to_the_end(spark: SparkSession, stream_df: DataFrame, name: str, data: DataFrame, control: str, ts_col: str, after: str,
                   ckpt: str | None = None, out: str | None = None) -> DataFrame:
    """Run a streaming frame over all available input, close its stream and run what the closing row lets go.

    With the folders of an earlier run it goes on where that one stopped.
    """
    out, ckpt = out or work_path(spark, f"{name}_out"), ckpt or work_path(spark, f"{name}_ckpt")
    run_to_table(spark, stream_df, name, ckpt=ckpt, out=out)
    close_stream(data, control, ts_col, after)
    return run_to_table(spark, stream_df, name, ckpt=ckpt, out=out)

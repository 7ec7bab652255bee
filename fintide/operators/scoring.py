"""Batch scoring of request tables: validation, cache keys, prediction reuse, TTL cache replay.

The request/response service becomes table operations:

* ``validate_requests`` attaches an array of reasons; valid and rejected rows
  are two filters of the same frame (nothing throws on a bad row).
* ``cache_hits`` replays a TTL cache over timestamped requests exactly: a
  request is a miss when no earlier miss of the same key is younger than the
  TTL.  This is a sequential fold per key; it is computed as a scan over
  slices of time (``fintide.operators.ttl``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide import config as C
from fintide.functions.columns import age_group_code, plain_number
from fintide.operators import ttl
from fintide.operators.model import score_features
from fintide.session import ensure_checkpoint_dir

AGE_GROUPS = list(C.AGE_GROUP_CODES)


def validation_reasons() -> Column:
    """array<string> of everything wrong with a request row (empty when valid).

    NaN is out of range in every numeric field, whether or not the field has an upper bound.
    """
    checks: list[Column] = []
    for field in C.REQUEST_FIELDS:
        checks.append(F.when(F.col(field).isNull(), F.lit(f"{field}: required")))
    for field, (lo, hi) in C.REQUEST_RANGES.items():
        bad = F.isnan(F.col(field).cast("double"))
        if lo is not None:
            bad = bad | (F.col(field) < lo)
        if hi is not None:
            bad = bad | (F.col(field) > hi)
        checks.append(F.when(bad, F.lit(f"{field}: out of range")))
    checks.append(F.when(~F.col("age_group").isin(AGE_GROUPS),
                         F.lit("age_group: must be one of " + "/".join(AGE_GROUPS))))
    return F.array_compact(F.array(*checks))


def validate_requests(df: DataFrame, digits: int = 2) -> DataFrame:
    """Add ``reasons`` and ``is_valid``; percentages of the row are rounded to ``digits``."""
    return df.withColumn("reasons", validation_reasons()).withColumns(
        {
            "is_valid": F.size("reasons") == 0,
            "equity_pct": F.round("equity_pct", digits),
            "debt_pct": F.round("debt_pct", digits),
            "gold_pct": F.round("gold_pct", digits),
        }
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate_requests(df)
    return v.filter("is_valid"), v.filter("NOT is_valid")


def encode_requests(df: DataFrame) -> DataFrame:
    """Add the model inputs (age_group_encoded) next to the numeric request fields."""
    return df.withColumn("age_group_encoded", age_group_code("age_group"))


def request_key(namespace: str = "portfolio:risk") -> Column:
    """'<namespace>:<client_id>:<md5 of the 7 features joined by _>' — equal rows, equal keys."""
    parts = [
        plain_number("equity_pct"), plain_number("debt_pct"), plain_number("gold_pct"),
        F.col("total_num_funds").cast("string"), plain_number("years_invested"), plain_number("aum_lakh"),
        F.col("age_group"),
    ]
    return F.concat(F.lit(namespace + ":"), F.col("client_id"), F.lit(":"), F.md5(F.concat_ws("_", *parts)))


def score_requests(model: PipelineModel, df: DataFrame, scored_at: Column | None = None) -> DataFrame:
    """Valid requests → prediction, decoded label, confidence, model version, time."""
    scored = score_features(model, encode_requests(df))
    return scored.select(
        "client_id",
        F.col("predicted_profile").alias("risk_profile"),
        "confidence",
        F.lit(False).alias("from_cache"),
        (scored_at if scored_at is not None else F.current_timestamp()).alias("prediction_time"),
        F.lit(C.MODEL_VERSION).alias("model_version"),
    )


# ------------------------------------------------------------------ TTL cache


def epoch_micros(c: str | Column, dtype: T.DataType) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), x)
    return F.unix_micros(x.cast("timestamp"))


def cache_fills(df: DataFrame, key: str, ts_col: str, id_col: str, ttl_seconds: int = C.CACHE_TTL_SECONDS,
                entries: DataFrame | None = None, slice_ttls: int = ttl.SLICE_TTLS) -> DataFrame:
    """Replay a TTL cache: adds ``from_cache`` (False for the request that filled the entry) and ``filled_us``,
    the time (epoch microseconds) when the entry that answers was filled.

    The scan of ``fintide.operators.ttl``: a fixed number of shuffles however long a run of requests is.
    ``id_col`` must identify requests uniquely; ties in time are ordered by it.  A NULL key is a key of its
    own; a request without a time fills nothing and is a miss.  ``entries`` (key, expiry_us) are entries that
    were filled before the first request's slice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()  # read three times below: materialise the input once, not its whole lineage

    def named(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias("key")

    asked = df.select(named(key), epoch_micros(ts_col, df.schema[ts_col].dataType).alias("t"), F.col(id_col).alias("id"))
    known = None if entries is None else entries.select(named(key), F.col("expiry_us").alias("entry"))
    answers = ttl.replay(asked.filter(F.col("t").isNotNull()), int(ttl_seconds * 1_000_000), known, slice_ttls)
    answers = answers.select(F.col("id").alias(id_col), F.col("from_cache").alias("_hit"), F.col("filled").alias("_filled"))
    return df.join(answers, on=id_col, how="left").withColumns(
        {"from_cache": F.coalesce("_hit", F.lit(False)), "filled_us": F.col("_filled")}).drop("_hit", "_filled")


def cache_hits(df: DataFrame, key: str, ts_col: str, id_col: str,
               ttl_seconds: int = C.CACHE_TTL_SECONDS, slice_ttls: int = ttl.SLICE_TTLS) -> DataFrame:
    """Replay a TTL cache: adds ``from_cache``, see ``cache_fills``."""
    return cache_fills(df, key, ts_col, id_col, ttl_seconds, slice_ttls=slice_ttls).drop("filled_us")


def cache_lookup(requests: DataFrame, store: DataFrame, key: str, ts_col: str, stored_col: str,
                 value_cols: Sequence[str], ttl_seconds: int = C.CACHE_TTL_SECONDS, one_per_key: bool = False) -> DataFrame:
    """Requests against a table of stored predictions: the latest entry of the key stored at or
    before the request is a hit while it is younger than the TTL; otherwise the request misses.

    A store that keeps every version needs an as-of join (per key and chunk, no per-key gathering).  A store
    of which the caller knows that it has one row per key (``one_per_key``) is a plain join on the key.
    """
    from fintide.operators.timeseries import asof_join

    entries = store.select(key, stored_col, *value_cols)
    if one_per_key:
        known = F.col(stored_col) <= F.col(ts_col)
        found = requests.join(entries, on=key, how="left").withColumns(
            {c: F.when(known, F.col(c)) for c in [*value_cols, stored_col]})
        found = found.select(*requests.columns, stored_col, *value_cols)
    else:
        found = asof_join(requests, entries, [key], ts_col, stored_col, list(value_cols))
    age_ok = F.col(ts_col) < F.col(stored_col) + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return found.withColumn("from_cache", F.coalesce(age_ok, F.lit(False)))


def request_flow(asked: DataFrame, id_col: str, ts_col: str, score: Callable[[DataFrame], DataFrame],
                 value_cols: Sequence[str], ttl_seconds: int = C.CACHE_TTL_SECONDS) -> DataFrame:
    """Validated requests (``reasons``, features, client_id) → one answer per request.

    Adds status ('rejected', 'scored' or 'hit'), from_cache, ``value_cols`` and
    stored_at.  A request that finds no fresh entry of its key is scored by
    ``score`` and stores its values; later ones take them until the TTL ends:
    the replay names the fill that answers a request, so values are joined on
    (key, time of the fill).  Rejected requests keep their reasons and have no values.
    """
    ok = F.size("reasons") == 0
    answers = [F.lit(None).cast("timestamp_ntz" if isinstance(asked.schema[ts_col].dataType, T.TimestampNTZType)
                                else "timestamp").alias("stored_at")]
    valid = cache_fills(asked.filter(ok).withColumn("_key", request_key()), "_key", ts_col, id_col, ttl_seconds).checkpoint()
    fills = score(valid.filter(~F.col("from_cache"))).select("_key", "filled_us", F.col(ts_col).alias("stored_at"), *value_cols)
    done = valid.join(fills, on=["_key", "filled_us"], how="left").withColumn(
        "status", F.when(F.col("from_cache"), "hit").otherwise("scored"))
    done = done.select(*asked.columns, "stored_at", "from_cache", "status", *value_cols)
    types = {f.name: f.dataType for f in done.schema}
    refused = asked.filter(~ok).select(
        *asked.columns, *answers, F.lit(False).alias("from_cache"), F.lit("rejected").alias("status"),
        *[F.lit(None).cast(types[c]).alias(c) for c in value_cols])
    return done.unionByName(refused)


def hit_rate(df: DataFrame, flag: str = "from_cache", digits: int = 4) -> DataFrame:
    """requests, hits, misses, hit_rate in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col(flag)).alias("hits"),
        F.count_if(~F.col(flag)).alias("misses"),
    ).withColumn("hit_rate", F.round(F.try_divide(F.col("hits").cast("double"), F.col("requests")), digits))


def requests_from_features(features: DataFrame, broken: Sequence[tuple[int, str]] = ((7, "equity"), (11, "age"),
                                                                                      (13, "years"))) -> DataFrame:
    """Scoring requests derived from a feature table, with some rows broken on purpose.

    Client number divisible by 7 → equity_pct 150; by 11 → unknown age group;
    by 13 → years_invested missing.
    """
    n = F.substring("client_id", 4, 64).cast("bigint")
    age = F.element_at(F.array(*[F.lit(a) for a in AGE_GROUPS]), F.col("age_group_encoded") + 1)
    cols = {
        "equity_pct": F.col("equity_pct"),
        "age_group": age,
        "years_invested": F.col("years_invested"),
    }
    for mod, what in broken:
        if what == "equity":
            cols["equity_pct"] = F.when(n % mod == 0, F.lit(150.0)).otherwise(cols["equity_pct"])
        elif what == "age":
            cols["age_group"] = F.when(n % mod == 0, F.lit("Baby")).otherwise(cols["age_group"])
        elif what == "years":
            cols["years_invested"] = F.when(n % mod == 0, F.lit(None).cast("double")).otherwise(cols["years_invested"])
    return features.select(
        "client_id", cols["equity_pct"].alias("equity_pct"), "debt_pct", "gold_pct", "total_num_funds",
        cols["years_invested"].alias("years_invested"), "aum_lakh", cols["age_group"].alias("age_group"),
    )

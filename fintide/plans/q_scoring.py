"""Request validation, cache keys, TTL cache replay, hit rate, model scoring with prediction reuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from fintide import config as C
from fintide.functions.columns import feature_vector
from fintide.operators import metrics as M
from fintide.operators import model as ML
from fintide.operators import scoring as S
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.plans.oracle_views import rnd, with_views
from fintide.plans.q_ml import trained
from fintide.sources import testviews as tv


def requests(spark, d, features=None):
    return S.requests_from_features(V.features(spark, d) if features is None else features)


def trained_with_features(spark, d):
    """The feature table, materialised once for the training and the requests, and the model fitted on it."""
    features = V.features(spark, d).checkpoint()
    return features, trained(spark, d, features)[1]


def keyed_requests(spark, d, features=None):
    valid, _ = S.split_valid(requests(spark, d, features))
    return valid.withColumn("cache_key", S.request_key())


def events_of_clients(spark, d):
    """Every event is a scoring request by its user at its time."""
    return tv.table(spark, d, "events").select("event_id", tv.padded_id("CLT", F.col("user_id"), 7).alias("client_id"),
                                               "ts")


def timed_requests(spark, d):
    """The events of clients with a valid request, with their cache key."""
    return events_of_clients(spark, d).join(keyed_requests(spark, d).select("client_id", "cache_key"), on="client_id",
                                            how="inner")


@register("request_validation", with_views("""
SELECT client_id, len(reasons) = 0 AS is_valid, CAST(len(reasons) AS INTEGER) AS n_reasons,
       array_to_string(reasons, '; ') AS reasons, equity_pct, debt_pct, gold_pct
FROM validated""", "validated"))
def request_validation(spark, d):
    v = S.validate_requests(requests(spark, d))
    return v.select("client_id", "is_valid", F.size("reasons").alias("n_reasons"),
                    F.concat_ws("; ", "reasons").alias("reasons"), "equity_pct", "debt_pct", "gold_pct")


@register("request_keys", with_views("SELECT client_id, cache_key FROM request_keys", "request_keys"))
def request_keys(spark, d):
    return keyed_requests(spark, d).select("client_id", "cache_key")


TTL_US = C.CACHE_TTL_SECONDS * 1_000_000

_WALK = [
    ("ordered", """
  SELECT cache_key, event_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY cache_key ORDER BY epoch_us(ts), event_id) AS rn
  FROM timed_requests"""),
    ("walk(cache_key, rn, event_id, expiry, hit)", f"""
  SELECT cache_key, rn, event_id, t + {TTL_US}, false FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.cache_key, o.rn, o.event_id, CASE WHEN o.t < w.expiry THEN w.expiry ELSE o.t + {TTL_US} END,
         o.t < w.expiry
  FROM walk w JOIN ordered o ON o.cache_key = w.cache_key AND o.rn = w.rn + 1"""),
]


@register("cache_hits", with_views("""
SELECT r.event_id, r.client_id, r.cache_key, r.ts, w.hit AS from_cache
FROM timed_requests r JOIN walk w ON r.event_id = w.event_id""", "timed_requests", extra=_WALK, recursive=True))
def cache_hits(spark, d):
    return S.cache_hits(timed_requests(spark, d), "cache_key", "ts", "event_id", C.CACHE_TTL_SECONDS).select(
        "event_id", "client_id", "cache_key", "ts", "from_cache")


@register("cache_hit_rate", with_views(f"""
SELECT count(*) AS requests, CAST(count_if(hit) AS BIGINT) AS hits, CAST(count_if(NOT hit) AS BIGINT) AS misses,
       {rnd('CAST(count_if(hit) AS DOUBLE) / count(*)', 4)} AS hit_rate
FROM walk""", "timed_requests", extra=_WALK, recursive=True))
def cache_hit_rate(spark, d):
    return S.hit_rate(cache_hits(spark, d))


@register("request_vectors", with_views("""
SELECT client_id, equity_pct AS f0, debt_pct AS f1, gold_pct AS f2, CAST(total_num_funds AS DOUBLE) AS f3, years_invested AS f4,
       aum_lakh AS f5, CAST(CASE age_group WHEN 'Young' THEN 0 WHEN 'Middle-Aged' THEN 1 ELSE 2 END AS DOUBLE) AS f6, 7 AS size
FROM validated WHERE len(reasons) = 0""", "validated"))
def request_vectors(spark, d):
    """Valid requests as the model's input: seven numbers in the model's order."""
    valid, _ = S.split_valid(requests(spark, d))
    v = S.encode_requests(valid).select("client_id", feature_vector().alias("v"))
    return v.select("client_id", *[F.col("v")[i].alias(f"f{i}") for i in range(7)], F.size("v").alias("size"))


@register("score_requests")
def score_requests(spark, d):
    features, model = trained_with_features(spark, d)
    valid, _ = S.split_valid(requests(spark, d, features))
    return S.score_requests(model, valid)


def _answered(scored):
    return scored.select(
        "client_id", F.col("risk_profile").isin(C.RISK_CLASSES).alias("known_class"),
        F.col("confidence").isin("High", "Medium", "Low").alias("known_confidence"), "from_cache", "model_version")


_ANSWERED_SQL = with_views(f"""
SELECT client_id, true AS known_class, true AS known_confidence, false AS from_cache, '{C.MODEL_VERSION}' AS model_version
FROM request_keys""", "request_keys")


@register("score_requests_answers", _ANSWERED_SQL)
def score_requests_answers(spark, d):
    """Every valid request answered once, with a class, a confidence and the model's version."""
    return _answered(score_requests(spark, d))


@register("scored_with_reuse")
def scored_with_reuse(spark, d):
    """Every timed request answered; the model runs once per distinct cache key (a client has one)."""
    features, model = trained_with_features(spark, d)
    scored = ML.score_features(model, S.encode_requests(keyed_requests(spark, d, features))).select(
        "client_id", "cache_key", F.col("predicted_profile").alias("risk_profile"), "confidence")
    return events_of_clients(spark, d).join(scored, on="client_id").select(
        "event_id", "client_id", "cache_key", "risk_profile", "confidence")


@register("scored_with_reuse_answers", with_views("""
SELECT event_id, cache_key, 1::BIGINT AS answers, 1::BIGINT AS answers_of_key FROM timed_requests""", "timed_requests"))
def scored_with_reuse_answers(spark, d):
    """One answer per request, and one prediction per key whatever its requests."""
    scored = scored_with_reuse(spark, d).checkpoint()
    keys = scored.groupBy("cache_key").agg(F.countDistinct("risk_profile", "confidence").alias("answers_of_key"))
    return scored.groupBy("event_id", "cache_key").agg(F.count(F.lit(1)).alias("answers")).join(keys, "cache_key").select(
        "event_id", "cache_key", "answers", "answers_of_key")


_RULE = "CASE WHEN equity_pct >= 60 THEN 'Aggressive' WHEN debt_pct >= 50 THEN 'Conservative' ELSE 'Moderate' END"


@register("cache_lookup", with_views(f"""
SELECT r.event_id, r.cache_key, r.ts, s.stored_at,
       coalesce(r.ts < s.stored_at + INTERVAL {C.CACHE_TTL_SECONDS} SECOND, false) AS from_cache,
       CASE WHEN coalesce(r.ts < s.stored_at + INTERVAL {C.CACHE_TTL_SECONDS} SECOND, false) THEN s.stored
            ELSE v.profile END AS risk_profile
FROM timed_requests r
JOIN (SELECT client_id, {_RULE} AS profile FROM validated) v ON v.client_id = r.client_id
ASOF LEFT JOIN (SELECT t.cache_key, date_trunc('day', min(ts)) + INTERVAL 12 HOUR AS stored_at,
                       any_value({_RULE}) || ' (stored)' AS stored
                FROM timed_requests t JOIN validated f ON t.client_id = f.client_id GROUP BY t.cache_key) s
  ON r.cache_key = s.cache_key AND r.ts >= s.stored_at""", "timed_requests", "validated"))
def cache_lookup(spark, d):
    """Each key's prediction stored once, at noon of its first request day; requests take the stored
    value while it is fresh and are scored (by the allocation rule) otherwise."""
    ruled = keyed_requests(spark, d).withColumn("profile", M.rule_prediction()).select("client_id", "cache_key", "profile")
    reqs = events_of_clients(spark, d).join(ruled, on="client_id").checkpoint()  # read by both join sides
    store = reqs.groupBy("cache_key").agg(
        (F.date_trunc("day", F.min("ts")).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(12)))
        .alias("stored_at"), F.concat(F.min("profile"), F.lit(" (stored)")).alias("stored"))
    found = S.cache_lookup(reqs, store, "cache_key", "ts", "stored_at", ["stored"], one_per_key=True)
    return found.select("event_id", "cache_key", "ts", "stored_at", "from_cache",
                        F.when(F.col("from_cache"), F.col("stored")).otherwise(F.col("profile")).alias("risk_profile"))


@register("request_flow", with_views(f"""
SELECT e.event_id, printf('CLT%07d', e.user_id) AS client_id, e.ts,
       CASE WHEN w.event_id IS NULL THEN 'rejected' WHEN w.hit THEN 'hit' ELSE 'scored' END AS status,
       CASE WHEN v.client_id IS NULL THEN 'client_id: unknown' ELSE array_to_string(v.reasons, '; ') END AS reasons,
       coalesce(w.hit, false) AS from_cache,
       CASE WHEN w.event_id IS NOT NULL THEN {_RULE} END AS risk_profile,
       make_timestamp(w.expiry - {TTL_US}) AS stored_at
FROM events e LEFT JOIN validated v ON v.client_id = printf('CLT%07d', e.user_id)
LEFT JOIN walk w ON w.event_id = e.event_id""", "timed_requests", "validated", extra=_WALK, recursive=True))
def request_flow(spark, d):
    """Every event answered: rejected with its reasons, scored (and stored), or given the stored value."""
    checked = S.validate_requests(requests(spark, d))
    asked = events_of_clients(spark, d).join(checked, on="client_id", how="left")
    asked = asked.withColumn("reasons", F.coalesce("reasons", F.array(F.lit("client_id: unknown"))))
    out = S.request_flow(asked, "event_id", "ts", lambda df: df.withColumn("risk_profile", M.rule_prediction()),
                         ["risk_profile"])
    return out.select("event_id", "client_id", "ts", "status", F.concat_ws("; ", "reasons").alias("reasons"), "from_cache",
                      "risk_profile", "stored_at")


@register("request_outcomes", with_views("""
SELECT CASE WHEN w.event_id IS NULL THEN 'rejected' WHEN w.hit THEN 'hit' ELSE 'scored' END AS status, v.client_id IS NULL AS unknown_client,
       count(*) AS requests, count(DISTINCT e.user_id) AS clients
FROM events e LEFT JOIN validated v ON v.client_id = printf('CLT%07d', e.user_id) LEFT JOIN walk w ON w.event_id = e.event_id
GROUP BY ALL""", "timed_requests", "validated", extra=_WALK, recursive=True))
def request_outcomes(spark, d):
    """All requests by outcome: the rejected ones count too."""
    done = request_flow(spark, d)
    return done.groupBy("status", (F.col("reasons") == "client_id: unknown").alias("unknown_client")).agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("client_id").alias("clients"))

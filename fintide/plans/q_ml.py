"""Feature table, imputation, split, class weights, metrics and the Spark ML model."""

from __future__ import annotations

from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators import features as FE
from fintide.operators import metrics as M
from fintide.operators import model as ML
from fintide.plans import views as V
from fintide.plans.catalog import register
from fintide.functions.columns import hash_uniform
from fintide.plans.oracle_views import rnd, uniform, with_views

FEATURE_TABLE_COLS = ("client_id, equity_pct, debt_pct, gold_pct, total_num_funds, years_invested, aum_lakh, "
                      "age_group_encoded, target")

@register("training_features", with_views(f"SELECT {FEATURE_TABLE_COLS} FROM training_features",
                                          "training_features"))
def training_features(spark, d):
    return V.features(spark, d)


_GAPS = ("gaps", "SELECT client_id, target, " + ", ".join(
    f"CASE WHEN CAST(substr(client_id, 4) AS BIGINT) % {5 + i} <> 0 THEN {c} END AS {c}"
    for i, c in enumerate(C.FEATURE_COLS)) + " FROM training_features")
_MEDIANS = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in C.FEATURE_COLS)


@register("imputed_features", with_views(f"""
SELECT g.client_id, {', '.join(f'coalesce(CAST(g.{c} AS DOUBLE), m.m_{c}, 0) AS {c}' for c in C.FEATURE_COLS)}, g.target
FROM gaps g CROSS JOIN (SELECT {_MEDIANS} FROM gaps) m""", "training_features", extra=[_GAPS]))
def imputed_features(spark, d):
    filled, _ = FE.impute_median(V.features_with_gaps(spark, d), C.FEATURE_COLS)
    return filled.select("client_id", *C.FEATURE_COLS, "target")


@register("median_report", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count, median(CAST({c} AS DOUBLE)) AS median "
    "FROM gaps" for c in C.FEATURE_COLS), "training_features", extra=[_GAPS]))
def median_report(spark, d):
    _, report = FE.impute_median(V.features_with_gaps(spark, d), C.FEATURE_COLS)
    return report


@register("class_weights", with_views("""
SELECT target, n_class, CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class) AS weight
FROM (SELECT target, count(*) AS n_class FROM training_features GROUP BY target) t""", "training_features"))
def class_weights(spark, d):
    return FE.class_weights(V.features(spark, d), "target")


_QUOTA_CTE = ("quota", """
  SELECT target, n_class, base + CASE WHEN rk <= extra THEN 1 ELSE 0 END AS n_test FROM (
    SELECT *, t_total - sum(base) OVER () AS extra, row_number() OVER (ORDER BY rem DESC, target) AS rk FROM (
      SELECT target, n_class, t_total, (t_total * n_class) // n AS base, (t_total * n_class) % n AS rem FROM (
        SELECT target, n_class, sum(n_class) OVER () AS n, (sum(n_class) OVER () + 4) // 5 AS t_total
        FROM (SELECT target, count(*) AS n_class FROM training_features GROUP BY target) a) b) c) d""")

_RANKED_CTE = ("ranked", """
  SELECT client_id, target,
         row_number() OVER (PARTITION BY target ORDER BY md5(client_id || ':42'), client_id) AS rn
  FROM training_features""")

_SPLIT_CTE = ("split_rows", """
  SELECT r.client_id, r.target, CASE WHEN r.rn <= q.n_test THEN 'test' ELSE 'train' END AS split
  FROM ranked r JOIN quota q ON r.target = q.target""")


@register("stratified_split", with_views("SELECT client_id, target, split FROM split_rows", "training_features",
                                         extra=[_QUOTA_CTE, _RANKED_CTE, _SPLIT_CTE]))
def stratified_split(spark, d):
    assert C.TEST_SIZE == 0.2 and C.SEED == 42  # the oracle text spells these out
    return FE.stratified_split(V.features(spark, d), "client_id", "target", C.TEST_SIZE, C.SEED).select(
        "client_id", "target", "split")


@register("stratified_split_counts", with_views("""
SELECT target, count(*) AS n_class, CAST(count_if(split = 'train') AS BIGINT) AS n_train,
       CAST(count_if(split = 'test') AS BIGINT) AS n_test
FROM split_rows GROUP BY target""", "training_features", extra=[_QUOTA_CTE, _RANKED_CTE, _SPLIT_CTE]))
def stratified_split_counts(spark, d):
    split = FE.stratified_split(V.features(spark, d), "client_id", "target", C.TEST_SIZE, C.SEED)
    return split.groupBy("target").agg(
        F.count(F.lit(1)).alias("n_class"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
    )


_RULE_SQL = ("CASE WHEN equity_pct >= 60 THEN 'Aggressive' WHEN debt_pct >= 50 THEN 'Conservative' "
             "ELSE 'Moderate' END")


def _with_rule(spark, d):
    return V.features(spark, d).withColumn("prediction", M.rule_prediction())


@register("confusion_matrix", with_views(f"""
SELECT target AS actual, {', '.join(f"CAST(count_if(pred = '{c}') AS BIGINT) AS {c}" for c in C.RISK_CLASSES)}
FROM (SELECT target, {_RULE_SQL} AS pred FROM training_features) t GROUP BY target""", "training_features"))
def confusion_matrix(spark, d):
    return M.confusion(_with_rule(spark, d), "target", "prediction")


def _report_sql() -> str:
    classes = ", ".join(f"('{c}')" for c in C.RISK_CLASSES)
    k = len(C.RISK_CLASSES)
    return with_views(f"""
SELECT class, {rnd('precision', 6)} AS precision, {rnd('recall', 6)} AS recall, {rnd('f1', 6)} AS f1, support
FROM (
  SELECT class, precision, recall, f1, support FROM per_class
  UNION ALL SELECT 'macro avg', sum(precision) / {k}, sum(recall) / {k}, sum(f1) / {k}, max(n) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / max(n), sum(recall * support) / max(n),
                   sum(f1 * support) / max(n), max(n) FROM per_class
  UNION ALL SELECT 'accuracy', NULL, NULL, CAST(max(correct) AS DOUBLE) / max(n), max(n) FROM per_class
) u""", "training_features", extra=[
        ("pred", f"SELECT target, {_RULE_SQL} AS pred FROM training_features"),
        ("counts", f"""
  SELECT c.class, count_if(p.target = c.class AND p.pred = c.class) AS tp, count_if(p.pred = c.class) AS pp,
         count_if(p.target = c.class) AS support
  FROM (VALUES {classes}) c(class) CROSS JOIN pred p GROUP BY c.class"""),
        ("tot", "SELECT count(*) AS n, count_if(target = pred) AS correct FROM pred"),
        ("pr", """
  SELECT class, support, n, correct,
         CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall
  FROM counts CROSS JOIN tot"""),
        ("per_class", """
  SELECT class, precision, recall,
         CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
         CAST(support AS BIGINT) AS support, CAST(n AS BIGINT) AS n, correct FROM pr"""),
    ])


@register("classification_report", _report_sql())
def classification_report(spark, d):
    return M.class_report(_with_rule(spark, d), "target", "prediction")


@register("split_features", with_views(f"""
SELECT {FEATURE_TABLE_COLS.replace('client_id', 'f.client_id').replace('target', 'f.target')}, s.split
FROM training_features f JOIN split_rows s ON f.client_id = s.client_id""", "training_features",
                                       extra=[_QUOTA_CTE, _RANKED_CTE, _SPLIT_CTE]))
def split_features(spark, d):
    """The split with every feature kept."""
    return FE.stratified_split(V.features(spark, d), "client_id", "target", C.TEST_SIZE, C.SEED)


def trained(spark, d, features=None):
    """The split feature table (imputed) and the model fitted on its training rows; ``features`` if the caller holds them already."""
    filled, _ = FE.impute_median(V.features(spark, d) if features is None else features, C.FEATURE_COLS)
    split = FE.stratified_split(filled, "client_id", "target", C.TEST_SIZE, C.SEED).checkpoint()
    return split, ML.fit_risk_model(split.filter(F.col("split") == "train"))


@register("risk_model_metrics")
def risk_model_metrics(spark, d):
    split, model = trained(spark, d)
    test = ML.score_features(model, split.filter(F.col("split") == "test"))
    m = M.accuracy_and_macro_f1(test, "target", "predicted_profile")
    n_train = split.filter(F.col("split") == "train").count()
    return m.select(F.col("n").alias("test_rows"), F.lit(n_train).alias("training_rows"),
                    F.round("accuracy", 4).alias("accuracy"), F.round("macro_f1", 4).alias("f1_score"))


@register("risk_model_rows", with_views("""
SELECT sum(n_test)::BIGINT AS test_rows, (sum(n_class) - sum(n_test))::BIGINT AS training_rows, sum(n_test)::BIGINT AS confusion_total,
       true AS accuracy_in_range
FROM quota""", "training_features", extra=[_QUOTA_CTE]))
def risk_model_rows(spark, d):
    """What the metrics rest on: rows scored and trained on, the confusion matrix's total, accuracy within 0..1."""
    split, model = trained(spark, d)
    test = ML.score_features(model, split.filter(F.col("split") == "test"))
    table = M.confusion(test, "target", "predicted_profile")
    total = table.agg(F.sum(sum(F.col(c) for c in C.RISK_CLASSES)).alias("confusion_total"))
    rows = split.agg(F.count_if(F.col("split") == "test").alias("test_rows"),
                     F.count_if(F.col("split") == "train").alias("training_rows"))
    share = M.accuracy_and_macro_f1(test, "target", "predicted_profile").select(
        F.col("accuracy").between(0, 1).alias("accuracy_in_range"))
    one = F.lit(1).alias("one")  # three one-row results side by side
    return (rows.select("*", one).join(total.select("*", one), "one").join(share.select("*", one), "one")
            .select("test_rows", "training_rows", "confusion_total", "accuracy_in_range"))


@register("feature_importances")
def feature_importances(spark, d):
    _, model = trained(spark, d)
    return ML.importances(spark, model)


@register("importance_totals", with_views(f"""
SELECT {len(C.FEATURE_COLS)}::BIGINT AS features, 1.0::DOUBLE AS total, 0::BIGINT AS negative
FROM (SELECT count(*) FROM training_features) t""", "training_features"))
def importance_totals(spark, d):
    """Importances cover every feature, add up to one and are never negative."""
    return feature_importances(spark, d).agg(
        F.countDistinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"))


# A target that can be learned: the allocation rule, with one client in ten moved to the next class.
FLIPPED = 0.1
_NEXT = dict(zip(C.RISK_CLASSES, [*C.RISK_CLASSES[1:], C.RISK_CLASSES[0]]))


def learnable(spark, d):
    """The feature table with a target of known Bayes rate, 1 - ``FLIPPED``."""
    ruled = V.features(spark, d).withColumn("rule", M.rule_prediction())
    moved = F.lit(None).cast("string")
    for name, then in _NEXT.items():
        moved = F.when(F.col("rule") == name, F.lit(then)).otherwise(moved)
    flip = hash_uniform("client_id", F.lit("flip"), seed=C.SEED) < FLIPPED
    return ruled.withColumn("target", F.when(flip, moved).otherwise(F.col("rule"))).drop("rule")


_LEARNABLE_CTE = ("learnable", f"""
  SELECT client_id, CASE WHEN {uniform('client_id', "'flip'")} < {FLIPPED} THEN
    CASE rule {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _NEXT.items())} END ELSE rule END AS target
  FROM (SELECT client_id, {_RULE_SQL} AS rule FROM training_features) r""")


@register("risk_model_gate", with_views("""
SELECT sum(n_test)::BIGINT AS test_rows, true AS near_bayes_rate, true AS beats_majority, true AS rule_leads
FROM quota""", "training_features", extra=[_LEARNABLE_CTE, (_QUOTA_CTE[0], _QUOTA_CTE[1].replace("FROM training_features", "FROM learnable"))]))
def risk_model_gate(spark, d):
    """A model fitted on a target of known Bayes rate: its held-out accuracy comes near that rate (within three standard
    errors and five points), it beats the most frequent class, and the rule's two features lead: one is the most important, and
    on average they count for more than the others."""
    filled, _ = FE.impute_median(learnable(spark, d), C.FEATURE_COLS)
    split = FE.stratified_split(filled, "client_id", "target", C.TEST_SIZE, C.SEED).checkpoint()
    model = ML.fit_risk_model(split.filter("split = 'train'"))
    test = ML.score_features(model, split.filter("split = 'test'")).checkpoint()
    most = test.groupBy("target").count().agg(F.max("count").alias("majority"))
    one = F.lit(1).alias("one")  # three one-row results side by side
    got = M.accuracy_and_macro_f1(test, "target", "predicted_profile").select("*", one).join(most.select("*", one), "one")
    in_rule = F.col("feature").isin("equity_pct", "debt_pct")
    leading = ML.importances(spark, model).agg(((F.avg(F.when(in_rule, F.col("importance"))) > F.avg(F.when(~in_rule, F.col("importance"))))
                                                & F.bool_or((F.col("rank") == 1) & in_rule)).alias("rule_leads")).select("*", one)
    bayes = 1.0 - FLIPPED
    floor = F.lit(bayes - 0.05) - 3.0 * F.sqrt(F.lit(bayes * FLIPPED) / F.col("n"))
    return got.join(leading, "one").select(F.col("n").alias("test_rows"), (F.col("accuracy") >= floor).alias("near_bayes_rate"),
                                           (F.col("accuracy") > F.col("majority") / F.col("n")).alias("beats_majority"), "rule_leads")


@register("importance_ranks", with_views(f"""
SELECT r::INTEGER AS rank, 1::BIGINT AS features, true AS in_order
FROM range(1, {len(C.FEATURE_COLS) + 1}) t(r) WHERE (SELECT count(*) FROM training_features) > 0""", "training_features"))
def importance_ranks(spark, d):
    """One feature per rank, and none more important than the one ranked before it."""
    found = feature_importances(spark, d)
    before = found.select((F.col("rank") + 1).alias("rank"), F.col("importance").alias("more"))
    return found.join(before, "rank", "left").groupBy("rank").agg(
        F.count("feature").alias("features"), F.bool_and(F.coalesce(F.col("importance") <= F.col("more"), F.lit(True))).alias("in_order"))


def known_profiles(spark, model):
    """Three fixed profiles with their expected class, scored by ``model`` (pytest only: fixed input)."""
    rows = [
        (85.0, 10.0, 5.0, 6, 3.0, 25.0, 0, "Aggressive"),
        (5.0, 85.0, 10.0, 3, 15.0, 200.0, 2, "Conservative"),
        (45.0, 40.0, 15.0, 4, 7.0, 80.0, 1, "Moderate"),
    ]
    cols = list(C.FEATURE_COLS) + ["expected"]
    probe = spark.createDataFrame(rows, cols)
    return ML.score_features(model, probe).select("expected", "predicted_profile", "confidence")

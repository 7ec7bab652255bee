from pyspark.sql import functions as F

from fintide import config as C
from fintide.operators import metrics as M
from fintide.operators import model as ML
from fintide.operators.features import impute_median, stratified_split
from fintide.plans import views as V
from fintide.plans.q_ml import known_profiles

from conftest import SF_SMALL


def test_model_fit_score_importances(spark):
    filled, _ = impute_median(V.features(spark, SF_SMALL), C.FEATURE_COLS)
    split = stratified_split(filled, "client_id", "target")
    model = ML.fit_risk_model(split.filter("split = 'train'"), num_trees=10, max_depth=4)
    assert ML.class_labels(model) == C.RISK_CLASSES  # alphabetical, as the label encoder orders them
    scored = ML.score_features(model, split.filter("split = 'test'"))
    assert scored.filter(~F.col("predicted_profile").isin(C.RISK_CLASSES)).count() == 0
    assert {r.confidence for r in scored.collect()} <= {"High", "Medium", "Low"}
    imp = ML.importances(spark, model).collect()
    assert [r.feature for r in imp] and abs(sum(r.importance for r in imp) - 1) < 1e-9
    assert imp == sorted(imp, key=lambda r: (-r.importance, r.feature))


def test_known_profiles_on_a_learnable_table(spark):
    """The class follows the allocation: the model must give the three fixed profiles their expected class."""
    rule = M.rule_prediction()
    df = spark.range(3000).select(
        (F.col("id") % 101).cast("double").alias("equity_pct"),
        (F.lit(100) - F.col("id") % 101 - F.col("id") % 11).cast("double").alias("debt_pct"),
        (F.col("id") % 11).cast("double").alias("gold_pct"), (1 + F.col("id") % 9).alias("total_num_funds"),
        (F.col("id") % 20).cast("double").alias("years_invested"), (F.col("id") % 300).cast("double").alias("aum_lakh"),
        (F.col("id") % 3).cast("int").alias("age_group_encoded")).withColumn("target", rule)
    out = known_profiles(spark, ML.fit_risk_model(df, num_trees=20, max_depth=6)).collect()
    assert [r.expected for r in out] == [r.predicted_profile for r in out] == ["Aggressive", "Conservative", "Moderate"]


def test_training_is_reproducible(spark):
    from fintide.plans.q_ml import trained

    one, two = (ML.importances(spark, trained(spark, SF_SMALL)[1]).collect() for _ in range(2))
    assert one == two

from pyspark.sql import functions as F

from fintide.operators import model as ML
from fintide.plans import q_ml


def test_gate_notices_a_bad_model(spark, monkeypatch):
    # A model that learned from shuffled targets must not pass.
    fit = ML.fit_risk_model

    def spoilt(train, *args, **kwargs):
        return fit(train.withColumn("target", F.when(F.xxhash64("client_id") % 3 == 0, "Aggressive").when(
            F.xxhash64("client_id") % 3 == 1, "Moderate").otherwise("Conservative")), *args, **kwargs)

    monkeypatch.setattr(q_ml.ML, "fit_risk_model", spoilt)
    got = q_ml.risk_model_gate(spark, "/root/testdata/sf0.01").first()
    assert not got.near_bayes_rate and not got.beats_majority

"""Risk-profile classifier on Spark ML: fit, score, importances, persistence, run record.

A ``Pipeline`` of StringIndexer (alphabetical labels, as the label encoder
orders them) → VectorAssembler (fixed feature order) → RandomForestClassifier
with balanced class weights.  Tree building is distributed by Spark ML
(per-level statistics aggregated across partitions).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fintide import config as C
from fintide.functions.columns import decode
from fintide.operators.features import with_class_weights


def fit_risk_model(train: DataFrame, features: Sequence[str] = tuple(C.FEATURE_COLS), label: str = "target",
                   seed: int = C.SEED, num_trees: int = C.N_TREES, max_depth: int = C.MAX_DEPTH,
                   min_samples_split: int = C.MIN_SAMPLES_SPLIT, partitions: int = 32) -> PipelineModel:
    """Fit the pipeline on rows with balanced class weights.

    Spark ML has no ``min_samples_split``; the nearest knob is the per-child
    minimum, so a split needs at least ``2·minInstancesPerNode`` rows.

    Bootstrap draws follow the rows' partition and place, so rows are dealt to
    ``partitions`` by a hash of their values and sorted there: the same rows
    give the same forest, however they arrive.
    """
    order = [*features, label]
    weighted = with_class_weights(train, label, "weight").repartition(partitions, *order).sortWithinPartitions(*order)
    weighted = weighted.checkpoint()  # every stage of the fit reads it several times
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc",
                            handleInvalid="error")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=num_trees, maxDepth=max_depth,
        minInstancesPerNode=max(1, min_samples_split // 2), seed=seed, featureSubsetStrategy="sqrt",
    )
    return Pipeline(stages=[indexer, assembler, forest]).fit(weighted)


def class_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labelsArray[0])


def score_features(model: PipelineModel, df: DataFrame, high: float = 0.7, medium: float = 0.5) -> DataFrame:
    """Predict; decode the class index to its label; bucket the top probability into a confidence."""
    labels = class_labels(model)
    forest = model.stages[-1]
    assembled = model.stages[1].transform(df)
    scored = forest.transform(assembled)
    top = F.array_max(vector_to_array("probability"))
    return scored.withColumns(
        {
            "predicted_profile": decode(F.col("prediction").cast("int"), labels),
            "confidence": F.when(top >= high, F.lit("High")).when(top >= medium, F.lit("Medium"))
            .otherwise(F.lit("Low")),
        }
    ).drop("features", "rawPrediction", "probability")


def importances(spark: SparkSession, model: PipelineModel,
                features: Sequence[str] = tuple(C.FEATURE_COLS)) -> DataFrame:
    """(feature, importance, rank) ordered by importance, descending, then name; importances sum to 1."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda r: (-r[1], r[0]))
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType()),
                           T.StructField("rank", T.IntegerType())])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows, 1)], schema)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("recorded_at", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("training_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("importances", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def run_record(spark: SparkSession, run_id: str, params: Mapping[str, object], metrics: Mapping[str, float],
               training_rows: int, test_rows: int, classes: Sequence[str], importances: Mapping[str, float],
               model_type: str = "RandomForestClassifier") -> DataFrame:
    """One-row run record with typed columns — appended to a run table by the caller."""
    row = (run_id, model_type, C.MODEL_VERSION, dt.datetime.now(dt.timezone.utc).isoformat(),
           {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()}, int(training_rows),
           int(test_rows), list(classes), {k: float(v) for k, v in importances.items()})
    return spark.createDataFrame([row], RUN_SCHEMA)

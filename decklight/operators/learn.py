"""A voxel classifier, so that a run goes from training to labelled points."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from decklight.functions.columns import classified_output

from .voxels import BRIDGE, voxel_majority_label, voxel_to_points, voxelize

FEATURES = ["intensity", "height", "n_points"]


def voxel_features(points: DataFrame, size: float) -> DataFrame:
    """Voxels with their mean intensity, height over the cloud's lowest voxel, and number of points."""
    voxels = voxelize(points, size)
    low = voxels.groupBy(*BRIDGE).agg(F.min("vz").alias("low"))
    return voxels.join(low, BRIDGE).withColumn("height", ((F.col("vz") - F.col("low")) * size).cast("double")).drop("low")


def fit_voxel_classifier(points: DataFrame, weights: dict[int, float], size: float = 1.0) -> PipelineModel:
    """Class-weighted multinomial regression on the majority labels."""
    labels = voxel_majority_label(points, size).select(*BRIDGE, "vx", "vy", "vz", "label")
    pairs = [F.lit(x) for c, w in weights.items() for x in (c, float(w))]
    rows = voxel_features(points, size).join(labels, [*BRIDGE, "vx", "vy", "vz"])
    rows = rows.withColumn("weight", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("label")), F.lit(0.0)))
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"), LogisticRegression(weightCol="weight", maxIter=20, family="multinomial")]
    return Pipeline(stages=stages).fit(rows)


def predict_points(points: DataFrame, model, mode: str, size: float = 1.0) -> DataFrame:
    """Voxels, any model's ``prediction`` of them, back to points, output codes by mode."""
    predicted = model.transform(voxel_features(points, size)).withColumn("label", F.col("prediction").cast("int"))
    labelled = voxel_to_points(points.drop("pred"), predicted, size).withColumnRenamed("voxel_label", "pred")
    return classified_output(labelled, mode)

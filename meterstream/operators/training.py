"""Model fitting (M1, M2, M4, A3-A5, A7) on a batch of readings.

The scaler fit is one aggregate job over the input; K-means runs on MLlib
(distributed Lloyd iterations, centres broadcast per iteration); the
threshold is one more aggregate over native distances.  The cleaned
two-column input is persisted once for the scaler fit and the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..model import MeterModel
from .scoring import score, valid_features
from .thresholds import distance_stats, exact_quantile_value


def fit_model(df: DataFrame, features: Sequence[str] = C.FEATURES, k: int = C.KMEANS_K,
              seed: int = C.KMEANS_SEED, max_iter: int = 20, tol: float = 1e-4,
              threshold_rule: str = "mean+3sd") -> tuple[MeterModel, PipelineModel]:
    """Fit scaler + K-means and derive the anomaly threshold.

    ``threshold_rule``: "mean+3sd" (mean + 3 * sample stddev of the training
    distances, null stddev -> 0), "p95" (exact 95th percentile, a few passes)
    or "p95-approx" (one pass, rank error at most n / 10,000).
    Returns the scalar model used for native scoring and the MLlib pipeline.
    """
    features = list(features)
    # Two doubles per row, cached once for the scaler fit and the threshold pass.  K-means
    # keeps its own deserialised vector cache for the Lloyd iterations (measured faster
    # than iterating over a cached DataFrame of vectors).
    clean = valid_features(df.select(*features), features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if clean.isEmpty():
            raise ValueError("no training rows with valid features")
        assembler = VectorAssembler(inputCols=features, outputCol="features_raw", handleInvalid="skip")
        scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
        vec = assembler.transform(clean)
        scaler_model = scaler.fit(vec)
        # row by row: the block solver fails where there are fewer distinct points than k
        km_model = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed,
                          maxIter=max_iter, tol=tol, solver="row").fit(scaler_model.transform(vec))
        centres = tuple(tuple(float(v) for v in c) for c in km_model.clusterCenters())
        stages = [assembler, scaler_model, km_model]
        extra = {"training_cost": float(km_model.summary.trainingCost)}
        partial = MeterModel(
            features=tuple(features),
            mean=tuple(float(v) for v in scaler_model.mean.toArray()),
            std=tuple(float(v) for v in scaler_model.std.toArray()),
            centres=centres, threshold=0.0, threshold_rule=threshold_rule)
        dists = score(clean, partial)
        if threshold_rule == "mean+3sd":
            threshold = distance_stats(dists).first()["threshold"]
        elif threshold_rule == "p95":
            threshold, _ = exact_quantile_value(dists, "dist", 0.95)
        elif threshold_rule == "p95-approx":
            threshold = dists.agg(F.percentile_approx("dist", 0.95, 10000)).first()[0]
        else:
            raise ValueError(f"unknown threshold rule {threshold_rule!r}")
        model = MeterModel(partial.features, partial.mean, partial.std, partial.centres,
                           float(threshold), threshold_rule, extra=extra).validate()
        return model, PipelineModel(stages=stages)
    finally:
        clean.unpersist()

"""Model scoring as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import nearest_centre, standardise
from ..model import MeterModel

ANOMALY_OUTPUT = ("building", "floor", "electricity", "water", "cluster", "dist", "timestamp")


def usable(features=("electricity", "water")) -> Column:
    """Whether all features are present and finite (never null itself)."""
    cond = F.lit(True)
    for f in features:
        x = F.col(f).cast("double")
        cond = cond & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return cond


def valid_features(df: DataFrame, features=("electricity", "water")) -> DataFrame:
    """Rows whose features are present and finite."""
    return df.filter(usable(features))


def score(df: DataFrame, model: MeterModel) -> DataFrame:
    """Adds ``cluster`` (nearest centre) and ``dist`` (distance to it) in standardised space."""
    z = standardise([F.col(f) for f in model.features], model.mean, model.std)
    best = nearest_centre(z, model.centres)
    return (df.withColumn("_nearest", best)
              .withColumn("cluster", F.col("_nearest.cluster"))
              .withColumn("dist", F.sqrt(F.col("_nearest.d2")))
              .drop("_nearest"))


def flag(df: DataFrame, threshold: float) -> DataFrame:
    """is_anomaly = dist > threshold (strict; a null distance gives a null flag)."""
    return df.withColumn("is_anomaly", F.col("dist") > F.lit(float(threshold)))


def anomalies(df: DataFrame, model: MeterModel, columns=ANOMALY_OUTPUT) -> DataFrame:
    """Scored readings farther than the threshold from their centre."""
    scored = score(valid_features(df, model.features), model)
    return scored.filter(F.col("dist") > F.lit(float(model.threshold))).select(*columns)

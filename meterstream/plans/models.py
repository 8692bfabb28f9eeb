"""Named queries for training and the model store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import iso_text
from ..model import FROZEN
from ..operators import scoring, thresholds, training
from ..schema import TRAINING_SCHEMA
from ..session import delete_path, scratch_path
from ..sources import csv
from ..sources.models import load_model, save_model
from ..sources.tables import readings, with_status
from .compare import r6


def readings_csv(spark, sf_dir):
    """The readings written as CSV with header, as a trainer gets them, and read with the declared schema."""
    path = scratch_path(spark, "readings-csv")
    r = with_status(readings(spark, sf_dir))
    (r.select("building", "floor", "electricity", "water", "status", iso_text("timestamp").alias("timestamp"))
     .write.option("header", True).csv(path))
    delete_path(spark, path, at_exit=True)
    return spark.read.schema(TRAINING_SCHEMA).option("header", True).csv(path)


def csv_rejects(spark, sf_dir):
    """Readings as CSV, columns in another order, two lines of five spoilt: those that fit and those that are set aside."""
    path = scratch_path(spark, "spoilt-csv")
    kind, text = F.col("reading_id") % 5, lambda c: F.col(c).cast("string")
    r = with_status(readings(spark, sf_dir))
    (r.select("reading_id", iso_text("timestamp").alias("timestamp"), "status",
              F.when(kind == 1, "ground").otherwise(text("floor")).alias("floor"), "building", text("water").alias("water"),
              F.when(kind == 2, "12,5").otherwise(text("electricity")).alias("electricity"))
     .write.option("header", True).csv(path))
    delete_path(spark, path, at_exit=True)
    lines = csv.read_csv(spark, path)
    fit = csv.rows(lines).select(F.col("reading_id").cast("long").alias("reading_id"), "building", "floor", "electricity", "water",
                                 F.lit(None).cast("string").alias("reason"))
    bad = csv.rejects(lines).select(F.split("raw", ",")[0].cast("long").alias("reading_id"), F.lit(None).cast("string").alias("building"),
                                    F.lit(None).cast("int").alias("floor"), F.lit(None).cast("double").alias("electricity"),
                                    F.lit(None).cast("double").alias("water"), "reason")
    return fit.union(bad)


def kmeans_step(spark, sf_dir):
    """Each fitted centre against the mean of the rows nearest to it (a step of Lloyd's algorithm): they agree within the tolerance."""
    r = scoring.valid_features(readings(spark, sf_dir))
    model, _ = training.fit_model(r)
    scored = scoring.score(r, model)
    means = scored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[
        ((F.avg(f) - F.lit(m)) / F.lit(s)).alias(f"mean_{f}") for f, m, s in zip(model.features, model.mean, model.std)])
    centre = lambda i: F.get(F.array(*[F.lit(float(c[i])) for c in model.centres]), F.col("cluster"))
    far = F.sqrt(sum(((F.col(f"mean_{f}") - centre(i)) ** 2 for i, f in enumerate(model.features)), F.lit(0.0)))
    # k-means ends when no centre moves by more than its tolerance, or after its last round.
    return means.withColumn("moved", far).agg(F.sum("n").alias("readings"), F.count(F.lit(1)).alias("clusters"),
                                              (F.max("moved") < 0.01).alias("settled"))


def kmeans_fit(spark, sf_dir):
    """Scaler + K-means + threshold fitted on the readings: the scaler, the cluster sizes' sum, the threshold's error."""
    r = readings(spark, sf_dir)
    model, _ = training.fit_model(r)
    scored = scoring.score(scoring.valid_features(r), model)
    sizes = scored.groupBy("cluster").count().agg(F.sum("count").alias("readings"), F.count("cluster").alias("clusters"))
    rule = thresholds.distance_stats(scored).select(
        (F.floor(F.abs(F.col("threshold") - F.lit(model.threshold)) * 1e6) / 1e6).alias("threshold_error"))
    fitted = [r6(F.lit(v)).alias(f"{kind}_{name}") for name, m, s in zip(model.features, model.mean, model.std)
              for kind, v in (("mean", m), ("std", s))]
    return sizes.join(rule, F.lit(True)).select(*fitted, "readings", "clusters", "threshold_error")


def model_roundtrip(spark, sf_dir):
    """Save the model set as a new version, load the newest complete version, score and flag with it."""
    root = scratch_path(spark, "models")
    save_model(spark, root, FROZEN)
    loaded = load_model(spark, root)
    delete_path(spark, root)
    if loaded != FROZEN:
        raise AssertionError("loaded model differs from the saved one")
    scored = scoring.score(scoring.valid_features(readings(spark, sf_dir)), loaded)
    return scoring.flag(scored, loaded.threshold).select("reading_id", "cluster", r6("dist").alias("dist"), "is_anomaly")


def pipeline_roundtrip(spark, sf_dir):
    """Fit, save and load the pipeline; its clusters and distances are those of the native scoring."""
    root = scratch_path(spark, "pipelines")
    r = scoring.valid_features(readings(spark, sf_dir))
    save_model(spark, root, *training.fit_model(r))
    model, pipeline = load_model(spark, root, with_pipeline=True)
    delete_path(spark, root, at_exit=True)
    from pyspark.ml.functions import vector_to_array
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in pipeline.stages[-1].clusterCenters()])
    ml = pipeline.transform(r).withColumnRenamed("cluster", "ml_cluster")
    far = F.sqrt(F.aggregate(F.zip_with(vector_to_array("features"), F.get(centres, F.col("ml_cluster")),
                                        lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    both = scoring.score(ml.withColumn("ml_dist", far), model)
    return both.agg(F.count(F.lit(1)).alias("readings"),
                    F.count(F.when(F.col("cluster") == F.col("ml_cluster"), 1)).alias("same_cluster"),
                    F.count(F.when(F.abs(F.col("dist") - F.col("ml_dist")) < 1e-9, 1)).alias("same_distance"))


MODEL_QUERIES = {
    "readings_csv": readings_csv,
    "csv_rejects": csv_rejects,
    "kmeans_step": kmeans_step,
    "kmeans_fit": kmeans_fit,
    "model_roundtrip": model_roundtrip,
    "pipeline_roundtrip": pipeline_roundtrip,
}

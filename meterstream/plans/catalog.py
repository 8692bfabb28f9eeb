"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Computed columns carry the same names as in ``oracle.ORACLE``; values that
depend on summation order go through ``compare.r6``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.rules import diurnal_profile, expected_base, rule_breach
from ..model import FROZEN
from ..operators import enrich, parse, reports, scoring, summaries, thresholds, windows
from ..session import delete_path, scratch_path
from ..sources.tables import readings, table, with_status
from .compare import r6
from .oracle import TREND_HI, TREND_LO

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- windows ----------------------------------------------------------------

def window_agg_30s(spark, sf_dir):
    out = windows.window_aggregate(readings(spark, sf_dir), "30 seconds", windows.MODEL_METRICS)
    return _rounded(out, "avg_electricity", "avg_water")


def window_agg_1h(spark, sf_dir):
    out = windows.window_aggregate(readings(spark, sf_dir), "1 hour", windows.MODEL_METRICS)
    return _rounded(out, "avg_electricity", "avg_water")


def window_agg_max(spark, sf_dir):
    out = windows.window_aggregate(readings(spark, sf_dir), "30 seconds", windows.RULE_METRICS)
    return _rounded(out, "avg_electricity", "avg_water")


# --- rules and parsing ----------------------------------------------------------

def rule_anomalies(spark, sf_dir):
    r = with_status(readings(spark, sf_dir))
    return r.filter(rule_breach()).select("reading_id", "building", "floor", "electricity",
                                          "water", "status", "timestamp")


def parse_envelope(spark, sf_dir):
    """Readings -> JSON topic records -> parsed readings (round trip of every field)."""
    env = parse.to_envelope(with_status(readings(spark, sf_dir)))
    dec = parse.valid(parse.decode(env, keep=("offset",)))
    return dec.select(F.col("offset").alias("reading_id"), "building", "floor", "electricity",
                      "water", "status", "timestamp")


def junk_and_readings(spark, sf_dir) -> DataFrame:
    """Topic records: every reading plus every conversation turn published as a raw value."""
    env = parse.to_envelope(with_status(readings(spark, sf_dir)))
    conv = table(spark, sf_dir, "conversations").select(
        F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.lit("readings").alias("topic"), F.lit(0).alias("partition"),
        F.col("conv_id").cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
    return env.unionByName(conv)


def rejects(spark, sf_dir):
    return parse.rejects(parse.decode(junk_and_readings(spark, sf_dir)))


def spoilt(spark, sf_dir) -> DataFrame:
    """Topic records of the readings, six of seven spoilt in one of the ways that get a record rejected."""
    env = parse.to_envelope(with_status(readings(spark, sf_dir)))
    text, kind = F.col("value").cast("string"), F.col("offset") % 7
    broken = (F.when(kind == 0, F.lit(None).cast("string"))
              .when(kind == 1, F.concat(F.lit("{"), F.col("offset").cast("string")))
              .when(kind == 2, F.regexp_replace(text, '"building":"[^"]*"', '"building":null'))
              .when(kind == 3, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"'))
              .when(kind == 4, F.regexp_replace(text, '"electricity":[^,]*', '"electricity":1e999'))
              .when(kind == 5, F.regexp_replace(text, '"water":[^,]*', '"water":null')).otherwise(text))
    return env.withColumn("value", broken.cast("binary"))


def reject_reasons(spark, sf_dir):
    """Each of the five reasons, from records spoilt on purpose."""
    return parse.rejects(parse.decode(spoilt(spark, sf_dir), keep=("offset",)), keep=("offset",)).select("offset", "reason")


def rule_status(spark, sf_dir):
    return with_status(readings(spark, sf_dir)).select("reading_id", "status")


def drop_invalid(spark, sf_dir):
    """Readings whose electricity is withheld unless the status is Normal, then na.drop."""
    r = with_status(readings(spark, sf_dir))
    blanked = r.select(F.when(F.col("status") == C.STATUS_NORMAL, F.col("electricity")).alias("electricity"),
                       "water")
    return parse.drop_invalid(blanked)


def diurnal_profile_q(spark, sf_dir):
    return readings(spark, sf_dir, water=False).select("reading_id", "timestamp",
                                          diurnal_profile("timestamp").alias("profile"))


def expected_load(spark, sf_dir):
    r = readings(spark, sf_dir, water=False)
    return r.select("reading_id", "building", "floor",
                    r6(expected_base(C.BASE_ELECTRICITY)).alias("expected_electricity"),
                    r6(expected_base(C.BASE_WATER)).alias("expected_water"))


# --- model ----------------------------------------------------------------------

def _scored(spark, sf_dir, model=FROZEN):
    return scoring.score(scoring.valid_features(readings(spark, sf_dir), model.features), model)


def scaler_stats(spark, sf_dir):
    r = scoring.valid_features(readings(spark, sf_dir))
    return r.agg(r6(F.avg("electricity")).alias("mean_electricity"),
                 r6(F.stddev_samp("electricity")).alias("std_electricity"),
                 r6(F.avg("water")).alias("mean_water"),
                 r6(F.stddev_samp("water")).alias("std_water"),
                 F.count(F.lit(1)).alias("n"))


def cluster_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("reading_id", "cluster", r6("dist").alias("dist"))


def cluster_sizes(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("cluster").agg(F.count(F.lit(1)).alias("readings"))


def distance_threshold(spark, sf_dir):
    st = thresholds.distance_stats(_scored(spark, sf_dir))
    return st.select(r6("mean_dist").alias("mean_dist"), r6("std_dist").alias("std_dist"), "n",
                     r6("threshold").alias("threshold"))


def threshold_p95(spark, sf_dir):
    q = thresholds.exact_quantile(_scored(spark, sf_dir), "dist", 0.95, name="threshold_p95")
    return q.select(r6("threshold_p95").alias("threshold_p95"), "n")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table; it goes when the application ends."""
    path = scratch_path(df.sparkSession, name)
    delete_path(df.sparkSession, path, at_exit=True)
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("timestamp"))


def threshold_kll(spark, sf_dir):
    """95th percentile of the distances of a week, from stored sketches by date and building; its true rank is within the bound."""
    scored = _dated(_scored(spark, sf_dir))
    stored = _stored(summaries.sketches(scored), "sketches")
    lo, hi = (F.to_date(F.lit(t)) for t in (TREND_LO, TREND_HI))
    week = lambda df: df.filter((F.col("date") >= lo) & (F.col("date") < hi))
    found = summaries.sketched_quantile(summaries.merged_sketches(week(stored), ("building",)), 0.95)
    ranked = (week(scored).join(F.broadcast(found.select("building", "value")), "building")  # a row for each building
              .groupBy("building").agg(F.count("dist").alias("n"), F.count(F.when(F.col("dist") <= F.col("value"), 1)).alias("below"),
                                       F.count(F.when(F.col("dist") < F.col("value"), 1)).alias("under")))
    # the quantile's own copies span ranks from under/n to below/n
    error = F.greatest(F.col("under") / F.col("n") - 0.95, 0.95 - F.col("below") / F.col("n"), F.lit(0.0))
    return ranked.select("building", "n", (error <= F.greatest(F.lit(summaries.RANK_ERROR), 1 / F.col("n"))).alias("within"))


def threshold_from_moments(spark, sf_dir):
    """Mean, standard deviation and threshold of the distances from moments stored by date."""
    stored = _stored(summaries.moments(_dated(_scored(spark, sf_dir)), ("dist",)), "moments")
    out = summaries.threshold_of(summaries.merged_moments(stored, ("dist",)))
    return _rounded(out, "mean_dist", "std_dist", "threshold")


def scaler_from_moments(spark, sf_dir):
    """The scaler's means and deviations from moments stored by date."""
    cols = ("electricity", "water")
    stored = _stored(summaries.moments(_dated(scoring.valid_features(readings(spark, sf_dir))), cols), "moments")
    m = summaries.merged_moments(stored, cols)
    return m.select(*[r6(v).alias(f"{n}_{c}") for c in cols for n, v in (("mean", F.col(f"{c}_mean")), ("std", summaries.sample_std(c)))],
                    F.col("electricity_n").alias("n"))


def model_anomalies(spark, sf_dir):
    an = scoring.anomalies(readings(spark, sf_dir), FROZEN)
    return an.withColumn("dist", r6("dist"))


def severity_bands(spark, sf_dir):
    return enrich.severity_counts(_scored(spark, sf_dir), FROZEN.threshold)


def pct_of_average(spark, sf_dir):
    r = readings(spark, sf_dir, water=False)
    out = enrich.pct_of_average(r)
    return out.select("reading_id", "building", "floor", "electricity", "timestamp",
                      r6("avg_electricity").alias("avg_electricity"), r6("pct_of_avg").alias("pct_of_avg"))


# --- reports ----------------------------------------------------------------------

def panel_trend(spark, sf_dir):
    # a superset range on the raw time reaches the parquet scan; the exact range follows
    lo = F.lit(TREND_LO).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    hi = F.lit(TREND_HI).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
    raw = readings(spark, sf_dir, water=False).filter((F.col("timestamp") >= lo) & (F.col("timestamp") < hi))
    aggs = windows.window_aggregate(raw, "1 hour", ("avg_electricity",))
    out = reports.panel_trend(aggs, TREND_LO, TREND_HI)
    return out.withColumn("value", r6("value"))


def panel_latest(spark, sf_dir):
    out = reports.panel_latest(scoring.anomalies(readings(spark, sf_dir), FROZEN))
    return out.withColumn("distance", r6("distance"))


def anomalies_per_building(spark, sf_dir):
    out = reports.anomalies_per_building(scoring.anomalies(readings(spark, sf_dir), FROZEN))
    return out.withColumn("avg_distance", r6("avg_distance"))


QUERIES: dict[str, Query] = {
    "window_agg_30s": window_agg_30s,
    "window_agg_1h": window_agg_1h,
    "window_agg_max": window_agg_max,
    "rule_anomalies": rule_anomalies,
    "parse_envelope": parse_envelope,
    "rejects": rejects,
    "reject_reasons": reject_reasons,
    "drop_invalid": drop_invalid,
    "rule_status": rule_status,
    "diurnal_profile": diurnal_profile_q,
    "expected_load": expected_load,
    "scaler_stats": scaler_stats,
    "cluster_score": cluster_score,
    "cluster_sizes": cluster_sizes,
    "distance_threshold": distance_threshold,
    "threshold_p95": threshold_p95,
    "threshold_kll": threshold_kll,
    "threshold_from_moments": threshold_from_moments,
    "scaler_from_moments": scaler_from_moments,
    "model_anomalies": model_anomalies,
    "severity_bands": severity_bands,
    "pct_of_average": pct_of_average,
    "panel_trend": panel_trend,
    "panel_latest": panel_latest,
    "anomalies_per_building": anomalies_per_building,
}

from .models import MODEL_QUERIES  # noqa: E402
from .streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(MODEL_QUERIES)
QUERIES.update(STREAM_QUERIES)

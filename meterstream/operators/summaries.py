"""Summaries that are stored once for each date and merged for any range: sketches, moments, rollups.

A day's rows are read once, when its summary is written; thresholds, scalers
and panels of any range of dates then read a few rows for each date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

#: Size of the quantile sketches, and the rank error that a quantile of one, or of any merged ones, keeps to (99 % of the time).
SKETCH_K, RANK_ERROR = 1000, 0.005


# ---- quantile sketches (A5) ----

def sketches(rows: DataFrame, col: str = "dist", keys: Sequence[str] = ("date", "building"), k: int = SKETCH_K) -> DataFrame:
    """keys, ``n`` and a KLL ``sketch`` of the column's values; nulls and NaN don't count."""
    value = F.when(~F.isnan(F.col(col).cast("double")), F.col(col).cast("double"))
    return (rows.filter(value.isNotNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")))


def merged_sketches(stored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The stored sketches of each key (or all) as one."""
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantile(merged: DataFrame, q: float, name: str = "value") -> DataFrame:
    """keys, ``n`` and the quantile, without the sketch."""
    return merged.withColumn(name, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).drop("sketch")


# ---- moments (A3, A4, A7) ----

def moments(rows: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("date",)) -> DataFrame:
    """keys and, for each column, count, mean and sum of squared differences from it: ``<col>_n``, ``_mean``, ``_m2``."""
    out = []
    for c in cols:
        out += [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"), (F.var_pop(c) * F.count(c)).alias(f"{c}_m2")]
    return rows.groupBy(*keys).agg(*out)


def _merged(a: Column, b: Column) -> Column:
    """Count, mean and squared differences of two sets of values together."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    both = F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def merged_moments(stored: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Moments of several dates as those of all their rows, merged one after another (a row for each date and key).

    The differences of means are added up, not squares of the values, so
    nothing cancels.
    """
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    each = [F.collect_list(F.struct(F.col(f"{c}_n").alias("n"), F.coalesce(f"{c}_mean", F.lit(0.0)).alias("mean"),
                                    F.coalesce(f"{c}_m2", F.lit(0.0)).alias("m2"))).alias(c) for c in cols]
    whole = stored.groupBy(*keys).agg(*each).select(*keys, *[F.reduce(c, none, _merged).alias(c) for c in cols])
    return whole.select(*keys, *[x for c in cols for x in (
        F.col(f"{c}.n").alias(f"{c}_n"), F.when(F.col(f"{c}.n") > 0, F.col(f"{c}.mean")).alias(f"{c}_mean"),
        F.when(F.col(f"{c}.n") > 0, F.col(f"{c}.m2")).alias(f"{c}_m2"))])


def sample_std(col: str) -> Column:
    """Sample standard deviation from merged moments; null for fewer than two values."""
    n = F.col(f"{col}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{col}_m2") / (n - 1)))


def threshold_of(merged: DataFrame, col: str = "dist", sigmas: float = C.THRESHOLD_SIGMAS) -> DataFrame:
    """``mean_dist, std_dist, n, threshold`` as ``thresholds.distance_stats`` has them, from moments."""
    mean, std = F.col(f"{col}_mean"), sample_std(col)
    return merged.select(mean.alias("mean_dist"), std.alias("std_dist"), F.col(f"{col}_n").alias("n"),
                         (mean + F.lit(float(sigmas)) * F.coalesce(std, F.lit(0.0))).alias("threshold"))


# ---- rollups (O1, A6, P18) ----

def rollup(rows: DataFrame, values: Sequence[str], keys: Sequence[str] = ("building",), duration: str = "1 hour",
           time_col: str = "timestamp") -> DataFrame:
    """Window, keys, ``rows`` and, for each value, count, sum, min and max: what merges with those of other batches."""
    out = [F.count(F.lit(1)).alias("rows")]
    for v in values:
        out += [F.count(v).alias(f"{v}_n"), F.sum(v).alias(f"{v}_sum"), F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max")]
    grouped = rows.filter(F.col(time_col).isNotNull()).groupBy(F.window(time_col, duration).alias("w"), *keys).agg(*out)
    return grouped.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          *[c for c in grouped.columns if c not in ("w", *keys)])


def merged_rollup(stored: DataFrame, values: Sequence[str], keys: Sequence[str] = ("building", "window_start")) -> DataFrame:
    """Rollups of several batches (or of shorter windows) as one for each of ``keys``."""
    out = [F.sum("rows").alias("rows")]
    for v in values:
        out += [F.sum(f"{v}_n").alias(f"{v}_n"), F.sum(f"{v}_sum").alias(f"{v}_sum"), F.min(f"{v}_min").alias(f"{v}_min"),
                F.max(f"{v}_max").alias(f"{v}_max")]
    return stored.groupBy(*keys).agg(*out)


def rollup_mean(value: str) -> Column:
    return F.col(f"{value}_sum") / F.col(f"{value}_n")


def trend_of(stored: DataFrame, lo=None, hi=None, value: str = "electricity") -> DataFrame:
    """The trend panel from stored rollups: time, building, mean value, by time."""
    from .reports import panel_trend, time_range
    merged = merged_rollup(time_range(stored, "window_start", lo, hi), (value,))
    return panel_trend(merged.withColumn("mean", rollup_mean(value)), value_col="mean")


def per_building_of(stored: DataFrame, value: str = "dist") -> DataFrame:
    """Anomalies per building from stored rollups of anomalies: count and mean distance, most first."""
    return (merged_rollup(stored, (value,), keys=("building",))
            .select("building", F.col("rows").alias("anomaly_count"), rollup_mean(value).alias("avg_distance"))
            .orderBy(F.desc("anomaly_count"), "building"))

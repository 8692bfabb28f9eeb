"""Report queries over the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGG_KEYS = ("building", "window_start")


def latest_revision(revisions: DataFrame, keys: Sequence[str] = AGG_KEYS,
                    order_col: str = "batch_id") -> DataFrame:
    """Newest revision per key (update-mode streams append one row per touching batch).

    ``max_by`` is an ordinary aggregate: partial per task before the shuffle,
    so a key with many revisions never sorts in one task.
    """
    value_cols = [c for c in revisions.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order_col))
    return (revisions.groupBy(*keys).agg(best.alias("_r"))
                     .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in value_cols]))


def time_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """lo <= col < hi; on partitioned or sorted storage the bounds prune files."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) < F.lit(hi))
    return df.filter(cond)


def stored_between(stored: DataFrame, lo, hi) -> DataFrame:
    """Stored rows of the dates from ``lo`` to ``hi``: only their folders are read."""
    day = lambda t: F.to_date(F.lit(t))
    return stored.filter((F.col("date") >= day(lo)) & (F.col("date") <= day(hi)))


def one_run(stored: DataFrame, query: str | None = None, run: str | None = None, time_col: str = "processed_at") -> DataFrame:
    """Stored rows of one query and run: those asked for, else the ones that wrote last (by processing time).

    Queries that share a table, and runs that read the same records again,
    would else give each point several times.
    """
    if query is not None:
        stored = stored.filter(F.col("query") == query)
    if run is not None:
        stored = stored.filter(F.col("run") == run)
    last = (stored.groupBy("query", "run").agg(F.max(time_col).alias("t"))
            .orderBy(F.desc_nulls_last("t"), "query", "run").limit(1).collect())
    return stored.filter((F.col("query") == last[0].query) & (F.col("run") == last[0].run)) if last else stored


def panel_trend(aggs: DataFrame, lo=None, hi=None, value_col: str = "avg_electricity") -> DataFrame:
    """Trend panel: time, building, value inside the time range, by time ascending."""
    return (time_range(aggs, "window_start", lo, hi)
            .select(F.col("window_start").alias("time"), "building", F.col(value_col).alias("value"))
            .orderBy("time", "building"))


def panel_latest(anomalies: DataFrame, n: int = 10, time_col: str = "timestamp") -> DataFrame:
    """Latest ``n`` anomalies (top-k per task, then one small merge)."""
    distance = F.col("dist") if "dist" in anomalies.columns else F.lit(None).cast("double")
    place = [c for c in ("reading_id", "topic", "partition", "offset") if c in anomalies.columns]  # breaks ties
    return (anomalies.select(F.col(time_col).alias("time"), "building", "floor", "electricity",
                             distance.alias("distance"), *place)
            .orderBy(F.desc("time"), "building", "floor", F.desc("electricity"), *place)
            .limit(n).drop(*place))


def anomalies_per_building(anomalies: DataFrame, dist_col: str = "dist") -> DataFrame:
    """Anomaly count and mean distance per building (null for rule anomalies), most anomalies first."""
    dist = F.col(dist_col) if dist_col in anomalies.columns else F.lit(None).cast("double")
    return (anomalies.groupBy("building")
            .agg(F.count(F.lit(1)).alias("anomaly_count"), F.avg(dist).alias("avg_distance"))
            .orderBy(F.desc("anomaly_count"), "building"))

"""Context columns for alerts (E6 severity counts, E7 percent of average)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.rules import severity_band


def building_averages(readings: DataFrame, col: str = "electricity") -> DataFrame:
    """One row per building: partial aggregation, so a hot building is combined map-side."""
    return readings.groupBy("building").agg(F.avg(col).alias(f"avg_{col}"))


class ReferenceTable:
    """A small table for stream-static joins, re-read from its source after ``refresh_s`` seconds.

    ``load`` builds the DataFrame (e.g. building averages over the stored
    readings); the materialised copy is persisted and swapped on refresh, so
    micro-batches between refreshes join against a cached table.
    """

    def __init__(self, load, refresh_s: float = 3600.0):
        self.load, self.refresh_s = load, refresh_s
        self._df, self._at = None, 0.0

    def get(self) -> DataFrame:
        import time
        now = time.monotonic()
        if self._df is None or now - self._at >= self.refresh_s:
            fresh = self.load().persist(StorageLevel.MEMORY_AND_DISK)
            fresh.count()
            old, self._df, self._at = self._df, fresh, now
            if old is not None:
                old.unpersist()
        return self._df


def pct_of_average(readings: DataFrame, alerts: DataFrame | None = None,
                   col: str = "electricity", averages: DataFrame | None = None) -> DataFrame:
    """Alert rows with ``100 * value / building average``.

    The averages come from a grouped aggregate (one row per building, partial
    aggregation before the shuffle) joined back on ``building``; Spark picks
    the join by their real size.  No window ``PARTITION BY building``, which
    would put a whole building in one task.  An alert of a building without
    an average stays, with null in its place.  ``averages`` may be given (a
    reference table for streams: a stream-static join against it).
    """
    if alerts is None:
        alerts = readings.filter(F.col(col) > F.lit(C.HIGH_ELECTRICITY))
    if isinstance(averages, ReferenceTable):
        averages = averages.get()
    avgs = averages if averages is not None else building_averages(readings, col)
    return (alerts.join(avgs, "building", "left")
            .withColumn("pct_of_avg", F.try_divide(F.lit(100.0) * F.col(col), F.col(f"avg_{col}"))))


def severity_counts(scored: DataFrame, threshold: float) -> DataFrame:
    return (scored.select(severity_band("dist", threshold).alias("severity"))
            .groupBy("severity").agg(F.count(F.lit(1)).alias("readings")))

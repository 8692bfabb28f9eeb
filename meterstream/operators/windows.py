"""Tumbling event-time window aggregates per building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.parse import from_utc_wall, utc_wall

# name -> aggregate expression
METRICS = {
    "avg_electricity": lambda: F.avg("electricity"),
    "avg_water": lambda: F.avg("water"),
    "max_elec": lambda: F.max("electricity"),
    "min_elec": lambda: F.min("electricity"),
    "max_electricity": lambda: F.max("electricity"),
    "min_electricity": lambda: F.min("electricity"),
    "max_water": lambda: F.max("water"),
    "min_water": lambda: F.min("water"),
    "readings": lambda: F.count(F.lit(1)),
}
# Model stream: avg, avg, max electricity, min electricity.
MODEL_METRICS = ("avg_electricity", "avg_water", "max_elec", "min_elec")
# Rule stream: avg, avg, max electricity, max water.
RULE_METRICS = ("avg_electricity", "avg_water", "max_electricity", "max_water")


def window_aggregate(df: DataFrame, duration: str = C.WINDOW_DURATION,
                     metrics: Sequence[str] = MODEL_METRICS, time_col: str = "timestamp",
                     keys: Sequence[str] = ("building",), watermark: str | None = None) -> DataFrame:
    """groupBy(window(time, duration), keys).agg(metrics) with flat window bounds.

    Partial aggregation runs before the shuffle on (window, keys), so a hot
    building costs one partial row per task.  With ``watermark`` the state of
    closed windows is dropped and append mode becomes possible;
    ``withWatermark`` needs a ``timestamp`` column, so a timestamp_ntz event
    time (UTC wall time) becomes its instant for the window and the bounds are
    turned back into UTC wall time.
    """
    ntz = dict(df.dtypes).get(time_col) == "timestamp_ntz"
    ts = time_col
    if watermark is not None:
        ts = "_event_time"
        instant = from_utc_wall(time_col) if ntz else F.col(time_col)
        df = df.withColumn(ts, instant).withWatermark(ts, watermark)
    grouped = df.groupBy(F.window(ts, duration).alias("window"), *keys)
    out = grouped.agg(*[METRICS[m]().alias(m) for m in metrics])
    start, end = F.col("window.start"), F.col("window.end")
    if ntz and watermark is not None:
        start, end = utc_wall(start), utc_wall(end)
    return out.select(*keys, *metrics, start.alias("window_start"), end.alias("window_end"))

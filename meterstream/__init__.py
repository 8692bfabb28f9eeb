"""meterstream: Spark-native monitoring of meter readings.

Readings (building, floor, electricity, water, time) are parsed from JSON
messages or read from tables, checked, scored against a K-means model in
standardised space, windowed per building, and written to replayable sinks.
Every transform is a ``DataFrame -> DataFrame`` function used unchanged by
batch jobs and Structured Streaming queries.

    from meterstream import readings, window_aggregate, fit_model, anomalies
"""

__version__ = "0.1.0"

from .model import FROZEN, MeterModel  # noqa: E402
from .operators.enrich import pct_of_average  # noqa: E402
from .operators.parse import decode, rejects, to_envelope, valid  # noqa: E402
from .operators.reports import (anomalies_per_building, latest_revision, panel_latest,  # noqa: E402
                                panel_trend)
from .operators.scoring import anomalies, score  # noqa: E402
from .operators.thresholds import distance_stats, exact_quantile  # noqa: E402
from .operators.training import fit_model  # noqa: E402
from .operators.windows import window_aggregate  # noqa: E402
from .session import build_session  # noqa: E402
from .sources.models import load_model, save_model  # noqa: E402
from .sources.tables import readings  # noqa: E402
from .streaming.queries import aggregate_query, scoring_query  # noqa: E402

__all__ = [
    "FROZEN", "MeterModel", "aggregate_query", "anomalies", "anomalies_per_building", "build_session",
    "decode", "distance_stats", "exact_quantile", "fit_model", "latest_revision", "load_model",
    "panel_latest", "panel_trend", "pct_of_average", "readings", "rejects", "save_model", "score",
    "scoring_query", "to_envelope", "valid", "window_aggregate",
]

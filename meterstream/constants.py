"""Domain constants.

The values under "Fixed values" must stay as they are: they define the
readings, the rule classes and the generator profile that results are
compared against.
"""

from __future__ import annotations

# --- Fixed values (must equal the monitored system's rules) -----------------
# Rule classes of a reading: High above the high limits, else Warning above the
# warning limits, else Normal.  Comparisons are strict (">").
HIGH_ELECTRICITY = 180.0
HIGH_WATER = 350.0
WARN_ELECTRICITY = 140.0
WARN_WATER = 275.0
STATUS_HIGH = "High"
STATUS_WARNING = "Warning"
STATUS_NORMAL = "Normal"

# Diurnal profile: daylight hours 7..19 (inclusive) weigh 1.2, other hours 0.8;
# peak hours 12..14 (inclusive) weigh a further 1.3, other hours 1.0.
DAYLIGHT_FIRST_HOUR = 7
DAYLIGHT_LAST_HOUR = 19
DAYLIGHT_FACTOR = 1.2
NIGHT_FACTOR = 0.8
PEAK_FIRST_HOUR = 12
PEAK_LAST_HOUR = 14
PEAK_FACTOR = 1.3
OFF_PEAK_FACTOR = 1.0

# Building factor 1 + 0.05 * (hash mod 5); floor factor 1 + (floor - 1) * 0.02.
BUILDING_FACTOR_STEP = 0.05
BUILDING_FACTOR_BUCKETS = 5
FLOOR_FACTOR_STEP = 0.02

# Base loads: electricity 95 kWh, water 180 litres (times the factors above).
BASE_ELECTRICITY = 95.0
BASE_WATER = 180.0

# Model: k = 3, seed 42; threshold = mean + 3 * sample stddev of the training
# distances (a null stddev counts as 0).
KMEANS_K = 3
KMEANS_SEED = 42
THRESHOLD_SIGMAS = 3.0

# Severity bands of a distance: (0, 1.0] very normal, (1.0, threshold] normal
# variation, (threshold, 2.5] minor anomaly, (2.5, 3.5] anomaly, above critical.
SEVERITY_VERY_NORMAL_MAX = 1.0
SEVERITY_MINOR_MAX = 2.5
SEVERITY_ANOMALY_MAX = 3.5
SEVERITY_LABELS = ("very normal", "normal variation", "minor anomaly", "anomaly", "critical")

# Stream defaults: 30-second tumbling windows, 1-minute trigger.
WINDOW_DURATION = "30 seconds"
TRIGGER_INTERVAL = "1 minute"
# ---------------------------------------------------------------------------
FEATURES = ("electricity", "water")

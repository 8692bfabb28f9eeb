"""Rule expressions over readings: status class, load profile, severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    # Double literal: bare SQL literals such as 1.2 would become decimals.
    return F.lit(float(v)).cast("double")


def rule_breach(electricity="electricity", water="water",
                high_electricity: float = C.HIGH_ELECTRICITY,
                high_water: float = C.HIGH_WATER) -> Column:
    """High-limit breach, three-valued: null when a side is null and the other is not high."""
    return (_c(electricity) > _d(high_electricity)) | (_c(water) > _d(high_water))


def rule_status(electricity="electricity", water="water",
                high=(C.HIGH_ELECTRICITY, C.HIGH_WATER),
                warning=(C.WARN_ELECTRICITY, C.WARN_WATER)) -> Column:
    """High / Warning / Normal class of a reading (strict comparisons)."""
    e, w = _c(electricity), _c(water)
    return (F.when((e > _d(high[0])) | (w > _d(high[1])), F.lit(C.STATUS_HIGH))
             .when((e > _d(warning[0])) | (w > _d(warning[1])), F.lit(C.STATUS_WARNING))
             .otherwise(F.lit(C.STATUS_NORMAL)))


def diurnal_profile(ts="timestamp") -> Column:
    """Daylight factor times peak factor for the hour of ``ts`` (ends inclusive)."""
    h = F.hour(_c(ts))
    daylight = F.when(h.between(C.DAYLIGHT_FIRST_HOUR, C.DAYLIGHT_LAST_HOUR),
                      _d(C.DAYLIGHT_FACTOR)).otherwise(_d(C.NIGHT_FACTOR))
    peak = F.when(h.between(C.PEAK_FIRST_HOUR, C.PEAK_LAST_HOUR),
                  _d(C.PEAK_FACTOR)).otherwise(_d(C.OFF_PEAK_FACTOR))
    return daylight * peak


def stable_bucket(value, buckets: int, salt: str = "") -> Column:
    """Process-independent hash bucket in [0, buckets): first 32 bits of md5.

    The same rule is expressible in plain SQL engines, so oracle queries can
    reproduce it exactly.
    """
    text = _c(value).cast("string")
    if salt:
        text = F.concat(text, F.lit(salt))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def building_factor(building="building") -> Column:
    return _d(1.0) + _d(C.BUILDING_FACTOR_STEP) * stable_bucket(building, C.BUILDING_FACTOR_BUCKETS).cast("double")


def floor_factor(floor="floor") -> Column:
    return _d(1.0) + (_c(floor).cast("double") - _d(1.0)) * _d(C.FLOOR_FACTOR_STEP)


def expected_base(base: float, ts="timestamp", building="building", floor="floor") -> Column:
    """Expected base load: base * profile * building factor * floor factor."""
    return _d(base) * diurnal_profile(ts) * building_factor(building) * floor_factor(floor)


def severity_band(dist="dist", threshold: float | Column = 1.0) -> Column:
    """Bands of a distance: up to the threshold normal, beyond it anomalous, whatever the threshold is."""
    d = _c(dist)
    t = threshold if isinstance(threshold, Column) else _d(threshold)
    labels = C.SEVERITY_LABELS
    return (F.when(d.isNull(), F.lit(None).cast("string"))
             .when((d <= t) & (d <= _d(C.SEVERITY_VERY_NORMAL_MAX)), F.lit(labels[0]))
             .when(d <= t, F.lit(labels[1]))
             .when(d <= _d(C.SEVERITY_MINOR_MAX), F.lit(labels[2]))
             .when(d <= _d(C.SEVERITY_ANOMALY_MAX), F.lit(labels[3]))
             .otherwise(F.lit(labels[4])))

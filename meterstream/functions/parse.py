"""Message encoding / decoding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MESSAGE_SCHEMA

# Readings carry UTC wall time (timestamp_ntz); text is written with a fixed +00:00 offset.
ISO_FORMAT_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def value_text(value="value") -> Column:
    """Binary topic value -> UTF-8 text."""
    return _c(value).cast("string")


def parse_message(text="json_str", schema=MESSAGE_SCHEMA) -> Column:
    """Permissive JSON parse: bad JSON -> all-null struct, wrong type -> null field."""
    return F.from_json(_c(text), schema, {"mode": "PERMISSIVE"})


def is_json_object(text) -> Column:
    """True when the text is a JSON object (``json_object_keys`` is null otherwise)."""
    return F.json_object_keys(_c(text)).isNotNull()


def utc_wall(instant) -> Column:
    """timestamp (an instant) -> timestamp_ntz holding its UTC wall time, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(instant).cast("timestamp_ntz"))


def from_utc_wall(wall) -> Column:
    """timestamp_ntz holding UTC wall time -> timestamp (the instant)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(wall)).cast("timestamp")


def event_time(text="timestamp") -> Column:
    """ISO-8601 text (``+00:00``, ``Z`` or another offset) -> UTC wall time; bad text -> null.

    Text without an offset is read in the session time zone.
    """
    return utc_wall(F.try_to_timestamp(_c(text)))


def iso_text(ts="timestamp") -> Column:
    """UTC wall time (timestamp_ntz) -> ISO-8601 text with microseconds and ``+00:00``."""
    return F.date_format(_c(ts), ISO_FORMAT_UTC)


def encode_message(building="building", floor="floor", electricity="electricity",
                   water="water", status="status", ts="timestamp") -> Column:
    """Reading columns -> JSON text (field order of the message schema)."""
    return F.to_json(F.struct(
        _c(building).alias("building"), _c(floor).alias("floor"),
        _c(electricity).alias("electricity"), _c(water).alias("water"),
        _c(status).alias("status"), iso_text(ts).alias("timestamp")))

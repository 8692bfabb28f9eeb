"""Decode topic records into readings and set the bad ones aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.parse import (encode_message, event_time, from_utc_wall, is_json_object, parse_message,
                               value_text)
from ..schema import MESSAGE_SCHEMA
from .scoring import usable

# Reject reasons, checked in this order.
NULL_VALUE = "null_value"
BAD_JSON = "bad_json"
NULL_BUILDING = "null_building"
BAD_TIME = "bad_time"
BAD_FEATURE = "bad_feature"


def _all_null(struct_col: str) -> Column:
    cond = F.lit(True)
    for f in MESSAGE_SCHEMA.fieldNames():
        cond = cond & F.col(f"{struct_col}.{f}").isNull()
    return cond


def decode(envelope: DataFrame, keep=()) -> DataFrame:
    """Envelope -> raw text, message fields, parsed event time and a reject reason.

    The parse is permissive (bad JSON -> all-null fields, wrong-typed field ->
    null).  Only all-null rows pay for the second JSON check that tells bad
    JSON from an empty object.  ``keep`` names envelope columns to pass through
    (topic, partition, offset, ...).
    """
    raw = value_text("value")
    # parse once per row (a generator output is never re-inlined into later filters)
    msg = envelope.select(*keep, raw.alias("raw"),
                          F.inline(F.array(F.struct(parse_message(raw).alias("data")))))
    ts_text = F.col("data.timestamp")
    parsed_ts = event_time(ts_text)
    reason = (F.when(F.col("raw").isNull(), F.lit(NULL_VALUE))
              .when(_all_null("data") & ~is_json_object(F.col("raw")), F.lit(BAD_JSON))
              .when(F.col("data.building").isNull(), F.lit(NULL_BUILDING))
              .when(parsed_ts.isNull(), F.lit(BAD_TIME)))
    return msg.select(
        *keep, "raw",
        *[F.col(f"data.{f}").alias(f) for f in ("building", "floor", "electricity", "water", "status")],
        parsed_ts.alias("timestamp"),
        reason.alias("reason"))


def valid(decoded: DataFrame) -> DataFrame:
    """Readings that passed the structural checks (features may still be null/NaN)."""
    return decoded.filter(F.col("reason").isNull()).drop("raw", "reason")


def reject_reason(features=C.FEATURES) -> Column:
    """Why a decoded record is set aside: bad structure, or features that can't be scored; null if it isn't."""
    return F.coalesce(F.col("reason"), F.when(~usable(features), F.lit(BAD_FEATURE)))


def rejects(decoded: DataFrame, features=C.FEATURES, keep=()) -> DataFrame:
    """raw + reason (and the columns in ``keep``) of the records that are set aside."""
    return (decoded.select("raw", reject_reason(features).alias("reason"), *keep)
            .filter(F.col("reason").isNotNull()))


def drop_invalid(df: DataFrame, features=C.FEATURES) -> DataFrame:
    """Project the features and drop rows with any null (the trainer's cleaning step)."""
    return df.select(*features).na.drop()


def to_envelope(readings: DataFrame, topic: str = "readings", partitions: int = 3,
                offset_col: str | None = "reading_id") -> DataFrame:
    """Readings -> topic records: key = building bytes, value = JSON bytes."""
    status = F.col("status") if "status" in readings.columns else F.lit(None).cast("string")
    value = encode_message("building", "floor", "electricity", "water", status, "timestamp")
    offset = F.col(offset_col).cast("long") if offset_col else F.monotonically_increasing_id()
    return readings.select(
        F.col("building").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("building"), F.lit(partitions)).cast("int").alias("partition"),
        offset.alias("offset"),
        from_utc_wall("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))

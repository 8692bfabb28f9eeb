"""Schemas of messages, readings and results."""

from __future__ import annotations

from pyspark.sql import types as T

# JSON message carried in a topic value.  All fields nullable; the time stays
# text here and is parsed explicitly (see functions.parse.event_time).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("building", T.StringType(), True),
    T.StructField("floor", T.IntegerType(), True),
    T.StructField("electricity", T.DoubleType(), True),
    T.StructField("water", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

# Envelope of a topic record (what the Kafka source yields; replay files use it).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Training CSV with header: same columns, ``status`` holds the truth label.
TRAINING_SCHEMA = T.StructType([
    T.StructField("building", T.StringType(), True),
    T.StructField("floor", T.IntegerType(), True),
    T.StructField("electricity", T.DoubleType(), True),
    T.StructField("water", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

_LAYOUT = "date date, query string, run string, batch_id long"
_PLACE = "topic string, partition int, offset long"

# Stored results, by table and store; a table holds the columns its writers have, the others read as null.
RESULTS = {
    "aggregations": "building string, avg_electricity double, avg_water double, max_elec double, min_elec double, "
                    "max_electricity double, max_water double, window_start {time}, window_end {time}, "
                    "processed_at timestamp, " + _LAYOUT,
    "anomalies": "building string, floor int, electricity double, water double, status string, is_anomaly boolean, "
                 "cluster int, {distance} double, model_version string, " + _PLACE + ", timestamp {time}, detected_at timestamp, " + _LAYOUT,
    "late": "building string, floor int, electricity double, water double, " + _PLACE + ", timestamp {time}, "
            "window_start {time}, window_end {time}, watermark {time}, reason string, " + _LAYOUT,
    "rejects": "raw string, reason string, " + _PLACE + ", " + _LAYOUT,
}


def result_schema(table: str, relational: bool = False) -> str:
    """DDL of a stored result table; relational rows have instants and call the distance so."""
    return RESULTS[table].format(time="timestamp" if relational else "timestamp_ntz",
                                 distance="distance" if relational else "dist")

"""Parquet tables and the ``readings`` view over ``events``.

Mapping (one reading per event):
building = event_type, floor = user_id % 5 + 1, electricity = value,
water = 4 * props.k, timestamp = ts (timestamp_ntz).
Only the columns a query uses reach the parquet scan (Catalyst prunes the rest).

``water`` comes out of a JSON text.  It is produced by a one-row ``inline``
generator, so it is parsed once per row: the optimizer substitutes aliases
when it pushes a filter below a projection, and a filter such as
``dist > threshold`` (which names water in every centre's term) would
otherwise re-parse the JSON a dozen times per row.  Filters on the plain
columns still reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import rule_status

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parsed_once(**cols) -> F.Column:
    """Columns computed once per row as outputs of a one-row generator."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()])))


def readings_from_events(events: DataFrame, water: bool = True) -> DataFrame:
    """``water=False`` leaves the JSON column out entirely (the generator is never pruned)."""
    cols = [
        F.col("event_id").alias("reading_id"),
        F.col("event_type").alias("building"),
        (F.col("user_id") % 5 + 1).cast("int").alias("floor"),
        F.col("value").cast("double").alias("electricity"),
    ]
    if water:
        cols.append(parsed_once(water=F.lit(4.0) * F.get_json_object("props", "$.k").try_cast("double")))
    return events.select(*cols, F.col("ts").alias("timestamp"))


def readings(spark: SparkSession, sf_dir: str, water: bool = True) -> DataFrame:
    """Readings view: reading_id, building, floor, electricity, water, timestamp."""
    return readings_from_events(table(spark, sf_dir, "events"), water)


def with_status(df: DataFrame) -> DataFrame:
    """Adds the rule class the producer attaches to each message."""
    return df.withColumn("status", rule_status("electricity", "water"))


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger stand-in for readings: quantity as electricity, price/100 as water."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("building"),
        F.col("l_linenumber").cast("int").alias("floor"),
        F.col("l_quantity").cast("double").alias("electricity"),
        (F.col("l_extendedprice") / F.lit(100.0)).alias("water"),
        F.col("l_shipdate").alias("timestamp"),
    )


def write_readings(readings_df: DataFrame, path: str, mode: str = "error") -> None:
    """Parsed readings as a parquet table partitioned by event date.

    Parse once, query many times: later queries read typed columns (no JSON)
    and a date predicate prunes whole partitions.  Rows are dealt to ranges of
    (date, hash), so a task writes one date or a few, and a date that holds a
    third of the rows is written by a third of the tasks.
    """
    (readings_df.withColumn("date", F.to_date("timestamp"))
        .repartitionByRange("date", F.xxhash64("reading_id"))
        .sortWithinPartitions("date")
        .write.mode(mode).partitionBy("date").parquet(path))


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """The table written by ``write_readings`` (``date`` is a partition column)."""
    return spark.read.parquet(path)

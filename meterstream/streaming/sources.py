"""Topic source (S1, S2, T9, T10), archived records and replayed files in its place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import ENVELOPE_SCHEMA


@dataclass(frozen=True)
class SourceConfig:
    """Where records come from.

    ``kind="kafka"``: subscribe to ``topic``; ``max_offsets_per_trigger``
    bounds a micro-batch (none by default); ``min_partitions``
    splits hot topic partitions (keys are building names, so one partition
    can carry most records).  ``fail_on_data_loss`` defaults to true: lost
    offsets stop the query rather than silently skipping data.
    ``kind="archive"``: archived topic records (``streaming/archive.py``) at
    ``path``, with the same start position, limit and data-loss policy, besides
    ``starting_time`` and ``level_in_time``.
    ``kind="files"``: parquet files with the topic envelope schema, read in
    modification-time order, ``max_files_per_trigger`` per micro-batch.
    """
    kind: str = "kafka"
    bootstrap_servers: str = "kafka:9092"
    topic: str | None = None
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = True
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    path: str | None = None
    max_files_per_trigger: int | None = None
    ending_offsets: str | None = None           # of a batch read
    starting_time: str | None = None
    level_in_time: bool = False


def envelope_stream(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Streaming DataFrame with columns key, value, topic, partition, offset, timestamp, timestampType."""
    if cfg.kind == "kafka":
        if not cfg.topic:
            raise ValueError("a topic source needs a topic")
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
             .option("subscribe", cfg.topic)
             .option("startingOffsets", cfg.starting_offsets)
             .option("failOnDataLoss", str(cfg.fail_on_data_loss).lower()))
        if cfg.max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(cfg.max_offsets_per_trigger))
        # Records are keyed by building, so one topic partition can hold most of them;
        # minPartitions splits large offset ranges over several tasks.
        min_parts = cfg.min_partitions or spark.sparkContext.defaultParallelism
        r = r.option("minPartitions", str(min_parts))
        return r.load()
    if cfg.kind == "archive":
        from .archive import FORMAT, register
        register(spark)
        r = (spark.readStream.format(FORMAT).option("startingOffsets", cfg.starting_offsets)
             .option("failOnDataLoss", str(cfg.fail_on_data_loss).lower()).option("levelInTime", str(cfg.level_in_time).lower()))
        if cfg.starting_time:
            r = r.option("startingTime", cfg.starting_time)
        if cfg.max_offsets_per_trigger:
            r = r.option("maxRecordsPerTrigger", str(cfg.max_offsets_per_trigger))
        return r.load(cfg.path)
    if cfg.kind == "files":
        r = spark.readStream.schema(ENVELOPE_SCHEMA)
        if cfg.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
        return r.parquet(cfg.path)
    raise ValueError(f"unknown source kind {cfg.kind!r}")


def envelope_batch(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """The records of a topic or an archive from its starting to its ending offsets, as a table."""
    if cfg.kind == "kafka":
        r = (spark.read.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap_servers).option("subscribe", cfg.topic))
    elif cfg.kind == "archive":
        from .archive import FORMAT, register
        register(spark)
        r = spark.read.format(FORMAT)
    else:
        raise ValueError(f"records of a {cfg.kind!r} source aren't found by offset")
    r = r.option("startingOffsets", cfg.starting_offsets).option("failOnDataLoss", str(cfg.fail_on_data_loss).lower())
    if cfg.starting_time and cfg.kind == "archive":
        r = r.option("startingTime", cfg.starting_time)
    if cfg.ending_offsets:
        r = r.option("endingOffsets", cfg.ending_offsets)
    return r.load(cfg.path) if cfg.kind == "archive" else r.load()

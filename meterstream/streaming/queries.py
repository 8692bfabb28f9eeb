"""The two streaming queries.

* aggregate query: parse -> window aggregate (stateful) -> every aggregate sink;
* scoring query: parse -> per micro-batch, anomalies to every anomaly sink and
  rejects to every reject sink.

Each query reads the source once and fans out inside ``foreachBatch``; the
micro-batch is persisted once when several outputs read it, and released
afterwards.  Sink
errors propagate, so a failed batch is not committed and is replayed on
restart; the idempotent sinks make the replay exact.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..functions.rules import rule_breach, rule_status
from ..model import MeterModel
from ..operators import parse, scoring, windows
from ..sinks.adapters import PLACE, Batch
from .progress import Stopper


@dataclass(frozen=True)
class QuerySettings:
    name: str
    checkpoint: str
    trigger: str | None = C.TRIGGER_INTERVAL    # processing-time interval
    available_now: bool = False                 # drain what is there, then stop
    stopper: Stopper | None = None              # ends the query between two batches
    drain: bool = False                         # one micro-batch after another; the caller drains it (progress.drain)


def _start(writer, settings: QuerySettings) -> StreamingQuery:
    writer = writer.queryName(settings.name).option("checkpointLocation", settings.checkpoint)
    if settings.available_now:
        writer = writer.trigger(availableNow=True)
    elif settings.drain:
        writer = writer.trigger(processingTime="0 seconds")
    elif settings.trigger:
        writer = writer.trigger(processingTime=settings.trigger)
    return writer.start()


STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """Window state in RocksDB (off-heap, spills to disk) unless the session chose a provider.

    The provider is fixed into a query's checkpoint at its first start.
    """
    if spark.conf.get(STATE_PROVIDER_KEY, None) is None:
        spark.conf.set(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)


SHUFFLE_KEY = "spark.sql.shuffle.partitions"


def parallelism(spark) -> int:
    """Tasks that the cluster runs at once."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no SparkContext (Spark Connect)
        return int(spark.conf.get("spark.default.parallelism", "200"))


@contextmanager
def state_partitions(spark, n: int | None = None):
    """Run a stateful query with ``n`` state partitions, or where the session has not chosen a count.

    The count is fixed into the checkpoint by the first micro-batch, so this
    must span at least that batch (the callers wait for the query to end).
    Defaults to the cluster's parallelism rather than Spark's fixed 200.
    """
    chosen = spark.conf.get(SHUFFLE_KEY, None)
    if n is None and chosen is not None:
        yield
        return
    if n is None:
        n = parallelism(spark)
    spark.conf.set(SHUFFLE_KEY, str(n))
    try:
        yield
    finally:
        if chosen is None:
            spark.conf.unset(SHUFFLE_KEY)
        else:
            spark.conf.set(SHUFFLE_KEY, chosen)


def run_id(spark, checkpoint: str) -> str:
    """The id that a query's checkpoint holds: the same after a restart, another in a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


class _Run:
    """Names a query's batches; the id is read once, by its first batch."""

    def __init__(self, settings: QuerySettings):
        self.settings, self.id = settings, None

    def batch(self, spark, batch_id: int) -> Batch:
        if self.settings.stopper is not None:
            self.settings.stopper.gate(self.settings.name)
        if self.id is None:
            self.id = run_id(spark, self.settings.checkpoint)
        return Batch(self.settings.name, self.id, int(batch_id))


def fan_out(sinks: Sequence, settings: QuerySettings, late=None) -> Callable[[DataFrame, int], None]:
    named = _Run(settings)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        shared, batch = len(sinks) > 1, named.batch(batch_df.sparkSession, batch_id)
        if shared:
            batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for s in sinks:
                s.write(batch_df, batch)
            if late is not None:
                late.write(batch_df.sparkSession, settings.checkpoint, batch)
        finally:
            if shared:
                batch_df.unpersist()
    return run


def observed(decoded: DataFrame, name: str = "records") -> DataFrame:
    """Per-batch counts (rows, rejected) reported with each progress event, without extra jobs."""
    return decoded.observe(name, F.count(F.lit(1)).alias("rows"),
                           F.count(parse.reject_reason()).alias("rejected"))


def aggregate_query(envelope: DataFrame, sinks: Sequence, settings: QuerySettings,
                    duration: str = C.WINDOW_DURATION, metrics=windows.MODEL_METRICS,
                    watermark: str | None = None, output_mode: str = "update", late=None) -> StreamingQuery:
    """Tumbling-window aggregates per building.

    ``update`` mode writes a new revision of every window a batch touched
    (read the latest with ``reports.latest_revision``); ``append`` needs a
    ``watermark`` and writes each window once, when it closes.  Without a
    watermark the state is never evicted (the accept-everything mode).
    ``late`` (``checkpoint.LateRows``) stores the rows that the watermark drops.
    """
    use_rocksdb_state(envelope.sparkSession)
    readings = parse.valid(observed(parse.decode(envelope)))
    aggs = windows.window_aggregate(readings, duration, metrics, watermark=watermark)
    aggs = aggs.withColumn("processed_at", F.current_timestamp())
    return _start(aggs.writeStream.outputMode(output_mode).foreachBatch(fan_out(sinks, settings, late)), settings)


def rollup_query(envelope: DataFrame, shape: Callable[[DataFrame], DataFrame], sinks: Sequence, settings: QuerySettings) -> StreamingQuery:
    """Stateless: partial aggregates (``summaries.rollup``) of each micro-batch, which panels merge.

    Late readings merge like any others; a batch run again replaces its rows.
    """
    readings, named = parse.valid(observed(parse.decode(envelope))), _Run(settings)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch = named.batch(batch_df.sparkSession, batch_id)
        rolled = shape(batch_df)
        for s in sinks:
            s.write(rolled, batch)

    return _start(readings.writeStream.outputMode("append").foreachBatch(run), settings)


Detector = Callable[[DataFrame], DataFrame]


def model_detector(model: MeterModel) -> Detector:
    def detect(readings: DataFrame) -> DataFrame:
        place = tuple(c for c in PLACE if c in readings.columns)
        found = scoring.anomalies(readings, model, (*scoring.ANOMALY_OUTPUT, *place, "received_at"))
        return (found.withColumn("status", rule_status("electricity", "water")).withColumn("is_anomaly", F.lit(True))
                .withColumnRenamed("received_at", "detected_at"))
    return detect


def current_model_detector(models) -> Detector:
    """Scores each batch with the version in use when it begins (``sources.models.CurrentModel``), named in every row."""
    def detect(readings: DataFrame) -> DataFrame:
        version, model = models.get()
        return model_detector(model)(readings).withColumn("model_version", F.lit(version))
    return detect


def rule_detector(high_electricity: float = C.HIGH_ELECTRICITY, high_water: float = C.HIGH_WATER) -> Detector:
    def detect(readings: DataFrame) -> DataFrame:
        return (readings.filter(rule_breach("electricity", "water", high_electricity, high_water))
                .select("building", "floor", "electricity", "water",
                        rule_status("electricity", "water").alias("status"), F.lit(True).alias("is_anomaly"),
                        *[c for c in PLACE if c in readings.columns], "timestamp",
                        F.col("received_at").alias("detected_at")))
    return detect


def scoring_query(envelope: DataFrame, detector: Detector, anomaly_sinks: Sequence,
                  settings: QuerySettings, reject_sinks: Sequence = ()) -> StreamingQuery:
    """Stateless: anomalies and rejects of each micro-batch to their sinks."""
    decoded = observed(parse.decode(envelope, keep=PLACE)).withColumn("received_at", F.current_timestamp())

    shared, named = len(anomaly_sinks) + len(reject_sinks) > 1, _Run(settings)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch = named.batch(batch_df.sparkSession, batch_id)
        if shared:
            batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = detector(batch_df.filter(F.col("reason").isNull()))
            for s in anomaly_sinks:
                s.write(found, batch)
            if reject_sinks:
                bad = parse.rejects(batch_df, keep=PLACE)
                for s in reject_sinks:
                    s.write(bad, batch)
        finally:
            if shared:
                batch_df.unpersist()

    return _start(decoded.writeStream.outputMode("append").foreachBatch(run), settings)

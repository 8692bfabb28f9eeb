"""What a query's checkpoint tells: the records and the watermark of each batch, and the windows still open in its state.

Late rows (T14): a watermark drops rows of windows that have closed, and Spark
only counts them.  The offset log names the records of every micro-batch and the
watermark it had.  ``late_rows`` reads a batch's records again from a source
that finds them by offset (a topic or its archive) and returns those whose
windows had closed before it, so that they can be stored beside the aggregates.

Open windows (T1, T8, T15): ``open_windows`` reads the aggregate's state with
Spark's ``statestore`` source, ``state_operators`` its ``state-metadata``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import from_utc_wall, utc_wall
from ..operators import parse
from ..operators.windows import MODEL_METRICS
from .sources import SourceConfig, envelope_batch

LATE = "window_closed"


@dataclass(frozen=True)
class Logged:
    """A micro-batch as the offset log has it: positions of its source, and the watermark it evicts by."""
    start: str | None
    end: str
    watermark_ms: int
    #: The watermark its rows are held against: that of the batch before.
    late_ms: int


def _log(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str] | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if batch_id < 0 or not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()


def logged_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> Logged:
    """A batch of a query with one source.  It is logged before it runs."""
    lines = _log(spark, checkpoint, batch_id)
    if lines is None:
        raise FileNotFoundError(f"no batch {batch_id} in the offset log of {checkpoint}")
    if len(lines) != 3:
        raise ValueError(f"batch {batch_id} of {checkpoint} has {len(lines) - 2} sources")
    before = _log(spark, checkpoint, batch_id - 1)
    watermark = lambda x: int(json.loads(x[1])["batchWatermarkMs"]) if x else 0
    return Logged(before[2] if before else None, lines[2], watermark(lines), watermark(before))


def late_rows(spark: SparkSession, source: SourceConfig, batch: Logged, duration: str) -> DataFrame | None:
    """Valid readings of a batch whose windows had closed before it, with window, watermark and reason; None if none can be.

    Before the first watermark nothing is late, so a query's first batch (whose
    start the log doesn't hold) has none.
    """
    if batch.start is None or batch.late_ms <= 0 or batch.start == batch.end:
        return None
    cfg = replace(source, starting_offsets=batch.start, ending_offsets=batch.end, starting_time=None)
    rows = parse.valid(parse.decode(envelope_batch(spark, cfg), keep=("topic", "partition", "offset")))
    closed = F.timestamp_millis(F.lit(batch.late_ms))
    window = F.window(from_utc_wall("timestamp"), duration)
    return (rows.withColumn("w", window).filter(F.col("w.end") <= closed)
            .select("building", "floor", "electricity", "water", "topic", "partition", "offset", "timestamp",
                    utc_wall(F.col("w.start")).alias("window_start"), utc_wall(F.col("w.end")).alias("window_end"),
                    utc_wall(closed).alias("watermark"), F.lit(LATE).alias("reason")))


class LateRows:
    """Stores the late rows of each batch of an aggregate query in ``sinks``, a batch replaced where it is run again."""

    def __init__(self, source: SourceConfig, sinks: Sequence, duration: str):
        if source.kind not in ("kafka", "archive"):
            raise ValueError(f"records of a {source.kind!r} source aren't found by offset")
        self.source, self.sinks, self.duration = source, tuple(sinks), duration

    def write(self, spark: SparkSession, checkpoint: str, batch) -> None:
        rows = late_rows(spark, self.source, logged_batch(spark, checkpoint, batch.batch_id), self.duration)
        if rows is not None:
            for s in self.sinks:
                s.write(rows, batch)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful operators of a query: operatorId, operatorName, state partitions and batch ids."""
    return spark.read.format("state-metadata").load(checkpoint)


#: Fields of each metric's buffer in the state, and the metric they give.
BUFFERS = {"avg": (("sum double", "count bigint"), lambda s, c: s / c), "max": (("max double",), lambda x: x),
           "min": (("min double",), lambda x: x), "readings": (("count bigint",), lambda x: x)}


def open_windows(spark: SparkSession, checkpoint: str, metrics: Sequence[str] = MODEL_METRICS,
                 keys: Sequence[str] = ("building",), batch_id: int | None = None) -> DataFrame:
    """Windows in the state of an aggregate query that wasn't started with other ``metrics`` and ``keys``, as the sinks get them.

    After the query's last batch, or after ``batch_id``.  An append query's
    state holds the windows that haven't closed, an update query's all that
    the watermark hasn't passed.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    state = reader.load(checkpoint)
    # Buffers come one after another in the order of the metrics, under names that repeat: they are told apart by place.
    fields, values, n = [], [], 0
    for m in metrics:
        names, value = BUFFERS[m.split("_")[0]]
        fields += [f"f{n + i}: {f.split()[1]}" for i, f in enumerate(names)]
        values.append(value(*[F.col(f"v.f{n + i}") for i in range(len(names))]).alias(m))
        n += len(names)
    named = ", ".join(["w: struct<start: timestamp, end: timestamp>", *[f"k{i}: string" for i in range(len(keys))]])
    rows = state.select(F.col("key").cast(f"struct<{named}>").alias("k"), F.col("value").cast(f"struct<{', '.join(fields)}>").alias("v"))
    return rows.select(*[F.col(f"k.k{i}").alias(k) for i, k in enumerate(keys)], *values,
                       utc_wall(F.col("k.w.start")).alias("window_start"), utc_wall(F.col("k.w.end")).alias("window_end"))

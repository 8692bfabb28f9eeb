"""Archived topic records as a stream source.

An archive holds the records of a topic in segments: parquet files of one topic
partition each, with an unbroken range of its offsets.  An index of segments
(JSON lines, only ever added to) says which file holds which offsets and times.
The records were written by a Spark job; nothing here serves or imitates a
broker.

``TopicArchive`` reads it as a stream with Spark's Python data source API.  Its
offsets are a next offset for each topic partition.  It has a start position
(earliest, latest, by offset or by time), a limit on the records of a
micro-batch, which either shares the limit out by backlog or keeps the topic
partitions level in time, and a policy for records that are gone.

The driver's planner holds the index (a row for each segment); records are read
by the tasks, a range of one segment each, in Arrow batches.  Paths must be
readable by pyarrow's file systems from the driver and all executors.
"""

from __future__ import annotations

import bisect
import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schema import ENVELOPE_SCHEMA
from ..session import delete_path

FORMAT = "topic_archive"
#: Records of a segment.
SEGMENT = 100_000
COLUMNS = [f.name for f in ENVELOPE_SCHEMA.fields]
ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                   ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC")), ("timestampType", pa.int32())])


class RecordsLost(RuntimeError):
    """Records between the stream's position and what the archive still holds are gone."""


# ---- writing ----

def _index(path: str) -> str:
    return f"{path.rstrip('/')}/_index"


def write_archive(envelope: DataFrame, path: str, order: tuple[str, ...] = ("offset",), segment: int = SEGMENT) -> None:
    """Appends records to an archive: their topic partitions stay, offsets go on from the last ones in the given order.

    Offsets are given out by ranges of (partition, order), so a topic partition
    that holds most records is numbered by many tasks.  The segments are
    visible to readers once their index lines are written, all at once.
    """
    spark = envelope.sparkSession
    data = f"{path.rstrip('/')}/segments/{uuid.uuid4().hex}"
    keys = ["partition", *order, "offset"] if "offset" not in order else ["partition", *order]
    ranged = (envelope.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", 33)))
    staged = f"{path.rstrip('/')}/staging/{uuid.uuid4().hex}"
    ranged.write.parquet(staged)
    ranged = spark.read.schema(ranged.schema).parquet(staged)
    parts = ranged.groupBy("partition", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("partition").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    ends = spark.createDataFrame(list(next_offsets(path).items()), "partition string, base long").select(
        F.col("partition").cast("int").alias("partition"), "base")
    starts = (parts.join(F.broadcast(ends), "partition", "left")  # a row for each topic partition
              .select("partition", "task", (F.coalesce("base", F.lit(0)) + F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")))
    # A row for each topic partition and task.
    numbered = (ranged.join(F.broadcast(starts), ["partition", "task"])
                .withColumn("offset", F.col("at") + F.col("shift")).select(*COLUMNS))
    (numbered.withColumn("segment", F.floor(F.col("offset") / segment)).withColumn("of", F.col("partition"))
     .repartition("of", "segment").sortWithinPartitions("of", "segment", "offset")
     .write.partitionBy("of", "segment").parquet(data))
    found = (spark.read.schema("partition int, offset long, timestamp timestamp").parquet(data)
             .groupBy(F.input_file_name().alias("path"))
             .agg(F.first("partition").alias("partition"), F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"),
                  F.unix_micros(F.min("timestamp")).alias("from"), F.unix_micros(F.max("timestamp")).alias("to")))
    _add_lines(found.withColumn("kind", F.lit("add")), path)
    delete_path(spark, staged)


def _add_lines(lines: DataFrame, path: str) -> None:
    """One file of index lines, named after those before it; it appears as a whole."""
    lines.coalesce(1).write.json(f"{_index(path)}/{_next_number(path):012d}")


def _next_number(path: str) -> int:
    names = [f.base_name for f in _list(_index(path))]
    return max((int(n) for n in names if n.isdigit()), default=-1) + 1


def expire(spark: SparkSession, path: str, older_than: datetime) -> int:
    """Retention: drops the segments whose records are all older; returns how many.

    Index lines go first, files after, so readers that still hold the old
    index fail on a missing file rather than skip it.
    """
    limit = _micros(older_than)
    gone = [s for segments in read_index(path).values() for s in segments if s.to < limit]
    if gone:
        _add_lines(spark.createDataFrame([("drop", s.path) for s in gone], "kind string, path string"), path)
        for s in gone:
            delete_path(spark, s.path)
    return len(gone)


# ---- the index ----

@dataclass(frozen=True)
class Segment:
    partition: int
    first: int
    next: int
    start: int
    to: int
    path: str


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return int((t - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _list(path: str) -> list[pafs.FileInfo]:
    fs, p = _open(path)
    return fs.get_file_info(pafs.FileSelector(p, allow_not_found=True))


def read_index(path: str) -> dict[int, list[Segment]]:
    """The segments of each topic partition, by offset."""
    fs, root = _open(_index(path))
    live: dict[str, Segment] = {}
    for folder in sorted((f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name.isdigit()),
                         key=lambda f: f.base_name):
        files = fs.get_file_info(pafs.FileSelector(folder.path))
        if not any(f.base_name == "_SUCCESS" for f in files):
            continue  # still being written
        for f in files:
            if not f.base_name.endswith(".json"):
                continue
            with fs.open_input_stream(f.path) as s:
                for line in s.readall().splitlines():
                    x = json.loads(line)
                    if x["kind"] == "drop":
                        live.pop(x["path"], None)
                    else:
                        live[x["path"]] = Segment(x["partition"], x["first"], x["next"], x["from"], x["to"], x["path"])
    out: dict[int, list[Segment]] = {}
    for s in sorted(live.values(), key=lambda s: (s.partition, s.first)):
        out.setdefault(s.partition, []).append(s)
    return out


def next_offsets(path: str) -> dict[str, int]:
    """The offset after the last record of each topic partition."""
    return {str(p): segments[-1].next for p, segments in read_index(path).items()}


def _times(s: Segment) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and running maximum of the times of a segment."""
    fs, p = _open(s.path)
    t = pq.read_table(p, columns=["offset", "timestamp"], filesystem=fs)
    return t["offset"].to_numpy(), np.maximum.accumulate(t["timestamp"].cast(pa.timestamp("us")).cast(pa.int64()).to_numpy())


def offset_at_time(segments: list[Segment], micros: int) -> int:
    """The first offset at which the time is reached; after the last record where it isn't."""
    for s in segments:
        if s.to >= micros:
            offsets, times = _times(s)
            return int(offsets[np.searchsorted(times, micros)])
    return segments[-1].next


# ---- reading ----

class Range(InputPartition):
    """Offsets of one segment that a task reads."""

    def __init__(self, path: str, first: int, next: int):
        self.path, self.first, self.next = path, first, next


def ranges(index: dict[int, list[Segment]], start: dict[str, int], end: dict[str, int], fail: bool) -> list[Range]:
    """Ranges of segments between two positions; missing records are an error or are left out."""
    out = []
    for p, stop in end.items():
        at = start.get(p, 0)
        for s in index.get(int(p), []):
            if s.next <= at or s.first >= stop:
                continue
            if s.first > at and fail:
                raise RecordsLost(f"topic partition {p}: offsets {at} to {s.first - 1} are gone")
            first = max(at, s.first)
            at = min(s.next, stop)
            out.append(Range(s.path, first, at))
        if at < stop and fail:
            raise RecordsLost(f"topic partition {p}: offsets {at} to {stop - 1} are gone")
    return out


def records(part: Range):
    """The records of a range, in Arrow batches."""
    fs, p = _open(part.path)
    with fs.open_input_file(p) as f:
        for batch in pq.ParquetFile(f).iter_batches(16_384, columns=COLUMNS):
            o = batch.column("offset")
            batch = batch.filter(pc.and_(pc.greater_equal(o, part.first), pc.less(o, part.next)))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in ARROW], schema=ARROW)


class _Settings:
    def __init__(self, options):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("an archive needs a path")
        self.start = options.get("startingOffsets", "earliest")
        self.end = options.get("endingOffsets")
        self.time = options.get("startingTime")
        self.fail = options.get("failOnDataLoss", "true").lower() == "true"
        self.limit = int(options.get("maxRecordsPerTrigger", 0))
        self.level = options.get("levelInTime", "false").lower() == "true"

    def initial(self, index: dict[int, list[Segment]]) -> dict[str, int]:
        """Where a stream without a checkpoint begins."""
        if self.time:
            t = _micros(datetime.fromisoformat(self.time))
            return {str(p): offset_at_time(segments, t) for p, segments in index.items()}
        ends = {str(p): (s[0].first, s[-1].next) for p, s in index.items()}
        if self.start in ("earliest", "latest"):
            return {p: e[self.start == "latest"] for p, e in ends.items()}
        return self._asked(self.start, ends, -2)

    @staticmethod
    def _asked(position: str, ends: dict[str, tuple[int, int]], other: int) -> dict[str, int]:
        """Offsets by topic partition; -2 and -1 (``other`` for those not named) are the ends."""
        asked = {p: int(o) for p, o in json.loads(position).items()}
        if unknown := set(asked) - set(ends):
            raise ValueError(f"no topic partitions {sorted(unknown)}")
        return {p: (e[0] if o == -2 else e[1] if o == -1 else o) for p, e in ends.items() for o in [asked.get(p, other)]}

    def final(self, index: dict[int, list[Segment]]) -> dict[str, int]:
        """Where a table ends."""
        ends = {str(p): (s[0].first, s[-1].next) for p, s in index.items()}
        return self._asked(self.end, ends, -1) if self.end else {p: e[1] for p, e in ends.items()}


class ArchiveStream(DataSourceStreamReader):
    """Positions and ranges of the stream; ``at`` is the end of the last micro-batch planned."""

    def __init__(self, options):
        self.settings, self.at, self.first = _Settings(options), None, None

    def initialOffset(self) -> dict:
        if self.first is None:
            self.first = self.settings.initial(read_index(self.settings.path))
        return self.first

    def latestOffset(self) -> dict:
        index = read_index(self.settings.path)
        if self.at is None:
            self.at = self.initialOffset()
        at = {str(p): self.at.get(str(p), s[0].first) for p, s in index.items()} | {
            p: o for p, o in self.at.items() if int(p) not in index}
        for p, s in index.items():
            if s[-1].next < at[str(p)] and self.settings.fail:
                raise RecordsLost(f"topic partition {p} ends at {s[-1].next}, before the stream's {at[str(p)]}")
        self.at = self._admitted(index, at)
        return self.at

    def _admitted(self, index: dict[int, list[Segment]], at: dict[str, int]) -> dict[str, int]:
        if not self.settings.fail:  # what is gone is left out, and doesn't count
            at = {p: max(o, index[int(p)][0].first) if int(p) in index else o for p, o in at.items()}
        waiting = {p: index[int(p)][-1].next - o for p, o in at.items() if int(p) in index and index[int(p)][-1].next > o}
        total, limit = sum(waiting.values()), self.settings.limit
        if not limit or total <= limit:
            return at | {p: at[p] + n for p, n in waiting.items()}
        if self.settings.level:
            return at | self._level(index, at, waiting, limit)
        return at | {p: at[p] + max(1, n * limit // total) for p, n in waiting.items()}

    @staticmethod
    def _level(index, at: dict[str, int], waiting: dict[str, int], limit: int) -> dict[str, int]:
        """Up to one time in all topic partitions, the earliest that any of them reaches with its share of the limit.

        Reads the times of a segment or two of each topic partition.
        """
        share, reached, held = max(1, limit // len(waiting)), [], {}

        def times(s: Segment):
            if s.path not in held:
                held[s.path] = _times(s)
            return held[s.path]

        for p, n in waiting.items():
            if n <= share:
                continue  # comes to its end
            last = at[p] + share - 1
            segments = index[int(p)]
            s = segments[max(0, bisect.bisect_right([x.first for x in segments], last) - 1)]
            offsets, time = times(s)
            reached.append(int(time[min(np.searchsorted(offsets, last), len(time) - 1)]))
        horizon = min(reached, default=None)
        out = {}
        for p, n in waiting.items():
            out[p] = at[p] + n
            for s in index[int(p)] if horizon is not None else ():
                if s.next > at[p] and s.to > horizon:
                    offsets, time = times(s)
                    out[p] = max(at[p], int(offsets[np.searchsorted(time, horizon, "right")]))
                    break
        return out

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if self.at is None:  # a restart: the position of the checkpoint
            self.at = end
        return ranges(read_index(self.settings.path), start, end, self.settings.fail)

    def read(self, partition: Range):
        return records(partition)

    def commit(self, end: dict) -> None:
        pass


class ArchiveTable(DataSourceReader):
    """The archive between two positions, as a table."""

    def __init__(self, options):
        self.settings = _Settings(options)

    def partitions(self) -> list[Range]:
        index = read_index(self.settings.path)
        return ranges(index, self.settings.initial(index), self.settings.final(index), self.settings.fail) or [Range("", 0, 0)]

    def read(self, partition: Range):
        return records(partition) if partition.path else iter(())


class TopicArchive(DataSource):
    """``format("topic_archive").load(path)``, for ``spark.read`` and ``spark.readStream``.

    Options: ``startingOffsets`` (earliest, latest, or JSON of offsets by topic
    partition, -2 and -1 for these), ``startingTime`` (ISO, UTC unless it says
    otherwise; goes before offsets), ``endingOffsets`` (of a table: JSON, or the
    end), ``failOnDataLoss`` (true),
    ``maxRecordsPerTrigger`` (none), ``levelInTime`` (false).

    A limited micro-batch takes each topic partition's share of the limit by its
    backlog, at least one record; with ``levelInTime`` all records up to one
    time, so that no topic partition runs ahead of a watermark (records of one
    and the same time aren't parted, so such a batch may pass the limit).  Spark
    asks for one end position under the availableNow trigger: drain a limited
    stream with ``progress.drain``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return ENVELOPE_SCHEMA

    def reader(self, schema) -> ArchiveTable:
        return ArchiveTable(self.options)

    def streamReader(self, schema) -> ArchiveStream:
        return ArchiveStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicArchive)

"""Named queries that run real streaming queries over records staged from the tables.

Each call stages the readings as topic records under the shared scratch
folder, runs the query to completion (``availableNow``) in about a dozen
micro-batches at any size, and returns what the sinks hold.  Staged records and checkpoints
are deleted when the query has ended, what the result reads at exit.
"""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from ..functions.parse import utc_wall
from ..model import FROZEN, STRICT
from ..operators import enrich, parse, reports, summaries, windows
from ..schema import result_schema
from ..session import delete_path, scratch_path
from ..sinks import compaction
from ..sinks import DocumentSink, ParquetSink, RelationalSink, aggregate_row, anomaly_row
from ..sinks.adapters import AGG_TIME_COLS, LAYOUT
from ..sources.models import CurrentModel, promote, save_model
from ..sources.results import read_results
from ..sources.tables import readings, with_status
from ..streaming.archive import expire, write_archive
from ..streaming.checkpoint import LateRows, open_windows
from ..streaming.progress import ProgressLog, await_all, drain
from ..streaming.queries import (QuerySettings, aggregate_query, current_model_detector, model_detector, parallelism, rollup_query,
                                 rule_detector, scoring_query, state_partitions)
from ..streaming.replay import RECORDS_PER_FILE, stage_replay
from ..streaming.sources import SourceConfig, envelope_stream
from .compare import r6
from .oracle import TREND_HI, TREND_LO


#: Micro-batches that the records of the tables are read in, whatever their size.
BATCHES = 12


def _limit(spark, sf_dir) -> int:
    return 1 + readings(spark, sf_dir, water=False).count() // BATCHES


def replay_source(spark: SparkSession, sf_dir: str, records: int | None = None) -> SourceConfig:
    """Readings staged as topic records, in no particular order.

    A micro-batch reads a file of ``records``, else as many files as tasks run
    at once, which hold a share of the table: a batch costs about a second
    besides its rows, so their number must not grow with the table.
    """
    path, files = scratch_path(spark, "replay"), 1
    if records is None:
        batch = max(RECORDS_PER_FILE, _limit(spark, sf_dir))
        files = min(-(-batch // RECORDS_PER_FILE), parallelism(spark))
        records = -(-batch // files)
    stage_replay(parse.to_envelope(with_status(readings(spark, sf_dir))), path, records_per_file=records)
    return SourceConfig(kind="files", path=path, max_files_per_trigger=files)


#: Topic partitions of the archives made here, and their segments in all.
ARCHIVE_PARTITIONS, ARCHIVE_SEGMENTS = 3, 60


def archive_source(spark: SparkSession, sf_dir: str, order: str = "timestamp", **how) -> SourceConfig:
    """Readings archived as topic records in time order, whatever order they come in, or in that of arrival; topic partition by reading."""
    path = scratch_path(spark, "archive")
    records = parse.to_envelope(with_status(readings(spark, sf_dir))).withColumn(
        "partition", F.pmod("offset", F.lit(ARCHIVE_PARTITIONS)).cast("int")).withColumn("arrival", F.xxhash64("offset"))
    # As they might arrive from many producers: in no order at all.
    shuffled = records.repartition(8, "arrival")
    write_archive(shuffled, path, order=(order,), segment=1 + readings(spark, sf_dir, water=False).count() // ARCHIVE_SEGMENTS)
    return SourceConfig(kind="archive", path=path, **{"starting_offsets": "earliest", **how})


def _settings(spark, name: str, drain: bool = False) -> QuerySettings:
    return QuerySettings(name=name, checkpoint=scratch_path(spark, f"ckpt-{name}"), available_now=not drain, drain=drain)


def _out(spark, name: str) -> str:
    path = scratch_path(spark, f"{name}-out")
    delete_path(spark, path, at_exit=True)
    return path


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _forget(spark, src: SourceConfig, *settings: QuerySettings) -> None:
    for path in (src.path, *[s.checkpoint for s in settings]):
        delete_path(spark, path)


def _aggregates(spark, sf_dir, name, sinks, records=None) -> None:
    src, settings = replay_source(spark, sf_dir, records), _settings(spark, name)
    with state_partitions(spark):
        await_all([aggregate_query(envelope_stream(spark, src), sinks, settings, duration="1 hour",
                                   metrics=windows.MODEL_METRICS)])
    _forget(spark, src, settings)


def _closed_windows(spark, sf_dir, name, watermark="2 hours"):
    """Runs an append query over an archive, all topic partitions level in time; returns its source and settings."""
    src = archive_source(spark, sf_dir, max_offsets_per_trigger=_limit(spark, sf_dir), level_in_time=True)
    settings, out = _settings(spark, name, drain=True), _out(spark, name)
    with state_partitions(spark):
        drain([aggregate_query(envelope_stream(spark, src), [ParquetSink(f"{out}/aggregations")], settings, duration="1 hour",
                               metrics=windows.MODEL_METRICS, watermark=watermark, output_mode="append")])
    return src, settings, out


def _scoring(spark, sf_dir, name, detector, sinks, records=None) -> None:
    src, settings = replay_source(spark, sf_dir, records=records), _settings(spark, name)
    await_all([scoring_query(envelope_stream(spark, src), detector, sinks, settings)])
    _forget(spark, src, settings)


AGG_COLS = ("building", "avg_electricity", "avg_water", "max_elec", "min_elec", "window_start", "window_end")
ANOMALY_COLS = ("building", "floor", "electricity", "water", "status", "is_anomaly", "cluster", "dist", "offset", "timestamp")
RULE_COLS = tuple(c for c in ANOMALY_COLS if c not in ("cluster", "dist"))


def _latest(rows: DataFrame) -> DataFrame:
    latest = reports.latest_revision(rows.drop("processed_at", "date", "query", "run"), keys=("building", "window_start"))
    return _r6(latest.select(*AGG_COLS), "avg_electricity", "avg_water")


def stream_window_agg(spark, sf_dir, records=None):
    """Update mode, records out of time order: newest revision per window = the batch result."""
    out = _out(spark, "stream_window_agg")
    _aggregates(spark, sf_dir, "stream_window_agg", [ParquetSink(f"{out}/aggregations")], records=records)
    return _latest(read_results(spark, "aggregations", out))


def stream_window_agg_append(spark, sf_dir):
    """Append mode with a 2-hour watermark over records archived in time order: each closed window once."""
    src, settings, out = _closed_windows(spark, sf_dir, "stream_window_agg_append")
    _forget(spark, src, settings)
    return _r6(read_results(spark, "aggregations", out).select(*AGG_COLS), "avg_electricity", "avg_water")


def stream_open_windows(spark, sf_dir):
    """Windows that the append query wrote, and those it still holds in its state: together all windows."""
    src, settings, out = _closed_windows(spark, sf_dir, "stream_open_windows")
    closed = read_results(spark, "aggregations", out).select(*AGG_COLS, F.lit(False).alias("open"))
    held = f"{out}/open"  # read before the checkpoint goes
    open_windows(spark, settings.checkpoint).select(*AGG_COLS, F.lit(True).alias("open")).write.parquet(held)
    _forget(spark, src, settings)
    return _r6(closed.union(spark.read.parquet(held)), "avg_electricity", "avg_water")


def stream_late_rows(spark, sf_dir):
    """Records in no order at all under a 2-hour watermark: readings in windows, and late ones stored aside.

    A row for each window: what it counted (its newest revision) plus its late rows is all of its readings.
    """
    src = archive_source(spark, sf_dir, order="arrival", max_offsets_per_trigger=_limit(spark, sf_dir))
    settings, out = _settings(spark, "stream_late_rows", drain=True), _out(spark, "stream_late_rows")
    with state_partitions(spark):
        drain([aggregate_query(envelope_stream(spark, src), [ParquetSink(f"{out}/aggregations")], settings, duration="1 hour",
                               metrics=("readings",), watermark="2 hours",
                               late=LateRows(src, [ParquetSink(f"{out}/late")], "1 hour"))])
    _forget(spark, src, settings)
    rows = spark.read.schema("building string, readings long, window_start timestamp_ntz, batch_id long").parquet(f"{out}/aggregations")
    counted = reports.latest_revision(rows.select("building", "readings", "window_start", "batch_id"))
    late = read_results(spark, "late", out).groupBy("building", "window_start").agg(F.count(F.lit(1)).alias("late"))
    return counted.join(late, ["building", "window_start"], "full").select(
        "building", "window_start", (F.coalesce("readings", F.lit(0)) + F.coalesce("late", F.lit(0))).alias("readings"))


def stream_rule_anomalies(spark, sf_dir):
    out = _out(spark, "stream_rule_anomalies")
    _scoring(spark, sf_dir, "stream_rule_anomalies", rule_detector(), [ParquetSink(f"{out}/anomalies")])
    return read_results(spark, "anomalies", out).select(*RULE_COLS)


def stream_model_anomalies(spark, sf_dir, records=None):
    out = _out(spark, "stream_model_anomalies")
    _scoring(spark, sf_dir, "stream_model_anomalies", model_detector(FROZEN), [ParquetSink(f"{out}/anomalies")], records)
    return _r6(read_results(spark, "anomalies", out).select(*ANOMALY_COLS), "dist")


#: Where the archive queries begin, and before which the archive has expired.
ARCHIVE_FROM, ARCHIVE_EXPIRED = "2024-01-05T18:00:00", "2024-01-08T00:00:00"


def archive_from_time(spark, sf_dir):
    """Rule anomalies of an archived topic from a time on, in limited micro-batches."""
    src = archive_source(spark, sf_dir, starting_time=ARCHIVE_FROM, max_offsets_per_trigger=_limit(spark, sf_dir))
    settings, out = _settings(spark, "archive_from_time", drain=True), _out(spark, "archive_from_time")
    drain([scoring_query(envelope_stream(spark, src), rule_detector(), [ParquetSink(f"{out}/anomalies")], settings)])
    _forget(spark, src, settings)
    return read_results(spark, "anomalies", out).select(*[c for c in RULE_COLS if c != "offset"])


def archive_gap(spark, sf_dir):
    """A stream asks for records that have expired: by default it fails, or it goes on with those that are left.

    A row for each policy: whether the query failed, how many rule anomalies it stored, and their electricity.
    """
    src, out = archive_source(spark, sf_dir), _out(spark, "archive_gap")
    expire(spark, src.path, datetime.fromisoformat(ARCHIVE_EXPIRED))
    asked = json.dumps({str(p): 0 for p in range(ARCHIVE_PARTITIONS)})
    parts = []
    for policy, fail in (("fail", True), ("skip", False)):
        cfg = replace(src, starting_offsets=asked, fail_on_data_loss=fail, max_offsets_per_trigger=_limit(spark, sf_dir))
        settings, failed = _settings(spark, f"archive_gap_{policy}", drain=True), False
        try:
            drain([scoring_query(envelope_stream(spark, cfg), rule_detector(), [ParquetSink(f"{out}/{policy}/anomalies")], settings)])
        except StreamingQueryException as e:
            if "RecordsLost" not in str(e):
                raise
            failed = True
        delete_path(spark, settings.checkpoint)
        parts.append(read_results(spark, "anomalies", f"{out}/{policy}").agg(
            F.lit(policy).alias("policy"), F.lit(failed).alias("failed"), F.count(F.lit(1)).alias("anomalies"),
            r6(F.coalesce(F.sum("electricity"), F.lit(0.0))).alias("electricity")))
    delete_path(spark, src.path)
    return parts[0].union(parts[1])


def stream_progress(spark, sf_dir):
    """What a progress listener counted in all batches of a scoring query: input, parsed and rejected rows."""
    log = ProgressLog()
    spark.streams.addListener(log)
    src, settings = replay_source(spark, sf_dir), _settings(spark, "stream_progress")
    out = _out(spark, "stream_progress")
    try:
        q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [ParquetSink(f"{out}/anomalies")], settings)
        await_all([q])
        log.drain([q])
    finally:
        spark.streams.removeListener(log)
    _forget(spark, src, settings)
    rows = [(n, t["input_rows"], t["parsed_rows"], t["rejected"]) for n, t in log.totals.items() if n == settings.name]
    return spark.createDataFrame(rows, "name string, input_rows long, parsed_rows long, rejected long")


class _FailsOnce:
    """Fails a sink's first write."""

    def __init__(self, sink):
        self.sink, self.failed = sink, False

    def write(self, df: DataFrame, batch) -> None:
        if not self.failed:
            self.failed = True
            raise RuntimeError(f"injected sink failure in batch {batch.batch_id}")
        self.sink.write(df, batch)


#: Until when the first model is used.
SWAPPED = "2024-01-10T00:00:00"


def stream_model_swap(spark, sf_dir):
    """Another model is promoted while the query runs; each anomaly names the version that found it.

    Readings before a time are archived and processed, the model is swapped, and the rest follows.
    """
    root = scratch_path(spark, "models")
    versions = {save_model(spark, root, m).rpartition("/")[2]: name for name, m in (("first", FROZEN), ("second", STRICT))}
    folder = {name: v for v, name in versions.items()}
    promote(spark, root, folder["first"])
    records = parse.to_envelope(with_status(readings(spark, sf_dir)))
    until = F.lit(SWAPPED.replace("T", " ")).cast("timestamp_ntz")
    path, settings, out = scratch_path(spark, "archive"), _settings(spark, "stream_model_swap", drain=True), _out(spark, "stream_model_swap")
    write_archive(records.filter(utc_wall("timestamp") < until), path, order=("timestamp",))
    src = SourceConfig(kind="archive", path=path, starting_offsets="earliest", max_offsets_per_trigger=_limit(spark, sf_dir))
    q = scoring_query(envelope_stream(spark, src), current_model_detector(CurrentModel(spark, root)), [ParquetSink(f"{out}/anomalies")], settings)
    try:
        q.processAllAvailable()
        promote(spark, root, folder["second"])
        write_archive(records.filter(utc_wall("timestamp") >= until), path, order=("timestamp",))
    finally:
        drain([q])
    _forget(spark, src, settings)
    delete_path(spark, root)
    named = F.element_at(F.create_map(*[F.lit(x) for v in versions.items() for x in v]), F.col("model_version"))
    found = read_results(spark, "anomalies", out).withColumn("model_version", named)
    return _r6(found.select("building", "floor", "electricity", "water", "cluster", "dist", "model_version", "timestamp"), "dist")


def stream_restart(spark, sf_dir):
    """The second of two sinks fails once; after restart both hold every anomaly exactly once."""
    src, settings, out = replay_source(spark, sf_dir), _settings(spark, "stream_restart"), _out(spark, "stream_restart")
    sinks = [ParquetSink(f"{out}/first/anomalies"), _FailsOnce(ParquetSink(f"{out}/second/anomalies"))]
    try:
        await_all([scoring_query(envelope_stream(spark, src), model_detector(FROZEN), sinks, settings)])
        raise AssertionError("the injected failure did not stop the query")
    except StreamingQueryException:
        pass
    await_all([scoring_query(envelope_stream(spark, src), model_detector(FROZEN), sinks, settings)])
    _forget(spark, src, settings)
    first, second = (_r6(read_results(spark, "anomalies", f"{out}/{s}").select(F.lit(s).alias("sink"), *ANOMALY_COLS), "dist")
                     for s in ("first", "second"))
    return first.union(second)


def sink_documents(spark, sf_dir):
    """Anomalies through the document adapter (ISO text times), read back."""
    out = _out(spark, "sink_documents")
    _scoring(spark, sf_dir, "sink_documents", model_detector(FROZEN),
             [DocumentSink("anomalies", ("timestamp", "detected_at"), path=out)])
    schema = result_schema("anomalies").replace("timestamp timestamp_ntz, detected_at timestamp", "timestamp string, detected_at string")
    return _r6(spark.read.schema(schema).json(f"{out}/anomalies").select(*ANOMALY_COLS), "dist")


def sink_documents_aggregates(spark, sf_dir):
    """Aggregates through the document adapter, newest revision of each."""
    out = _out(spark, "sink_documents_aggregates")
    _aggregates(spark, sf_dir, "sink_documents_aggregates",
                [DocumentSink("aggregations", AGG_TIME_COLS, id_fields=("building", "window_start"), path=out)])
    schema = result_schema("aggregations").replace("timestamp_ntz", "string").replace("processed_at timestamp", "processed_at string")
    return _latest(spark.read.schema(schema).json(f"{out}/aggregations"))


def sink_relational(spark, sf_dir):
    """Anomalies through the relational adapter (typed times, dist stored as distance), read back."""
    out = _out(spark, "sink_relational")
    _scoring(spark, sf_dir, "sink_relational", model_detector(FROZEN), [RelationalSink("anomalies", anomaly_row, path=out)])
    back = read_results(spark, "anomalies", out, relational=True).withColumn("timestamp", utc_wall("timestamp"))
    return _r6(back.select(*["distance" if c == "dist" else c for c in ANOMALY_COLS]), "distance")


def sink_relational_aggregates(spark, sf_dir):
    """Aggregates through the relational adapter, newest revision of each."""
    out = _out(spark, "sink_relational_aggregates")
    _aggregates(spark, sf_dir, "sink_relational_aggregates", [RelationalSink("aggregations", aggregate_row, path=out)])
    back = read_results(spark, "aggregations", out, relational=True)
    for c in ("window_start", "window_end"):
        back = back.withColumn(c, utc_wall(c))
    return _latest(back)


def stored_two_streams(spark, sf_dir):
    """Two queries store their anomalies in one table; neither touches the other's."""
    out = _out(spark, "stored_two_streams")
    for name, detector in (("model", model_detector(FROZEN)), ("rules", rule_detector())):
        _scoring(spark, sf_dir, name, detector, [ParquetSink(f"{out}/anomalies")])
    return read_results(spark, "anomalies", out).select("query", "building", "floor", "electricity", "water", "offset", "timestamp")


def stored_panel_trend(spark, sf_dir):
    """The trend panel over stored aggregates: dates prune folders, then the exact range."""
    out = _out(spark, "stored_panel_trend")
    _aggregates(spark, sf_dir, "stored_panel_trend", [ParquetSink(f"{out}/aggregations")])
    rows = reports.stored_between(read_results(spark, "aggregations", out), TREND_LO, TREND_HI)
    latest = reports.latest_revision(rows.drop(*[c for c in (*LAYOUT, "processed_at") if c != "batch_id"]))
    return reports.panel_trend(latest, TREND_LO, TREND_HI).withColumn("value", r6("value"))


def stored_compacted(spark, sf_dir):
    """Windows read from a store before it is compacted, while it is, after, and when merged folders are gone.

    A row for each stage and window.  The last batch stays as it was written.
    """
    out = _out(spark, "stored_compacted")
    table = f"{out}/aggregations"
    _aggregates(spark, sf_dir, "stored_compacted", [ParquetSink(table)], records=_limit(spark, sf_dir))

    def seen(stage: str) -> DataFrame:
        path = f"{out}/seen/{stage}"  # written at once: the next stage changes what is stored
        _latest(read_results(spark, "aggregations", out)).withColumn("stage", F.lit(stage)).write.parquet(path)
        return spark.read.parquet(path)

    stages = [seen("before")]
    manifest = compaction.prepare(spark, table, "aggregations")
    stages.append(seen("during"))
    compaction.switch(spark, table, manifest)
    stages.append(seen("after"))
    compaction.vacuum(spark, table, older_than_s=0)
    stages.append(seen("vacuumed"))
    return stages[0].union(stages[1]).union(stages[2]).union(stages[3])


def _rollups(spark, sf_dir, name, values, shape) -> DataFrame:
    src, settings, out = replay_source(spark, sf_dir), _settings(spark, name), _out(spark, name)
    await_all([rollup_query(envelope_stream(spark, src), shape, [ParquetSink(f"{out}/rollups")], settings)])
    _forget(spark, src, settings)
    fields = ", ".join(f"{v}_n long, {v}_sum double, {v}_min double, {v}_max double" for v in values)
    return spark.read.schema(f"building string, window_start timestamp_ntz, window_end timestamp_ntz, rows long, {fields}, "
                             "date date, batch_id long").parquet(f"{out}/rollups")


def rollup_trend(spark, sf_dir):
    """The trend panel from partial aggregates of the micro-batches: no window state, no readings read again."""
    stored = _rollups(spark, sf_dir, "rollup_trend", ("electricity",), lambda rows: summaries.rollup(rows, ("electricity",)))
    stored = reports.stored_between(stored, TREND_LO, TREND_HI)
    return summaries.trend_of(stored, TREND_LO, TREND_HI).withColumn("value", r6("value"))


def rollup_anomalies_per_building(spark, sf_dir):
    """Anomalies per building from partial aggregates of the micro-batches' anomalies, by day."""
    detect = model_detector(FROZEN)

    def shape(rows: DataFrame) -> DataFrame:
        found = detect(rows.withColumn("received_at", F.current_timestamp()))
        return summaries.rollup(found, ("dist",), duration="1 day")

    stored = _rollups(spark, sf_dir, "rollup_anomalies_per_building", ("dist",), shape)
    return summaries.per_building_of(stored).withColumn("avg_distance", r6("avg_distance"))


def _stored_anomalies(spark, sf_dir, name):
    out = _out(spark, name)
    _scoring(spark, sf_dir, name, model_detector(FROZEN), [ParquetSink(f"{out}/anomalies")])
    return read_results(spark, "anomalies", out)


def stored_panel_latest(spark, sf_dir):
    """The latest-anomalies panel over stored anomalies."""
    return reports.panel_latest(_stored_anomalies(spark, sf_dir, "stored_panel_latest")).withColumn("distance", r6("distance"))


def stored_anomalies_per_building(spark, sf_dir):
    """Anomalies per building over stored anomalies."""
    out = reports.anomalies_per_building(_stored_anomalies(spark, sf_dir, "stored_anomalies_per_building"))
    return out.withColumn("avg_distance", r6("avg_distance"))


def stream_pct_of_average(spark, sf_dir):
    """High-electricity alerts from the stream, joined to a static table of building averages."""
    from .. import constants as C
    avgs = enrich.ReferenceTable(lambda: enrich.building_averages(readings(spark, sf_dir, water=False)))
    out = _out(spark, "stream_pct_of_average")

    def detect(rows: DataFrame) -> DataFrame:
        alerts = rows.filter(F.col("electricity") > F.lit(C.HIGH_ELECTRICITY))
        return enrich.pct_of_average(rows, alerts=alerts, averages=avgs).select(
            "building", "floor", "electricity", "timestamp", "avg_electricity", "pct_of_avg")

    _scoring(spark, sf_dir, "stream_pct_of_average", detect, [ParquetSink(out)])
    schema = "building string, floor int, electricity double, timestamp timestamp_ntz, avg_electricity double, pct_of_avg double"
    stored = spark.read.schema(schema).parquet(out).drop(*LAYOUT)
    return _r6(stored, "avg_electricity", "pct_of_avg")


STREAM_QUERIES = {f.__name__: f for f in (
    archive_from_time, archive_gap, stream_model_swap, rollup_trend, rollup_anomalies_per_building, stored_compacted, stream_open_windows, stream_late_rows, stream_pct_of_average, stream_window_agg, stream_window_agg_append, stream_rule_anomalies, stream_model_anomalies,
    stream_progress, stream_restart, sink_documents, sink_documents_aggregates, sink_relational,
    sink_relational_aggregates, stored_two_streams, stored_panel_trend, stored_panel_latest,
    stored_anomalies_per_building)}

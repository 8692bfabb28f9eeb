"""Streaming behaviour: late rows, revisions, empty batches, rejects, restart."""

import json


import pytest
from helpers import FailOnce, envelope_rows
from meterstream.model import FROZEN
from meterstream.operators import reports
from meterstream.session import scratch_path
from meterstream.sinks import ParquetSink
from meterstream.streaming.progress import ProgressLog, await_all
from meterstream.streaming.queries import (QuerySettings, aggregate_query, model_detector,
                                           scoring_query)
from meterstream.streaming.sources import SourceConfig, envelope_stream


def msg(building, minute_second, electricity, water=100.0, day="2024-01-01"):
    return json.dumps({"building": building, "floor": 1, "electricity": electricity, "water": water,
                       "status": "Normal", "timestamp": f"{day}T{minute_second}+00:00"})


def stage(spark, batches):
    """One file per micro-batch, written in order (modification times follow)."""
    path = scratch_path(spark, "edge-replay")
    for values in batches:
        envelope_rows(spark, values).coalesce(1).write.mode("append").parquet(path)
    return SourceConfig(kind="files", path=path, max_files_per_trigger=1)


def settings(spark, name):
    return QuerySettings(name=name, checkpoint=scratch_path(spark, f"ckpt-{name}"), available_now=True)


def test_watermark_drops_late_rows_and_appends_closed_windows(spark):
    # Lateness is checked against the previous batch's eviction watermark, so a
    # row late by one batch is still counted; late by two batches it is dropped.
    src = stage(spark, [
        [msg("A", "10:00:05", 10.0), msg("A", "10:20:00", 20.0)],   # watermark -> 10:10
        [msg("A", "10:05:00", 99.0), msg("A", "10:30:00", 30.0)],   # late by one batch: kept
        [msg("A", "10:06:00", 77.0), msg("A", "10:40:00", 40.0)],   # late by two batches: dropped
        [msg("A", "10:50:00", 45.0)],                                # watermark -> 10:40
        [msg("A", "10:07:00", 66.0), msg("A", "11:30:00", 50.0)],   # late by three batches: dropped
    ])
    out = scratch_path(spark, "wm-out")
    q = aggregate_query(envelope_stream(spark, src), [ParquetSink(out)], settings(spark, "wm"),
                        duration="1 minute", watermark="10 minutes", output_mode="append")
    await_all([q])
    dropped = sum(sum(op.numRowsDroppedByWatermark for op in p.stateOperators) for p in q.recentProgress)
    assert dropped == 2
    got = spark.read.parquet(out)
    rows = {str(r["window_start"])[11:16]: r["max_elec"] for r in got.collect()}
    assert rows == {"10:00": 10.0, "10:05": 99.0, "10:20": 20.0, "10:30": 30.0, "10:40": 40.0,
                    "10:50": 45.0}
    assert got.count() == 6                              # each closed window exactly once
    # 10:06 and 10:07 never show up; 11:30 is still open when the input ends


def test_update_mode_revisions_and_latest(spark):
    src = stage(spark, [[msg("A", "10:00:01", 100.0)], [msg("A", "10:00:02", 200.0)],
                        [msg("B", "10:00:03", 5.0)]])
    out = scratch_path(spark, "upd-out")
    q = aggregate_query(envelope_stream(spark, src), [ParquetSink(out)], settings(spark, "upd"),
                        duration="30 seconds")
    await_all([q])
    rev = spark.read.parquet(out)
    a = [r["avg_electricity"] for r in rev.filter("building = 'A'").orderBy("batch_id").collect()]
    assert a == [100.0, 150.0]                          # one revision per touching batch
    latest = reports.latest_revision(rev.drop("processed_at"))
    got = {r["building"]: r["avg_electricity"] for r in latest.collect()}
    assert got == {"A": 150.0, "B": 5.0}


def test_empty_batch_and_rejects(spark):
    src = stage(spark, [[], ["{bad", None, msg("A", "10:00:00", 500.0, 900.0)], []])
    anomalies, rejects = scratch_path(spark, "an"), scratch_path(spark, "rj")
    q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [ParquetSink(anomalies)],
                      settings(spark, "empty"), reject_sinks=[ParquetSink(rejects)])
    await_all([q])
    assert spark.read.parquet(anomalies).count() == 1
    reasons = sorted(r["reason"] for r in spark.read.parquet(rejects).collect())
    assert reasons == ["bad_json", "null_value"]


def test_restart_after_sink_failure_no_loss_no_duplicates(spark):
    from pyspark.errors import StreamingQueryException
    src = stage(spark, [[msg("A", "10:00:00", 500.0, 900.0), msg("B", "10:00:01", 600.0, 50.0)],
                        [msg("C", "10:00:02", 700.0, 900.0)]])
    first, second = scratch_path(spark, "s1"), scratch_path(spark, "s2")
    sinks = [ParquetSink(first), FailOnce(ParquetSink(second))]
    st = settings(spark, "restart")
    q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), sinks, st)
    try:
        await_all([q])
        raise AssertionError("expected the injected failure")
    except StreamingQueryException:
        pass
    assert spark.read.parquet(first).count() == 2       # written before the failure
    q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), sinks, st)
    await_all([q])
    a = spark.read.parquet(first).drop("detected_at")
    b = spark.read.parquet(second).drop("detected_at")
    assert a.count() == 3 and b.count() == 3
    assert a.exceptAll(b).count() == 0


def test_progress_listener_sees_every_batch(spark):
    src = stage(spark, [[msg("A", "10:00:00", 1.0)], [msg("A", "10:00:01", 2.0), "{bad"]])
    seen = []
    log = ProgressLog(seen.append)
    spark.streams.addListener(log)
    try:
        q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN),
                          [ParquetSink(scratch_path(spark, "p"))], settings(spark, "progress"))
        await_all([q])
        log.drain([q])
    finally:
        spark.streams.removeListener(log)
    assert len(log.started) == 1 and len(log.ended) == 1
    assert [p["input_rows"] for p in seen if p["input_rows"]] == [1, 2]
    t = log.totals["progress"]
    assert (t["input_rows"], t["parsed_rows"], t["rejected"]) == (3, 3, 1)


def test_reject_count_is_the_number_of_rejects(spark):
    bad = [msg("A", "10:00:00", 1.0).replace('"electricity": 1.0', f'"electricity": {v}') for v in ("null", "1e999", '"x"')]
    src = stage(spark, [["{bad", None, *bad, msg("A", "10:00:00", 1.0)]])
    log, rejects = ProgressLog(), scratch_path(spark, "rj-count")
    spark.streams.addListener(log)
    try:
        q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [], settings(spark, "counted"),
                          reject_sinks=[ParquetSink(rejects)])
        await_all([q])
        log.drain([q])
    finally:
        spark.streams.removeListener(log)
    assert log.totals["counted"]["rejected"] == spark.read.parquet(rejects).count() == 5


def test_a_failed_query_ends_the_others(spark):
    import time
    path = stage(spark, [[msg("A", "10:00:00", 1.0)]]).path
    src = SourceConfig(kind="files", path=path)

    class Fails:
        def write(self, df, batch):
            raise RuntimeError("this sink fails")

    def forever(name):
        return QuerySettings(name=name, checkpoint=scratch_path(spark, f"ckpt-{name}"), trigger="1 second")

    good = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [ParquetSink(scratch_path(spark, "ok"))], forever("goes-on"))
    bad = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [Fails()], forever("fails"))
    began = time.time()
    with pytest.raises(Exception, match="this sink fails"):
        await_all([good, bad])
    assert time.time() - began < 60 and not good.isActive and not bad.isActive


def test_detected_at_is_constant_within_a_batch(spark):
    src = stage(spark, [[msg("A", "10:00:00", 500.0, 900.0), msg("B", "10:00:01", 600.0, 900.0)]])
    out = scratch_path(spark, "det")
    q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [ParquetSink(out)],
                      settings(spark, "det"))
    await_all([q])
    assert spark.read.parquet(out).select("detected_at").distinct().count() == 1


def test_micro_batches_do_not_grow_in_number_with_the_table(spark, tmp_path):
    from meterstream.plans import streams
    from pyspark.sql import functions as F
    n = 100_000  # once 25 micro-batches, a file of 4,000 records each
    i = F.col("event_id")
    ts = F.timestamp_seconds(1_704_067_200 + i * 7).cast("timestamp_ntz")
    (spark.range(n).withColumnRenamed("id", "event_id")
     .select("event_id", ts.alias("ts"), (i % 97).alias("user_id"), F.concat(F.lit("b"), i % 5).alias("event_type"),
             (i % 601).cast("double").alias("value"), F.format_string('{"k": %d}', i % 99).alias("props"))
     .coalesce(1).write.parquet(str(tmp_path / "events.parquet")))
    src = streams.replay_source(spark, str(tmp_path))
    assert src.max_files_per_trigger > 1                 # a batch is read by several tasks
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        q = scoring_query(envelope_stream(spark, src), model_detector(FROZEN), [ParquetSink(scratch_path(spark, "few"))],
                          settings(spark, "few-batches"))
        await_all([q])
        log.drain([q])
    finally:
        spark.streams.removeListener(log)
    t = log.totals["few-batches"]
    assert t["input_rows"] == n and 1 < t["batches"] <= streams.BATCHES + 1

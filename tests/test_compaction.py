"""Compaction of stored results: equal rows in every state, fewer files, replays and concurrent batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterstream.schema import result_schema
from meterstream.session import scratch_path
from meterstream.sinks import Batch, ParquetSink
from meterstream.sinks import compaction as C
from meterstream.sources.results import read_results

DAY = dt.datetime(2024, 1, 1)


def anomalies(spark, n, day=0, first=0):
    rows = [(f"B{i % 3}", 1, float(first + i), 1.0, DAY + dt.timedelta(days=day, minutes=i), DAY) for i in range(n)]
    return spark.createDataFrame(rows, "building string, floor int, electricity double, water double, timestamp timestamp_ntz, detected_at timestamp")


def windows(spark, batch, buildings="ABC"):
    rows = [(b, float(batch), DAY + dt.timedelta(hours=h), DAY + dt.timedelta(hours=h + 1)) for b in buildings for h in (0, 30)]
    return spark.createDataFrame(rows, "building string, avg_electricity double, window_start timestamp_ntz, window_end timestamp_ntz")


def stored(spark, root, table="anomalies"):
    rows = read_results(spark, table, root)
    return sorted(map(str, rows.select("building", "query", "run", "batch_id", "date", "electricity" if table == "anomalies" else "avg_electricity").collect()))


def files(df):
    return df.select(F.input_file_name()).distinct().count()


def test_rows_are_equal_before_during_and_after(spark):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/anomalies", ParquetSink(f"{root}/anomalies")
    for b in range(6):
        sink.write(anomalies(spark, 5, day=b % 2, first=10 * b), Batch("q", "r", b))
    sink.write(anomalies(spark, 4), Batch("other", "r", 0))
    want, many = stored(spark, root), files(read_results(spark, "anomalies", root))
    new = C.prepare(spark, table, "anomalies")
    assert stored(spark, root) == want and C.read_manifest(spark, table) == C.Manifest()
    C.switch(spark, table, new)
    assert stored(spark, root) == want and files(read_results(spark, "anomalies", root)) < many
    assert C.vacuum(spark, table) == 0  # nothing is old enough
    assert C.vacuum(spark, table, older_than_s=0) == 5
    assert stored(spark, root) == want
    left = spark.read.schema(result_schema("anomalies")).parquet(table)
    assert {(r.query, r.batch_id) for r in left.select("query", "batch_id").distinct().collect()} == {("q", 5), ("other", 0)}


def test_dates_without_new_rows_keep_their_snapshot(spark):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/anomalies", ParquetSink(f"{root}/anomalies")
    for b in range(3):
        sink.write(anomalies(spark, 3, day=b), Batch("q", "r", b))
    first = C.compact(spark, table, "anomalies")
    assert set(first.snapshots) == {"2024-01-01", "2024-01-02"} and C.compact(spark, table, "anomalies") is None
    sink.write(anomalies(spark, 3, day=1, first=50), Batch("q", "r", 3))
    sink.write(anomalies(spark, 3, day=1, first=60), Batch("q", "r", 4))
    want = stored(spark, root)
    second = C.compact(spark, table, "anomalies")
    assert second.version == 2 and second.snapshots["2024-01-01"] == first.snapshots["2024-01-01"]
    assert second.snapshots["2024-01-02"] != first.snapshots["2024-01-02"] and set(second.snapshots) == {f"2024-01-0{d}" for d in (1, 2, 3)}
    assert stored(spark, root) == want
    C.vacuum(spark, table, older_than_s=0)
    assert stored(spark, root) == want
    day = read_results(spark, "anomalies", root, lo="2024-01-01", hi="2024-01-01")
    assert day.count() == 3 and files(day) == 1


def test_of_revisions_the_newest_stays(spark):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/aggregations", ParquetSink(f"{root}/aggregations")
    for b in range(4):
        sink.write(windows(spark, b, "ABC" if b < 2 else "A"), Batch("q", "r", b))
    sink.write(windows(spark, 7), Batch("q", "another run", 0))
    C.compact(spark, table, "aggregations")
    rows = read_results(spark, "aggregations", root).filter("run = 'r' AND batch_id < 3")
    assert sorted((r.building, r.avg_electricity) for r in rows.collect()) == [("A", 2.0)] * 2 + [("B", 1.0)] * 2 + [("C", 1.0)] * 2
    latest = read_results(spark, "aggregations", root).groupBy("run", "building", "window_start").agg(F.max_by("avg_electricity", "batch_id").alias("v"))
    assert sorted((r.run, r.building, r.v) for r in latest.collect()) == sorted(
        [("r", "A", 3.0), ("r", "B", 1.0), ("r", "C", 1.0), ("another run", "A", 7.0), ("another run", "B", 7.0), ("another run", "C", 7.0)] * 2)


def test_the_last_batch_can_be_written_again_after_compaction(spark):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/anomalies", ParquetSink(f"{root}/anomalies")
    for b in range(3):
        sink.write(anomalies(spark, 3, first=10 * b), Batch("q", "r", b))
    C.compact(spark, table, "anomalies")
    want = stored(spark, root)
    ParquetSink(table).write(anomalies(spark, 3, first=20), Batch("q", "r", 2))
    assert stored(spark, root) == want
    sink.write(anomalies(spark, 1), Batch("q", "r", 3))  # a stream goes on
    assert read_results(spark, "anomalies", root).count() == 10


def test_rows_without_a_date(spark):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/rejects", ParquetSink(f"{root}/rejects")
    for b in range(3):
        sink.write(spark.createDataFrame([(f"x{b}", "bad_json")], "raw string, reason string"), Batch("q", "r", b))
    C.compact(spark, table, "rejects")
    C.vacuum(spark, table, older_than_s=0)
    assert sorted(r.raw for r in read_results(spark, "rejects", root).collect()) == ["x0", "x1", "x2"]


def test_a_manifest_is_switched_once(spark):
    root = scratch_path(spark, "compact")
    ParquetSink(f"{root}/anomalies").write(anomalies(spark, 1), Batch("q", "r", 0))
    assert C.prepare(spark, f"{root}/anomalies", "anomalies") is None  # the only batch may be written again


def test_snapshots_let_row_groups_be_left_out(spark):
    """Rows are sorted by building: a filter on it reads fewer row groups than there are."""
    import pyarrow.parquet as pq
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/anomalies", ParquetSink(f"{root}/anomalies")
    spark.conf.set("parquet.block.size", "4096")
    try:
        for b in range(2):
            sink.write(anomalies(spark, 6000, first=b), Batch("q", "r", b))
        m = C.compact(spark, table, "anomalies")
    finally:
        spark.conf.unset("parquet.block.size")
    folder = m.snapshots["2024-01-01"].removeprefix("file:")
    import glob
    found = []
    for f in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().names.index("building")
        found += [(s.min, s.max) for i in range(meta.num_row_groups) for s in [meta.row_group(i).column(at).statistics]]
    assert found and sum(lo <= "B1" <= hi for lo, hi in found) <= (len(found) + 2) // 2


@pytest.mark.parametrize("name", ["a b", "q=1/x"])
def test_names_of_queries_that_folders_escape(spark, name):
    root = scratch_path(spark, "compact")
    table, sink = f"{root}/anomalies", ParquetSink(f"{root}/anomalies")
    for b in range(2):
        sink.write(anomalies(spark, 2, first=10 * b), Batch(name, "r", b))
    want = stored(spark, root)
    C.compact(spark, table, "anomalies")
    assert C.vacuum(spark, table, older_than_s=0) == 1 and stored(spark, root) == want

"""Sink adapters: shapes, and replays of a batch."""

import datetime as dt


from meterstream.session import scratch_path
from meterstream.schema import result_schema
from meterstream.sinks import Batch, DocumentSink, ParquetSink, RelationalSink, aggregate_row, anomaly_row
from meterstream.sources.results import read_results


def anomalies_df(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    return spark.createDataFrame(
        [("A", 1, 500.0, 900.0, 1, 3.2, t, t)],
        "building string, floor int, electricity double, water double, cluster int, dist double, "
        "timestamp timestamp_ntz, detected_at timestamp_ntz")


def test_parquet_sink_replay_replaces_batch(spark):
    path = scratch_path(spark, "pq")
    s = ParquetSink(path)
    df = anomalies_df(spark)
    s.write(df, Batch("q", "r", 3))
    s.write(df, Batch("q", "r", 3))          # replay of the same batch
    s.write(df, Batch("q", "r", 4))
    got = spark.read.parquet(path)
    assert sorted(r["batch_id"] for r in got.collect()) == [3, 4]


def test_queries_and_runs_keep_apart(spark):
    root = scratch_path(spark, "apart")
    s, df = ParquetSink(f"{root}/anomalies"), anomalies_df(spark)
    for query, run in (("monitor", "a"), ("rules", "a"), ("monitor", "b")):
        s.write(df, Batch(query, run, 0))
    assert read_results(spark, "anomalies", root).count() == 3


def test_replay_that_finds_nothing_clears_the_batch(spark):
    root = scratch_path(spark, "cleared")
    for sink, read in ((ParquetSink(f"{root}/anomalies"), lambda: read_results(spark, "anomalies", root)),
                       (DocumentSink("docs", ("timestamp", "detected_at"), path=root),
                        lambda: spark.read.schema("building string").json(f"{root}/docs"))):
        sink.write(anomalies_df(spark), Batch("q", "r", 0))
        assert read().count() == 1
        sink.write(anomalies_df(spark).limit(0), Batch("q", "r", 0))
        assert read().count() == 0


def test_results_that_were_never_written_read_as_empty(spark):
    got = read_results(spark, "aggregations", scratch_path(spark, "nothing"))
    assert got.count() == 0 and "window_start" in got.columns


def test_a_time_range_reads_only_its_dates(spark):
    from meterstream.operators.reports import stored_between
    root, t = scratch_path(spark, "dates"), dt.datetime(2024, 1, 1)
    rows = [("A", 1, 1.0, 1.0, 1, 3.0, t + dt.timedelta(days=i), t) for i in range(5)]
    df = spark.createDataFrame(rows, anomalies_df(spark).schema)
    ParquetSink(f"{root}/anomalies").write(df, Batch("q", "r", 0))
    got = stored_between(read_results(spark, "anomalies", root), "2024-01-02 00:00:00", "2024-01-03 10:00:00")
    assert got.count() == 2
    assert "PartitionFilters: [isnotnull(date" in got._jdf.queryExecution().executedPlan().toString()
    assert "dist double" in result_schema("anomalies")


def test_document_sink_iso_text(spark):
    path = scratch_path(spark, "doc")
    DocumentSink("anomalies", ("timestamp", "detected_at"), format="json", path=path).write(anomalies_df(spark), Batch("q", "r", 0))
    DocumentSink("anomalies", ("timestamp", "detected_at"), format="json", path=path).write(anomalies_df(spark), Batch("q", "r", 0))
    rows = spark.read.json(f"{path}/anomalies").collect()
    assert len(rows) == 1 and rows[0]["timestamp"] == "2024-01-01T10:00:00.123456"


def test_relational_projection(spark):
    path = scratch_path(spark, "rel")
    RelationalSink("anomalies", anomaly_row, path=path).write(anomalies_df(spark), Batch("q", "r", 0))
    got = spark.read.parquet(f"{path}/anomalies")
    assert "distance" in got.columns and "dist" not in got.columns
    assert dict(got.dtypes)["timestamp"] == "timestamp"


def test_aggregate_projection(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame([("A", 1.0, 2.0, 3.0, 0.5, t, t, t)],
                               "building string, avg_electricity double, avg_water double, max_elec double, "
                               "min_elec double, window_start timestamp_ntz, window_end timestamp_ntz, "
                               "processed_at timestamp")
    out = aggregate_row(df)
    assert out.columns == ["building", "avg_electricity", "avg_water", "max_elec", "min_elec",
                           "window_start", "window_end", "processed_at"]
    assert dict(out.dtypes)["window_start"] == "timestamp"


def test_aggregate_projection_follows_the_metrics(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame([("A", 1.0, 2.0, 3.0, 4.0, t, t, t)],
                               "building string, avg_electricity double, avg_water double, "
                               "max_electricity double, max_water double, window_start timestamp_ntz, "
                               "window_end timestamp_ntz, processed_at timestamp")
    assert aggregate_row(df).columns == ["building", "avg_electricity", "avg_water", "max_electricity",
                                         "max_water", "window_start", "window_end", "processed_at"]


def test_anomaly_projection_for_rule_anomalies(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame([("A", 1, 200.0, 10.0, "High", t, t)],
                               "building string, floor int, electricity double, water double, status string, "
                               "timestamp timestamp_ntz, detected_at timestamp")
    assert anomaly_row(df).columns == ["building", "floor", "electricity", "water", "status",
                                       "timestamp", "detected_at"]

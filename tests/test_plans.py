"""Physical plan properties that matter at scale."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from meterstream.operators import enrich, reports, windows
from meterstream.sources.tables import readings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_aggregate_is_partial_then_final(spark):
    p = plan(windows.window_aggregate(readings(spark, SF_SMALL)))
    assert "partial_avg" in p and "Exchange hashpartitioning" in p


def test_window_aggregate_prunes_columns(spark):
    df = windows.window_aggregate(readings(spark, SF_SMALL))
    p = df._jdf.queryExecution().executedPlan().toString()
    # props is needed for water; event_id is not
    assert "event_id" not in p.split("ReadSchema")[-1]


def test_filters_reach_the_scan(spark):
    r = readings(spark, SF_SMALL)
    p = plan(r.filter(F.col("electricity") > 180).filter(F.col("timestamp") >= "2024-01-05"))
    assert "GreaterThan(value,180.0)" in p
    assert "GreaterThanOrEqual(ts," in p


def test_latest_revision_uses_an_aggregate_not_a_sort(spark):
    aggs = windows.window_aggregate(readings(spark, SF_SMALL)).withColumn("batch_id", F.lit(1))
    p = plan(reports.latest_revision(aggs))
    assert "Window" not in p and "partial_max_by" in p


def test_pct_of_average_has_no_building_window(spark):
    p = plan(enrich.pct_of_average(readings(spark, SF_SMALL)))
    assert "Window" not in p


def test_panel_latest_is_top_k(spark):
    from meterstream.model import FROZEN
    from meterstream.operators import scoring
    p = plan(reports.panel_latest(scoring.anomalies(readings(spark, SF_SMALL), FROZEN)))
    assert "TakeOrderedAndProject" in p


def test_pct_of_average_keeps_alerts_without_an_average(spark):
    df = spark.createDataFrame([("A", 200.0), ("new", 300.0), (None, 400.0)], "building string, electricity double")
    avgs = spark.createDataFrame([("A", 100.0)], "building string, avg_electricity double")
    got = {r.building: r.pct_of_avg for r in enrich.pct_of_average(df, averages=avgs).collect()}
    assert got == {"A": 200.0, "new": None, None: None}


def test_profile_queries_do_not_read_props(spark):
    from meterstream.plans.catalog import QUERIES
    for name in ("diurnal_profile", "expected_load"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "props" not in p and "get_json_object" not in p


def test_skewed_building_is_combined_before_the_shuffle(spark):
    """One building with a third of the rows: per-building results stay exact."""
    from meterstream.operators import windows as W
    r = readings(spark, SF_SMALL)
    hot = r.withColumn("building", F.when(F.col("reading_id") % 3 == 0, F.lit("hot")).otherwise(F.col("building")))
    out = W.window_aggregate(hot, "1 hour", ("readings",)).groupBy("building").agg(F.sum("readings").alias("n"))
    got = {row["building"]: row["n"] for row in out.collect()}
    want = {row["building"]: row["count"] for row in hot.groupBy("building").count().collect()}
    assert got == want and got["hot"] == r.filter(F.col("reading_id") % 3 == 0).count()


def test_ingested_readings_prune_by_date_and_match_raw(spark):
    from meterstream.model import FROZEN
    from meterstream.operators import scoring
    from meterstream.session import scratch_path
    from meterstream.sources.tables import read_readings, write_readings
    path = scratch_path(spark, "readings-table")
    raw = readings(spark, SF_SMALL)
    write_readings(raw, path)
    table = read_readings(spark, path).drop("date")
    a = windows.window_aggregate(raw, "1 hour")
    b = windows.window_aggregate(table, "1 hour")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    day = read_readings(spark, path).filter(F.col("date") == "2024-01-03")
    p = plan(scoring.anomalies(day, FROZEN))
    assert "PartitionFilters: [isnotnull(date" in p and "get_json_object" not in p


def test_registered_batch_queries_avoid_slow_operators(spark):
    """No Python evaluation, no cartesian / nested-loop joins, no window operator in any batch query."""
    from meterstream.plans.catalog import QUERIES
    banned = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
              "WindowExec", "Window [")
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "sink_", "stored_")) or name.endswith(("_fit", "_roundtrip")):
            continue          # these run a stream on call; their sinks are read back as plain scans
        p = plan(fn(spark, SF_SMALL))
        assert not [b for b in banned if b in p], name

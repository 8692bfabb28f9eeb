"""Command-line flow: train, stage a replay, monitor, report."""

import pytest

from conftest import SF_SMALL
from meterstream import jobs
from meterstream.session import scratch_path
from meterstream.streaming.sources import SourceConfig, envelope_stream


def test_train_monitor_report(spark, capsys):
    root = scratch_path(spark, "jobs")
    from meterstream.sources.tables import readings
    readings(spark, SF_SMALL).write.parquet(f"{root}/train.parquet")
    jobs.main(["train", "--input", f"{root}/train.parquet", "--models", f"{root}/models"])
    jobs.main(["stage-replay", "--events", f"{SF_SMALL}/events.parquet", "--out", f"{root}/replay", "--records-per-file", "400"])
    jobs.main(["monitor", "--replay", f"{root}/replay", "--models", f"{root}/models",
               "--results", f"{root}/results", "--checkpoints", f"{root}/ckpt", "--available-now",
               "--documents", "json", "--shuffle-partitions", "4"])
    s = spark
    aggs = s.read.parquet(f"{root}/results/aggregations")
    assert aggs.select("batch_id").distinct().count() == 3
    an = s.read.parquet(f"{root}/results/anomalies")
    assert an.count() > 0
    assert s.read.json(f"{root}/results/documents/anomalies").count() == an.count()
    capsys.readouterr()
    jobs.main(["report", "--results", f"{root}/results", "--panel", "per-building"])
    assert "anomaly_count" in capsys.readouterr().out
    # the rules stream shares the results folder
    before = an.count()
    jobs.main(["rules", "--replay", f"{root}/replay", "--results", f"{root}/results", "--checkpoints", f"{root}/ckpt",
               "--available-now", "--shuffle-partitions", "4"])
    said = capsys.readouterr().out
    assert all(f"{q}: batch {b}," in said for q in ("rules-aggregations", "rules-anomalies") for b in range(3))
    both = s.read.parquet(f"{root}/results/anomalies").groupBy("query").count().collect()
    assert {r["query"] for r in both} == {"monitor-anomalies", "rules-anomalies"}
    assert next(r["count"] for r in both if r["query"] == "monitor-anomalies") == before


def test_topic_source_needs_its_connector(spark):
    cfg = SourceConfig(kind="kafka", bootstrap_servers="localhost:1", topic="t")
    with pytest.raises(Exception, match="(?i)kafka"):
        envelope_stream(spark, cfg)


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        envelope_stream(spark, SourceConfig(kind="socket"))


def test_publish_needs_the_topic_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.main(["publish", "--events", f"{SF_SMALL}/events.parquet", "--bootstrap", "localhost:1", "--topic", "t"])


def test_rules_stream_and_reports(spark, duck, capsys):
    import __spark_entry__ as entry
    root = scratch_path(spark, "jobs-rules")
    jobs.main(["stage-replay", "--events", f"{SF_SMALL}/events.parquet", "--out", f"{root}/archive", "--ordered"])
    jobs.main(["rules", "--archive", f"{root}/archive", "--starting-offsets", "earliest", "--max-offsets", "300", "--results", f"{root}/results",
               "--checkpoints", f"{root}/ckpt", "--available-now", "--documents", "json",
               "--shuffle-partitions", "4", "--watermark", "none"])
    an = spark.read.parquet(f"{root}/results/anomalies")
    want = duck(SF_SMALL).execute(f"SELECT count(*) FROM ({entry.oracle_sql()['rule_anomalies']})").fetchone()[0]
    assert an.count() == want and "status" in an.columns
    for panel in ("latest", "per-building", "trend"):
        jobs.main(["report", "--results", f"{root}/results", "--panel", panel])
    jobs.main(["report", "--results", f"{root}/results", "--panel", "latest", "--by", "timestamp",
               "--start", "2024-01-01 00:00:00", "--end", "2024-01-02 00:00:00"])
    out = capsys.readouterr().out
    assert "anomaly_count" in out and "distance" in out


def test_reports_tell_queries_and_runs_apart(spark, capsys):
    """Two queries and a second run in one folder: a panel gives each point once."""
    root = scratch_path(spark, "jobs-runs")
    from meterstream.sources.tables import readings
    readings(spark, SF_SMALL).write.parquet(f"{root}/train.parquet")
    jobs.main(["train", "--input", f"{root}/train.parquet", "--models", f"{root}/models"])
    jobs.main(["stage-replay", "--events", f"{SF_SMALL}/events.parquet", "--out", f"{root}/replay"])
    common = ["--replay", f"{root}/replay", "--results", f"{root}/results", "--available-now", "--shuffle-partitions", "2",
              "--window", "1 hour", "--watermark", "none"]

    def panel(name, *how):
        capsys.readouterr()
        jobs.main(["report", "--results", f"{root}/results", "--panel", name, *how])
        return capsys.readouterr().out.strip().split("\n")[1:]

    jobs.main(["rules", *common, "--checkpoints", f"{root}/ckpt"])
    rules, rule_counts = panel("trend"), panel("per-building")
    jobs.main(["monitor", *common, "--checkpoints", f"{root}/ckpt", "--models", f"{root}/models"])
    once, counts = panel("trend"), panel("per-building")
    jobs.main(["monitor", *common, "--checkpoints", f"{root}/ckpt-2", "--models", f"{root}/models"])
    assert len({tuple(x.split("\t")[:2]) for x in once}) == len(once) > 0
    assert panel("trend") == once == rules and panel("per-building") == counts
    assert panel("per-building", "--query", "rules-anomalies") == rule_counts != counts
    jobs.main(["compact", "--results", f"{root}/results", "--keep-hours", "0"])
    assert panel("trend") == once and panel("per-building") == counts

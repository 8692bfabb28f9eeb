"""Command-line jobs: training, the two streams, report panels.

    python -m meterstream train --input training_csv/ --models models/
    python -m meterstream monitor --bootstrap kafka:9092 --topic readings --models models/ --results results/
    python -m meterstream rules --bootstrap kafka:9092 --topic readings --results results/
    python -m meterstream report --results results/ --panel latest
    python -m meterstream stage-replay --events events.parquet --out replay/
    python -m meterstream publish --events events.parquet --bootstrap kafka:9092 --topic readings
    python -m meterstream compact --results results/
    python -m meterstream ingest --events events.parquet --out readings/

Checkpoints go under ``--checkpoints`` or, by default, under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from . import constants as C
from .session import build_session, shared_dir


def _sinks_for(args, kind: str):
    from .sinks import ConsoleSink, DocumentSink, ParquetSink, RelationalSink, aggregate_row, anomaly_row
    from .sinks.adapters import PLACE
    out = [ParquetSink(f"{args.results.rstrip('/')}/{kind}")]
    if args.documents:
        time_cols = ("window_start", "window_end", "processed_at") if kind == "aggregations" \
            else ("timestamp", "detected_at")
        ids = ("building", "window_start") if kind == "aggregations" else PLACE
        out.append(DocumentSink(kind, time_cols, id_fields=ids, format=args.documents,
                                path=f"{args.results.rstrip('/')}/documents"))
    if args.jdbc_url:
        props = _jdbc(args)
        out.append(RelationalSink(kind, aggregate_row if kind == "aggregations" else anomaly_row,
                                  url=args.jdbc_url, properties=props))
    if args.console and kind == "aggregations":
        out.append(ConsoleSink())
    return out


def _jdbc(args) -> dict[str, str]:
    """Connection properties; the password comes from a file, never from the command line."""
    props = {"user": args.jdbc_user or ""}
    if args.jdbc_password_file:
        with open(args.jdbc_password_file, encoding="utf-8") as f:
            props["password"] = f.read().strip()
    if getattr(args, "jdbc_driver", None):
        props["driver"] = args.jdbc_driver
    return props


def _source(args):
    from .streaming.sources import SourceConfig
    if args.archive:
        return SourceConfig(kind="archive", path=args.archive, starting_offsets=args.starting_offsets,
                            starting_time=args.starting_time, fail_on_data_loss=not args.tolerate_data_loss,
                            max_offsets_per_trigger=args.max_offsets, level_in_time=args.level_in_time)
    if args.replay:
        return SourceConfig(kind="files", path=args.replay, max_files_per_trigger=args.max_files)
    return SourceConfig(kind="kafka", bootstrap_servers=args.bootstrap, topic=args.topic,
                        starting_offsets=args.starting_offsets,
                        fail_on_data_loss=not args.tolerate_data_loss,
                        max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions)


def _settings(args, spark, name, stopper=None):
    from .streaming.queries import QuerySettings
    root = (args.checkpoints or f"{shared_dir(spark)}/meterstream-checkpoints").rstrip("/")
    # Spark takes all that is there as one batch of an archive under availableNow, so a drained archive stops by itself.
    return QuerySettings(name=name, checkpoint=f"{root}/{name}", trigger=args.trigger,
                         available_now=args.available_now and not args.archive, drain=bool(args.available_now and args.archive),
                         stopper=stopper)


def cmd_train(args) -> None:
    from .operators.training import fit_model
    from .sources import csv
    from .sources.models import save_model
    spark = build_session(app="meterstream-train")
    if args.input.endswith(".parquet"):
        df = spark.read.parquet(args.input)
    else:
        lines = csv.read_csv(spark, args.input)
        df = csv.rows(lines)
        if args.rejects:
            csv.rejects(lines).write.mode("error").parquet(args.rejects)
    model, pipeline = fit_model(df, k=args.k, seed=args.seed, threshold_rule=args.threshold_rule)
    version = save_model(spark, args.models, model, pipeline)
    print(f"model saved to {version}; threshold {model.threshold}")


def _run_streams(args, detector_name: str) -> None:
    from .streaming.progress import ProgressLog, Stopper, await_all, drain
    from .streaming.queries import aggregate_query, current_model_detector, rule_detector, scoring_query, state_partitions
    from .streaming.sources import envelope_stream
    from .operators import windows
    spark = build_session(app=f"meterstream-{detector_name}")
    listener = ProgressLog(lambda p: print(
        f"{p['name']}: batch {p['batch_id']}, {p['input_rows']} rows, {p['rejected']} rejected, "
        f"{p['dropped_late']} too late, {p['rows_per_second']:.0f} rows/s", flush=True))
    spark.streams.addListener(listener)
    env = envelope_stream(spark, _source(args))
    if detector_name == "monitor":
        from .sources.models import CurrentModel
        detector = current_model_detector(CurrentModel(spark, args.models))
        metrics = windows.MODEL_METRICS
    else:
        detector = rule_detector()
        metrics = windows.RULE_METRICS
    stopper = Stopper(spark, args.stop_marker)
    stopper.on_sigterm()
    watermark = None if args.watermark.lower() == "none" else args.watermark
    if watermark is None and args.output_mode == "append":
        raise SystemExit("append mode needs a watermark")
    from .sinks import ParquetSink
    running = []
    with state_partitions(spark, args.shuffle_partitions):
        try:
            running.append(aggregate_query(
                env, _sinks_for(args, "aggregations"), _settings(args, spark, f"{detector_name}-aggregations", stopper),
                duration=args.window, metrics=metrics, watermark=watermark, output_mode=args.output_mode))
            running.append(scoring_query(
                env, detector, _sinks_for(args, "anomalies"), _settings(args, spark, f"{detector_name}-anomalies", stopper),
                reject_sinks=[ParquetSink(f"{args.results.rstrip('/')}/rejects")]))
            if args.available_now and args.archive:
                drain(running)
            else:
                await_all(running, stopper=stopper)
        except KeyboardInterrupt:
            pass  # await_all has stopped them
        finally:
            listener.drain(running)
            spark.streams.removeListener(listener)


def cmd_stage_replay(args) -> None:
    from .operators import parse
    from .sources.tables import readings_from_events, with_status
    from .streaming.archive import write_archive
    from .streaming.replay import stage_replay
    spark = build_session(app="meterstream-stage")
    env = parse.to_envelope(with_status(readings_from_events(spark.read.parquet(args.events))))
    if args.ordered:
        write_archive(env, args.out, order=("timestamp",), segment=args.records_per_file)
        print(f"archived: use --archive {args.out}")
        return
    stage_replay(env, args.out, args.records_per_file)
    print(f"staged: use --replay {args.out} --max-files N for N files of at most {args.records_per_file} records a batch")


def cmd_ingest(args) -> None:
    """Parse an events table once into a date-partitioned readings table."""
    from .sources.tables import readings_from_events, with_status, write_readings
    spark = build_session(app="meterstream-ingest")
    write_readings(with_status(readings_from_events(spark.read.parquet(args.events))), args.out)


def cmd_promote(args) -> None:
    """Makes a saved model version the one that running monitors use from their next batch on."""
    from .sources.models import promote
    spark = build_session(app="meterstream-promote")
    print(f"pointer {promote(spark, args.models, args.version)}: {args.version}")


def cmd_compact(args) -> None:
    """Merges the finished batches of every result table into snapshots, and deletes what that has made superfluous."""
    from .schema import RESULTS
    from .session import path_exists
    from .sinks import compaction
    spark = build_session(app="meterstream-compact")
    for name in RESULTS:
        table = f"{args.results.rstrip('/')}/{name}"
        if path_exists(spark, table):
            new = compaction.compact(spark, table, name)
            gone = compaction.vacuum(spark, table, args.keep_hours * 3600)
            print(f"{name}: {'nothing to merge' if new is None else f'manifest {new.version}'}, {gone} folders deleted")


def cmd_publish(args) -> None:
    """Readings of an events table as keyed topic records (key = building, value = JSON)."""
    from .operators import parse
    from .sinks import KafkaSink
    from .sources.tables import readings_from_events, with_status
    spark = build_session(app="meterstream-publish")
    env = parse.to_envelope(with_status(readings_from_events(spark.read.parquet(args.events))))
    KafkaSink(args.bootstrap, args.topic).write(env)


def cmd_report(args) -> None:
    from .operators import reports
    from .sources.results import read_results
    spark = build_session(app="meterstream-report")
    def load(table):
        df = read_results(spark, table, path=args.results, url=args.jdbc_url, properties=_jdbc(args))
        if args.results and args.start and args.end and (table == "aggregations" or args.by == "timestamp"):
            df = reports.stored_between(df, args.start, args.end)
        df = reports.one_run(df, args.query, args.run, "processed_at" if table == "aggregations" else "detected_at")
        return df.withColumnRenamed("distance", "dist")      # relational stores name it distance

    if args.panel == "trend":
        keys = ("building", "window_start", "query", "run")
        rows = load("aggregations").drop("processed_at", "date")
        out = reports.panel_trend(reports.latest_revision(rows, keys=keys), args.start, args.end)
    elif args.panel == "latest":
        found = reports.time_range(load("anomalies"), args.by, args.start, args.end)
        out = reports.panel_latest(found, n=args.rows, time_col=args.by)
    else:
        out = reports.anomalies_per_building(load("anomalies"))
    if args.out:
        out.write.mode("error").option("header", True).csv(args.out)
        return
    print("\t".join(out.columns))
    for row in out.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="meterstream")
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train", help="fit scaler, K-means and threshold; save a new model version")
    t.add_argument("--input", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--rejects", default=None, help="where CSV lines that don't fit are written; else they are left out")
    t.add_argument("--k", type=int, default=C.KMEANS_K)
    t.add_argument("--seed", type=int, default=C.KMEANS_SEED)
    t.add_argument("--threshold-rule", choices=("mean+3sd", "p95", "p95-approx"), default="mean+3sd")
    t.set_defaults(fn=cmd_train)

    helps = {"monitor": "stream: window aggregates and K-means anomalies to every sink",
             "rules": "stream: window aggregates and fixed-limit anomalies to every sink"}
    for name in ("monitor", "rules"):
        s = sub.add_parser(name, help=helps[name])
        s.add_argument("--bootstrap", default="kafka:9092")
        s.add_argument("--topic", default=None, help="needed unless --replay is given")
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--tolerate-data-loss", action="store_true")
        s.add_argument("--max-offsets", type=int, default=None, help="most records of a micro-batch")
        s.add_argument("--min-partitions", type=int, default=None)
        s.add_argument("--replay", default=None, help="read topic records from parquet files instead")
        s.add_argument("--max-files", type=int, default=1)
        s.add_argument("--archive", default=None, help="read archived topic records (stage-replay --ordered) instead")
        s.add_argument("--starting-time", default=None, help="ISO time from which an archive is read")
        s.add_argument("--level-in-time", action="store_true", help="an archive's micro-batches end at one time in all topic partitions")
        s.add_argument("--models", default=None)
        s.add_argument("--results", required=True)
        s.add_argument("--checkpoints", default=None)
        s.add_argument("--window", default=C.WINDOW_DURATION)
        s.add_argument("--watermark", default="10 minutes",
                       help="how late a reading may arrive; 'none' keeps every window's state forever")
        s.add_argument("--output-mode", choices=("update", "append"), default="update",
                       help="update: a revision per touching batch; append: each window once, when closed")
        s.add_argument("--trigger", default=C.TRIGGER_INTERVAL)
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--stop-marker", default=None,
                       help="a path; once something is there (or on SIGTERM) the queries stop when their batches have ended")
        s.add_argument("--documents", default=None, help="document sink format, e.g. mongodb or json")
        s.add_argument("--jdbc-url", default=None)
        s.add_argument("--jdbc-user", default=None)
        s.add_argument("--jdbc-password-file", default=None)
        s.add_argument("--jdbc-driver", default=None)
        s.add_argument("--console", action="store_true")
        s.add_argument("--shuffle-partitions", type=int, default=None,
                       help="state partitions of the window aggregate (fixed at the first start)")
        s.set_defaults(fn=lambda a, n=name: _run_streams(a, n))

    st = sub.add_parser("stage-replay", help="topic records from an events table, as replay files")
    st.add_argument("--events", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--records-per-file", type=int, default=100_000)
    st.add_argument("--ordered", action="store_true", help="as an archive in time order, with offsets given out anew")
    st.set_defaults(fn=cmd_stage_replay)

    pr = sub.add_parser("promote", help="have running monitors use a saved model version from their next batch on")
    pr.add_argument("--models", required=True)
    pr.add_argument("--version", required=True, help="its folder's name under --models")
    pr.set_defaults(fn=cmd_promote)

    co = sub.add_parser("compact", help="merge the small files of a result store into snapshots")
    co.add_argument("--results", required=True)
    co.add_argument("--keep-hours", type=float, default=24.0, help="how long merged files stay for readers of an older state")
    co.set_defaults(fn=cmd_compact)

    ig = sub.add_parser("ingest", help="parse an events table into a date-partitioned readings table")
    ig.add_argument("--events", required=True)
    ig.add_argument("--out", required=True)
    ig.set_defaults(fn=cmd_ingest)

    pb = sub.add_parser("publish", help="publish an events table to the topic as JSON readings")
    pb.add_argument("--events", required=True)
    pb.add_argument("--bootstrap", default="kafka:9092")
    pb.add_argument("--topic", required=True)
    pb.set_defaults(fn=cmd_publish)

    r = sub.add_parser("report", help="trend, latest anomalies or anomalies per building from the results")
    r.add_argument("--results", default=None, help="parquet result store (or use --jdbc-url)")
    r.add_argument("--jdbc-url", default=None)
    r.add_argument("--jdbc-user", default=None)
    r.add_argument("--jdbc-password-file", default=None)
    r.add_argument("--panel", choices=("trend", "latest", "per-building"), default="latest")
    r.add_argument("--start", default=None)
    r.add_argument("--end", default=None)
    r.add_argument("--query", default=None, help="whose results, e.g. monitor-anomalies (by default the query that wrote last)")
    r.add_argument("--run", default=None, help="which of its runs (by default the one that wrote last)")
    r.add_argument("--rows", type=int, default=10, help="how many of the latest anomalies")
    r.add_argument("--out", default=None, help="write the whole panel there as CSV instead of printing it")
    r.add_argument("--by", choices=("detected_at", "timestamp"), default="detected_at",
                   help="time column of the latest-anomalies panel (processing or event time)")
    r.set_defaults(fn=cmd_report)

    args = p.parse_args(argv)
    if args.cmd == "monitor" and not args.models:
        p.error("monitor needs --models")
    if args.cmd in ("monitor", "rules") and not (args.topic or args.replay or args.archive):
        p.error(f"{args.cmd} needs --topic, --replay or --archive")
    if args.cmd == "report" and not (args.results or args.jdbc_url):
        p.error("report needs --results or --jdbc-url")
    args.fn(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Queries stopped between two batches; models swapped while a query runs; CSV lines that don't fit."""

import threading

import pytest
from pyspark.sql import functions as F
from test_archive import archived

from meterstream.model import FROZEN, STRICT
from meterstream.session import scratch_path
from meterstream.sources import csv
from meterstream.sources.models import CurrentModel, current_version, promote, save_model
from meterstream.streaming.progress import Stopper, await_all, drain
from meterstream.streaming.queries import QuerySettings, rule_detector, scoring_query
from meterstream.streaming.sources import SourceConfig, envelope_stream


class Recorder:
    """Keeps the batches written, and calls ``then`` after the first."""

    def __init__(self, then=lambda: None):
        self.batches, self.rows, self.then = [], 0, then

    def write(self, df, batch):
        self.rows += df.count()
        self.batches.append(batch.batch_id)
        if len(self.batches) == 1:
            self.then()


@pytest.mark.parametrize("how", ["request", "marker"])
def test_no_batch_is_repeated_after_a_stop(spark, how):
    path, checkpoint, marker = archived(spark, range(60)), scratch_path(spark, "ckpt"), scratch_path(spark, "marker")

    def run(stopper, recorder, wait):
        src = SourceConfig(kind="archive", path=path, starting_offsets="earliest", max_offsets_per_trigger=10)
        settings = QuerySettings(name="stopped", checkpoint=checkpoint, drain=True, stopper=stopper)
        wait([scoring_query(envelope_stream(spark, src), rule_detector(-1.0, -1.0), [recorder], settings)])

    stopper = Stopper(spark, marker if how == "marker" else None)
    ask = stopper.request if how == "request" else lambda: spark.range(1).write.parquet(marker)
    first, second = Recorder(ask), Recorder()
    run(stopper, first, lambda q: await_all(q, stopper=stopper))
    assert first.batches == [0]
    run(None, second, drain)
    assert set(first.batches).isdisjoint(second.batches) and first.rows + second.rows == 60


def test_a_query_that_waits_for_data_is_stopped(spark):
    stopper, recorder = Stopper(), Recorder()
    src = SourceConfig(kind="archive", path=archived(spark, range(5)), starting_offsets="earliest")
    settings = QuerySettings(name="idle", checkpoint=scratch_path(spark, "ckpt"), trigger="1 second", stopper=stopper)
    q = scoring_query(envelope_stream(spark, src), rule_detector(-1.0, -1.0), [recorder], settings)
    q.processAllAvailable()
    threading.Timer(0.2, stopper.request).start()
    await_all([q], stopper=stopper)
    assert not q.isActive and recorder.rows == 5


def test_the_promoted_version_is_used(spark):
    root = scratch_path(spark, "models")
    with pytest.raises(FileNotFoundError):
        current_version(spark, root)
    a, b = (save_model(spark, root, m).rpartition("/")[2] for m in (FROZEN, STRICT))
    models = CurrentModel(spark, root)
    assert models.get() == (b, STRICT)  # the newest where none was promoted
    assert promote(spark, root, a) == 1 and models.get() == (a, FROZEN)
    assert promote(spark, root, f"{root}/{b}") == 2 and models.get() == (b, STRICT)
    assert promote(spark, root, a) == 3 and models.get() == (a, FROZEN)  # back again
    with pytest.raises(FileNotFoundError):
        promote(spark, root, "v0-missing")


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    head = "timestamp,building,floor,water,electricity,status,note\n"
    (tmp_path / "a.csv").write_text(head + "2024-01-01T00:00:00Z,A,1,2.0,3.5,normal,x\n2024,B,one,2.0,3.5,normal,y\n2024,C,1\n"
                                    "2024,D,1,2.0,3.5,normal,x,extra\n,,,,,,\n\"q,r\",E,2,,4,anomaly,\n")
    lines = csv.read_csv(spark, str(tmp_path))
    assert sorted((r.building or "", r.electricity) for r in csv.rows(lines).collect()) == [("", None), ("A", 3.5), ("E", 4.0)]
    assert dict(csv.rows(lines).dtypes)["floor"] == "int" and dict(csv.rows(lines).dtypes)["note"] == "string"
    assert sorted(r.raw for r in csv.rejects(lines).collect()) == ["2024,B,one,2.0,3.5,normal,y", "2024,C,1", "2024,D,1,2.0,3.5,normal,x,extra"]
    assert csv.rejects(lines).agg(F.min("reason")).first()[0] == "bad_csv"


def test_csv_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("building,floor\nA,1\n")
    with pytest.raises(ValueError, match="electricity"):
        csv.read_csv(spark, str(tmp_path))

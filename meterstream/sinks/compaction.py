"""Compaction of stored results.

Streams write a small folder for each date, query, run and micro-batch.
``compact`` merges those of finished batches into snapshot files, a folder for
each date with rows sorted by building and time, and keeps of a window's
revisions the newest only.  A manifest names the snapshot of each date and, for
each query and run, the first batch that is not in them.  It is written aside
and renamed, so readers see the old state or the new one, whole; every
manifest is complete in itself, and the newest counts.

Dates that got no new rows keep their snapshot.  The last batch of a run is
never merged: it may be written again after a failure, all before it can't.
``vacuum`` deletes what the newest manifest has made superfluous.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import result_schema
from ..session import delete_path

#: Revisions of these tables' rows replace each other: all of one key but the newest batch's are dropped.
REVISED = {"aggregations": ("building", "window_start", "query", "run")}
#: What snapshot rows are sorted by, so that row groups and pages can be left out.
SORTED = {"aggregations": ("building", "window_start"), "anomalies": ("building", "timestamp"), "late": ("building", "timestamp"),
          "rejects": ("reason",)}
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """Snapshot folders by date, and the first batch of each (query, run) that is not in them."""
    version: int = 0
    snapshots: dict[str, str] = field(default_factory=dict)
    merged: dict[str, int] = field(default_factory=dict)

    def pending(self) -> Column:
        """Whether a row of the batch folders is not in the snapshots."""
        done = F.lit(False)
        for name, first in self.merged.items():
            query, run = json.loads(name)
            done = done | ((F.col("query") == query) & (F.col("run") == run) & (F.col("batch_id") < first))
        return ~done


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    """The newest manifest of a table's folder; an empty one before the first compaction."""
    versions = [n for n in _names(spark, f"{table}/_manifest") if n.endswith(".json")]
    if not versions:
        return Manifest()
    fs, p = _fs(spark, f"{table}/_manifest/{versions[-1]}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def switch(spark: SparkSession, table: str, manifest: Manifest) -> None:
    """Makes a prepared manifest the newest one."""
    fs, aside = _fs(spark, f"{table}/_manifest/.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(json.dumps(manifest.__dict__).encode())
    finally:
        out.close()
    if not fs.rename(aside, _fs(spark, f"{table}/_manifest/{manifest.version:012d}.json")[1]):
        raise RuntimeError(f"manifest {manifest.version} of {table} is there already")


def _batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(table)


def _snapshot(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, table: str, schema: str, lo=None, hi=None) -> DataFrame:
    """All rows of a table: its snapshots and the batches that aren't in them.

    With ``lo`` and ``hi`` (dates as text) only the folders of those dates.
    """
    m = read_manifest(spark, table)
    within = F.lit(True)
    if lo is not None:
        within = within & (F.col("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        within = within & (F.col("date") <= F.lit(hi).cast("date"))
    paths = [p for d, p in m.snapshots.items() if (lo is None and hi is None) or (
        d != NO_DATE and (lo is None or d >= lo[:10]) and (hi is None or d <= hi[:10]))]
    rows = _batches(spark, table, schema).filter(m.pending())
    return (rows.unionByName(_snapshot(spark, paths, schema)) if paths else rows).filter(within)


def prepare(spark: SparkSession, table: str, name: str, relational: bool = False) -> Manifest | None:
    """Writes the snapshots of the dates with finished batches; returns the manifest to switch to, if there are any."""
    schema, old = result_schema(name, relational), read_manifest(spark, table)
    batches = _batches(spark, table, schema)
    # Answered from folder names; a row for each query and run.
    last = batches.filter(old.pending()).groupBy("query", "run").agg(F.max("batch_id").alias("last")).collect()
    merged = old.merged | {json.dumps([r.query, r.run]): r.last for r in last}
    new = Manifest(old.version + 1, dict(old.snapshots), merged)
    fresh = batches.filter(old.pending() & ~new.pending())
    dates = [NO_DATE if r.date is None else str(r.date) for r in fresh.select("date").distinct().collect()]
    if not dates:
        return None
    before = [old.snapshots[d] for d in dates if d in old.snapshots]
    rows = fresh.unionByName(_snapshot(spark, before, schema)) if before else fresh
    if name in REVISED:
        keys = REVISED[name]
        values = [c for c in rows.columns if c not in keys]
        newest = F.max_by(F.struct(*values), F.col("batch_id"))
        rows = rows.groupBy(*keys).agg(newest.alias("r")).select(*keys, "r.*").select(*rows.columns)
    folder = f"{table}/_snapshots/{new.version:012d}-{uuid.uuid4().hex[:8]}"
    order = SORTED[name]
    (rows.withColumn("of", F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)))
     .repartitionByRange("of", *order).sortWithinPartitions("of", *order)
     .write.partitionBy("of").option("parquet.bloom.filter.enabled#building", "true")
     .option("parquet.bloom.filter.expected.ndv#building", "10000").parquet(folder))
    new.snapshots.update({d: f"{folder}/of={d}" for d in dates})
    return new


def compact(spark: SparkSession, table: str, name: str, relational: bool = False) -> Manifest | None:
    """Merges the finished batches of a result table (``table`` is its folder); None where there are none.

    One compaction of a table runs at a time; streams may go on writing and
    readers reading.
    """
    new = prepare(spark, table, name, relational)
    if new is not None:
        switch(spark, table, new)
    return new


def vacuum(spark: SparkSession, table: str, older_than_s: float = 24 * 3600) -> int:
    """Deletes merged batch folders, snapshots and manifests that the newest manifest doesn't need; returns how many folders.

    Only what has been there for ``older_than_s``, so that readers of an older
    state can end.
    """
    m, limit, gone = read_manifest(spark, table), (time.time() - older_than_s) * 1000, 0
    merged = {(*json.loads(k),): v for k, v in m.merged.items()}
    fs, root = _fs(spark, table)

    def old(path) -> bool:
        return fs.getFileStatus(path).getModificationTime() <= limit

    for status in fs.globStatus(_fs(spark, f"{table}/date=*/query=*/run=*/batch_id=*")[1]) or []:
        path = status.getPath()
        value = lambda p: spark._jvm.java.net.URLDecoder.decode(p.getName().partition("=")[2], "UTF-8")
        query, run, batch = value(path.getParent().getParent()), value(path.getParent()), int(value(path))
        if batch < merged.get((query, run), 0) and old(path):
            fs.delete(path, True)
            gone += 1
            for up in (path.getParent(), path.getParent().getParent(), path.getParent().getParent().getParent()):
                if len(fs.listStatus(up)):
                    break
                fs.delete(up, False)  # an empty folder of a run, query or date
    needed = {p.rpartition("/")[0].rpartition("/")[2] + "/" + p.rpartition("/")[2] for p in m.snapshots.values()}
    for version in _names(spark, f"{table}/_snapshots"):
        for of in [n for n in _names(spark, f"{table}/_snapshots/{version}") if n.startswith("of=")]:
            path = f"{table}/_snapshots/{version}/{of}"
            if f"{version}/{of}" not in needed and old(_fs(spark, path)[1]):
                delete_path(spark, path)
                gone += 1
    for file in _names(spark, f"{table}/_manifest")[:-1]:
        if old(_fs(spark, f"{table}/_manifest/{file}")[1]):
            delete_path(spark, f"{table}/_manifest/{file}")
    return gone

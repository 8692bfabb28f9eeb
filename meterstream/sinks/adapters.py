"""Sink adapters.

One canonical result schema; adapters only cast and rename.  Every write
belongs to a ``Batch``: the query's name, the run (the id in the query's
checkpoint, so it outlives restarts) and the micro-batch.  A replay must not
lose or duplicate rows, and queries that share a table must not touch each
other's, so every adapter first clears what an earlier attempt of the same
batch wrote:

* files (parquet / JSON): the batch's folders under every date, then append;
* document store: replace-by-id on the record's place in the topic;
* JDBC: delete the batch's rows, then append, in that order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import from_utc_wall

ISO_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Columns that say which write a stored row came from; files are laid out by them.
LAYOUT = ("date", "query", "run", "batch_id")
#: Where a record stood in the topic.
PLACE = ("topic", "partition", "offset")


@dataclass(frozen=True)
class Batch:
    query: str
    run: str
    batch_id: int


def with_batch(df: DataFrame, batch: Batch) -> DataFrame:
    return (df.withColumn("query", F.lit(batch.query)).withColumn("run", F.lit(batch.run))
            .withColumn("batch_id", F.lit(int(batch.batch_id)).cast("long")))


def event_date(df: DataFrame) -> Column:
    """Date a row is stored under: its window's or its event time's; null for rows without one."""
    for c in ("window_start", "timestamp"):
        if c in df.columns:
            return F.to_date(c)
    return F.lit(None).cast("date")


def _clear_batch(spark, path: str, batch: Batch) -> None:
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(
        f"{path}/date=*/query={batch.query}/run={batch.run}/batch_id={int(batch.batch_id)}")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for st in fs.globStatus(pattern) or []:
        fs.delete(st.getPath(), True)


#: The last batch that this process began to write, by folder, query and run.
_begun: dict[tuple[str, str, str], int] = {}


def _may_be_there(path: str, batch: Batch) -> bool:
    """Whether an earlier attempt can have written the batch: not if this process has begun the one before, and not this one."""
    key = (path, batch.query, batch.run)
    before, _begun[key] = _begun.get(key), int(batch.batch_id)
    return before is None or int(batch.batch_id) <= before


def _replace_batch(df: DataFrame, date: Column, fmt: str, path: str, batch: Batch) -> None:
    if _may_be_there(path, batch):
        _clear_batch(df.sparkSession, path, batch)
    (with_batch(df, batch).withColumn("date", date)
     .write.format(fmt).mode("append").partitionBy(*LAYOUT).save(path))


class ParquetSink:
    """Columnar result table laid out by date, query, run and batch (the default store)."""

    def __init__(self, path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.transform = path.rstrip("/"), transform

    def write(self, df: DataFrame, batch: Batch) -> None:
        out = self.transform(df) if self.transform else df
        _replace_batch(out, event_date(out), "parquet", self.path, batch)


class DocumentSink:
    """Document collection (K2, K3): timestamps become ISO text.

    ``format="mongodb"`` writes through the document-store connector with
    replace-by-id on ``id_fields`` + query and run (and the batch, for rows
    that are revised batch by batch); any other format (``json``) writes files
    under ``path``.
    """

    def __init__(self, collection: str, time_cols: Sequence[str], id_fields: Sequence[str] = PLACE,
                 format: str = "json", path: str | None = None, options: dict | None = None):
        self.collection, self.time_cols, self.id_fields = collection, tuple(time_cols), tuple(id_fields)
        self.format, self.path, self.options = format, path, dict(options or {})

    def shape(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.date_format(F.col(c), ISO_NTZ).alias(c) if c in self.time_cols else F.col(c)
                           for c in df.columns])

    def write(self, df: DataFrame, batch: Batch) -> None:
        if self.format == "mongodb":
            (with_batch(self.shape(df), batch).write.format("mongodb").mode("append")
                .option("collection", self.collection)
                .option("operationType", "replace")
                .option("idFieldList", ",".join((*self.id_fields, "query", "run", "batch_id")))
                .options(**self.options).save())
        else:
            shaped = self.shape(df)
            _replace_batch(shaped, event_date(shaped), self.format, f"{self.path.rstrip('/')}/{self.collection}", batch)


class RelationalSink:
    """Relational table (K4, K5) with typed columns; ``projection`` shapes the row.

    With ``url`` it writes over JDBC after deleting the batch's rows (the
    tables are in ``sinks/tables.sql``); without, it writes a parquet table
    under ``path``, as replayable.
    """

    def __init__(self, table: str, projection: Callable[[DataFrame], DataFrame],
                 url: str | None = None, properties: dict | None = None, path: str | None = None):
        self.table, self.projection, self.url = table, projection, url
        self.properties, self.path = dict(properties or {}), path

    def _delete_batch(self, spark, batch: Batch) -> None:
        jvm = spark._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        conn = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            st = conn.prepareStatement(f"DELETE FROM {self.table} WHERE query = ? AND run = ? AND batch_id = ?")
            st.setString(1, batch.query)
            st.setString(2, batch.run)
            st.setLong(3, int(batch.batch_id))
            st.executeUpdate()
            st.close()
        finally:
            conn.close()

    def write(self, df: DataFrame, batch: Batch) -> None:
        out = self.projection(df)
        if self.url:
            self._delete_batch(df.sparkSession, batch)
            with_batch(out, batch).write.jdbc(self.url, self.table, mode="append", properties=self.properties)
        else:
            _replace_batch(out, event_date(out), "parquet", f"{self.path.rstrip('/')}/{self.table}", batch)


class ConsoleSink:
    """Debug output (K1)."""

    def __init__(self, rows: int = 20):
        self.rows = rows

    def write(self, df: DataFrame, batch: Batch) -> None:
        print(f"-- {batch.query}, batch {batch.batch_id}")
        df.show(self.rows, truncate=False)


class KafkaSink:
    """Keyed topic publish (K8): key = building bytes, value = JSON bytes."""

    def __init__(self, bootstrap_servers: str, topic: str, options: dict | None = None):
        self.bootstrap, self.topic, self.options = bootstrap_servers, topic, dict(options or {})

    def write(self, df: DataFrame, batch: Batch | None = None) -> None:
        (df.select("key", "value").write.format("kafka")
           .option("kafka.bootstrap.servers", self.bootstrap).option("topic", self.topic)
           .options(**self.options).save())


def instant(df: DataFrame, col: str):
    """A typed timestamp column: UTC wall time (timestamp_ntz) becomes its instant."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        return from_utc_wall(col).alias(col)
    return F.col(col).cast("timestamp").alias(col)


AGG_TIME_COLS = ("window_start", "window_end", "processed_at")


def aggregate_row(df: DataFrame) -> DataFrame:
    """Relational projection of aggregates (P16): building, the metrics present, typed times."""
    metrics = [c for c in df.columns if c not in ("building", *LAYOUT, *AGG_TIME_COLS)]
    return df.select("building", *metrics, *[instant(df, c) for c in AGG_TIME_COLS])


def anomaly_row(df: DataFrame) -> DataFrame:
    """Relational projection of anomalies (P17): ``dist`` is stored as ``distance``.

    Model anomalies carry cluster and distance, all carry status, flag and
    their place in the topic where they have them.
    """
    extra = [c for c in ("status", "is_anomaly", "cluster", "model_version") if c in df.columns]
    if "dist" in df.columns:
        extra.append(F.col("dist").alias("distance"))
    return df.select("building", "floor", "electricity", "water", *extra, *[c for c in PLACE if c in df.columns],
                     instant(df, "timestamp"), instant(df, "detected_at"))

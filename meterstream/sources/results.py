"""Scans of stored results for report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import result_schema
from ..sinks.compaction import read_table


def read_results(spark: SparkSession, table: str, path: str | None = None, url: str | None = None,
                 properties: dict | None = None, partitions: int = 16, relational: bool = False,
                 lo: str | None = None, hi: str | None = None) -> DataFrame:
    """A result table from the parquet store (``path``) or over JDBC (``url``).

    Parquet tables have a declared schema, so a table without rows (or not yet
    written) reads as empty.  They are laid out by ``date``; with ``lo`` and
    ``hi`` only the folders of those dates are read, and compacted tables
    (``sinks/compaction.py``) from their snapshots.  A JDBC table is read in
    ``partitions`` ranges of its batch ids.
    """
    if url:
        props = dict(properties or {})
        ends = spark.read.jdbc(url, f"(SELECT min(batch_id) AS lo, max(batch_id) AS hi FROM {table}) ends",
                               properties=props).first()
        if ends[0] is None:
            return spark.read.jdbc(url, table, properties=props)
        return spark.read.jdbc(url, table, column="batch_id", lowerBound=int(ends[0]), upperBound=int(ends[1]) + 1,
                               numPartitions=partitions, properties=props)
    schema, where = result_schema(table, relational), f"{path.rstrip('/')}/{table}"
    root = spark._jvm.org.apache.hadoop.fs.Path(where)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    return read_table(spark, where, schema, lo, hi)

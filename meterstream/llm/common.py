"""Helpers shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts lineage, and survives lost executors.  The folder goes when the
    application ends (later reads of the result still need it).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    forget_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def forget_at_end(spark: SparkSession, path: str) -> None:
    """Has a scratch folder deleted when the application ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (names compare as Spark's do)."""
    low = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in low])


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where a lambda repeats it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")

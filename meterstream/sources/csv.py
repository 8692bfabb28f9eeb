"""Training readings from CSV files (S3), bad lines set aside as records of the topic path are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TRAINING_SCHEMA

BAD_CSV, CORRUPT = "bad_csv", "_corrupt_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TRAINING_SCHEMA) -> DataFrame:
    """Lines of CSV files with a header, and ``_corrupt_line``: the whole line where it doesn't fit, else null.

    The header says which column is which, in any order; columns that aren't
    in ``schema`` are text, missing ones an error.  Types are declared, not
    inferred.  A line doesn't fit if a value has another type or the number of
    values is another.  Files whose header differs from the first one's stop the read.
    """
    types = {f.name: f.dataType for f in schema}
    names = spark.read.option("header", True).csv(path).columns  # reads a header only
    if missing := set(types) - set(names):
        raise ValueError(f"{path} has no columns {sorted(missing)}")
    if CORRUPT in names:
        raise ValueError(f"{path} has a column {CORRUPT}")
    declared = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names] + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(declared).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def rows(lines: DataFrame) -> DataFrame:
    """The lines that fit, without the mark."""
    return lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejects(lines: DataFrame) -> DataFrame:
    """``raw, reason`` of the lines that don't."""
    # Spark reads no CSV for the mark alone; the other columns are asked for by a condition that always holds.
    parsed = F.length(F.concat_ws(",", *[F.col(c) for c in lines.columns if c != CORRUPT])) >= 0
    return lines.filter(F.col(CORRUPT).isNotNull() & parsed).select(F.col(CORRUPT).alias("raw"), F.lit(BAD_CSV).alias("reason"))

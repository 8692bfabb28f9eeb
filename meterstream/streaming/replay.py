"""Stage topic records from tables as files for a replayed stream.

The file source reads files in the order in which they were written, and one
job writes them all, so records come in no particular order.  A run that needs
them in time order reads an archive (``streaming/archive.py``) instead.  The
caller says how many records a file holds, and so how many micro-batches there
are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Records of one staged file unless told otherwise.
RECORDS_PER_FILE = 4_000


def stage_replay(envelope: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    envelope.write.mode("append").option("maxRecordsPerFile", records_per_file).parquet(path)

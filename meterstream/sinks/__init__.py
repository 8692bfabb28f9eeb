"""Batch writers used inside ``foreachBatch``; every one is replayable batch by batch."""

from .adapters import (Batch, ConsoleSink, DocumentSink, KafkaSink, ParquetSink, RelationalSink,
                       aggregate_row, anomaly_row)

__all__ = ["Batch", "ConsoleSink", "DocumentSink", "KafkaSink", "ParquetSink", "RelationalSink",
           "aggregate_row", "anomaly_row"]

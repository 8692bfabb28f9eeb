"""Progress listener (T12) and waiting on queries."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Reports each batch as it ends, and keeps running totals for each query.

    ``report`` gets one record per finished batch; nothing grows with the
    number of batches.
    """

    def __init__(self, report: Callable[[dict], None] | None = None):
        self.changed = threading.Condition()
        self.report = report
        self.totals: dict[str, dict] = {}
        self.started: set[str] = set()
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event):
        with self.changed:
            self.started.add(str(event.id))

    def onQueryProgress(self, event):
        p = event.progress
        seen = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}.get("records", {})
        record = {
            "id": str(p.id), "name": p.name, "batch_id": int(p.batchId), "input_rows": int(p.numInputRows),
            "parsed_rows": int(seen.get("rows") or 0), "rejected": int(seen.get("rejected") or 0),
            "rows_per_second": float(p.processedRowsPerSecond or 0.0),
            "watermark": (p.eventTime or {}).get("watermark"),
            # rows the watermark rejected as too late (Spark drops them; this counts them)
            "dropped_late": sum(int(op.numRowsDroppedByWatermark or 0) for op in (p.stateOperators or [])),
            "state_rows": sum(int(op.numRowsTotal or 0) for op in (p.stateOperators or [])),
        }
        with self.changed:
            t = self.totals.setdefault(p.name, {"batches": 0, "input_rows": 0, "parsed_rows": 0, "rejected": 0, "dropped_late": 0})
            t["batches"] += 1
            for k in ("input_rows", "parsed_rows", "rejected", "dropped_late"):
                t[k] += record[k]
        if self.report:
            self.report(record)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.changed:
            self.ended[str(event.id)] = event.exception
            self.changed.notify_all()

    def drain(self, queries: list[StreamingQuery], timeout_s: float = 120.0) -> None:
        """Waits for the end of the queries to be reported; their batches come before it."""
        ids = {str(q.id) for q in queries}
        with self.changed:
            if not self.changed.wait_for(lambda: ids <= set(self.ended), timeout_s):
                raise TimeoutError(f"no end of {sorted(ids - set(self.ended))} was reported in {timeout_s} s")


def drain(queries: list[StreamingQuery]) -> None:
    """Runs queries without an end until they have processed what is there, then stops them; a failure stops all and is raised."""
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if (failure := q.exception()) is not None:
            raise failure


class Stopper:
    """Ends queries between two batches, so that none is run twice.

    Asked for by ``request``, by a marker (a path that comes to exist) or by
    SIGTERM.  The batch that runs then ends and is committed.  Batches pass
    ``gate`` before they do anything: one that begins later ends its query
    there, and runs whole after the next start.
    """

    def __init__(self, spark=None, marker: str | None = None):
        self.spark, self.marker = spark, marker
        self.asked, self.held = threading.Event(), set()

    def request(self) -> None:
        self.asked.set()

    def on_sigterm(self) -> None:
        if threading.current_thread() is threading.main_thread():
            signal.signal(signal.SIGTERM, lambda *_: self.request())

    def requested(self) -> bool:
        if not self.asked.is_set() and self.marker is not None:
            from ..session import path_exists
            if path_exists(self.spark, self.marker):
                self.asked.set()
        return self.asked.is_set()

    def gate(self, query: str) -> None:
        if self.requested():
            self.held.add(query)
            raise RuntimeError(f"{query} was stopped before its batch began")

    def stop(self, queries: list[StreamingQuery], poll_s: float = 0.1) -> None:
        """Stops each query once it waits for its trigger or for data, or has ended at the gate."""
        for q in queries:
            while q.isActive and q.status["isTriggerActive"]:
                time.sleep(poll_s)
            if q.isActive:
                q.stop()
            elif (failure := q.exception()) is not None and q.name not in self.held:
                raise failure


def await_all(queries: list[StreamingQuery], poll_s: float = 0.5, stopper: Stopper | None = None) -> None:
    """Waits until every query has ended; the first that fails stops the others and is raised."""
    try:
        while active := [q for q in queries if q.isActive]:
            if stopper is not None and stopper.requested():
                stopper.stop(queries)
                return
            for q in queries:
                if (failure := q.exception()) is not None and (stopper is None or q.name not in stopper.held):
                    raise failure
            try:
                active[0].awaitTermination(poll_s)
            except StreamingQueryException:
                if stopper is None or active[0].name not in stopper.held:
                    raise
        for q in queries:
            if (failure := q.exception()) is not None and (stopper is None or q.name not in stopper.held):
                raise failure
    except BaseException:
        for q in queries:
            if q.isActive:
                q.stop()
        raise

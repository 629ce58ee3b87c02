"""Start, stop and look at running stream queries by name."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import utc_now
from ..sources.state import ControlTable

PROGRESS = "progress:"


def running(spark: SparkSession, name: str) -> StreamingQuery | None:
    return next((q for q in spark.streams.active if q.name == name), None)


def start(spark: SparkSession, name: str, launch: Callable[[], StreamingQuery]) -> dict:
    """Start the query unless one of that name runs already."""
    if running(spark, name):
        return {"status": "already_running", "name": name}
    launch()
    return {"status": "started", "name": name}


def stop(spark: SparkSession, name: str, timeout: int = 2) -> dict:
    """Stop the query, waiting up to ``timeout`` seconds for its batch to end."""
    query = running(spark, name)
    if query is None:
        return {"status": "already_stopped", "name": name}
    query.stop()
    query.awaitTermination(timeout)
    return {"status": "stopped", "name": name}


class KeepProgress(StreamingQueryListener):
    """Keeps the last progress of every named query in the control table, also after the query has ended.

    Add it once to a session, by ``spark.streams.addListener``. A value replaces the one before, so the
    table does not grow with the batches.
    """

    def __init__(self, control: ControlTable):
        self.control = control
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name is None:
            return
        run = str(progress.runId)
        total = self.totals[run] = self.totals.get(run, 0) + progress.numInputRows
        self._put(progress.name, {
            "query_id": str(progress.id), "batch_id": progress.batchId, "input_rows": progress.numInputRows, "run_rows": total,
            "rows_per_second": progress.processedRowsPerSecond, "seconds": progress.batchDuration / 1000,
            "offsets": [{"source": s.description, "start": s.startOffset, "end": s.endOffset} for s in progress.sources],
            "timestamp": progress.timestamp, "error": None,
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.totals.pop(str(event.runId), None)

    def _put(self, name: str, progress: dict) -> None:
        self.control.replace(f"{PROGRESS}{name}", json.dumps(progress))


def last_progress(control: ControlTable, name: str) -> dict | None:
    """What ``KeepProgress`` kept of a query: offsets, rows and rows per second of its last batch."""
    text = control.get(f"{PROGRESS}{name}")
    return json.loads(text) if text else None


def status(spark: SparkSession, name: str, control: ControlTable | None = None) -> dict:
    """Of a running query what it says; of an ended one, with ``control``, what was kept of it."""
    query = running(spark, name)
    progress = query.lastProgress if query else None
    kept = last_progress(control, name) if control else None
    if progress is None and kept:
        progress = {"batchId": kept["batch_id"], "numInputRows": kept["input_rows"]}
    return {
        "name": name,
        "running": query is not None and query.isActive,
        "message": query.status["message"] if query else None,
        "batch_id": progress["batchId"] if progress else None,
        "input_rows": progress["numInputRows"] if progress else None,
        "offsets": kept["offsets"] if kept else None,
        "rows_per_second": kept["rows_per_second"] if kept else None,
        "timestamp": utc_now().isoformat(),
    }

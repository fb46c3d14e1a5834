"""ST10/ST11: stream progress rows and a stalled-input alert.

A ``StreamingQueryListener`` turns each progress event into a flat row
(batch id, input rows, rates, watermark, rows dropped by the watermark) and
keeps the time of the last progress that had input.  The rows that parsing
dropped are counted by reason, from the metrics observed on the stream.  ``stalled`` reports a
query whose input stopped for longer than a limit.  The dropped-row metric
is Spark's own and is not an exact late-row count.
"""

from __future__ import annotations

import datetime as _dt
import threading
import time
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


#: Name of the metrics that the parse of a streaming query is observed by.
PARSE_METRICS = "parse"


def parse_drops(progress) -> dict[str, int]:
    """Rows read and rows dropped by reason of one progress event; empty if the query observes no parse."""
    found = (getattr(progress, "observedMetrics", None) or {}).get(PARSE_METRICS)
    return {k: int(v or 0) for k, v in found.asDict().items()} if found is not None else {}


def sum_drops(drops: Iterable[dict[str, int]]) -> dict[str, int]:
    total: dict[str, int] = {}
    for one in drops:
        for reason, n in one.items():
            total[reason] = total.get(reason, 0) + n
    return total


def _dropped(progress) -> int:
    total = 0
    for op in progress.stateOperators or []:
        total += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
    return total


class ProgressRecorder(StreamingQueryListener):
    def __init__(self, keep: int = 1_000):
        self._rows: list[dict] = []
        self._keep = keep
        self._lock = threading.Lock()
        self._last_input: dict[str, float] = {}
        self._started: dict[str, float] = {}
        self._totals: dict[str, list[int]] = {}  # query id -> [rows, batches] since the query started
        self._drops: dict[str, dict[str, int]] = {}  # query id -> rows dropped by reason since the query started
        self.idle_events = 0

    # -- listener callbacks
    def onQueryStarted(self, event):
        self._started[str(event.id)] = time.time()

    def onQueryProgress(self, event):
        p = event.progress
        row = {
            "query_id": str(p.id),
            "name": p.name,
            "batch_id": p.batchId,
            "timestamp": p.timestamp,
            "num_input_rows": int(p.numInputRows),
            "input_rows_per_second": float(p.inputRowsPerSecond or 0.0),
            "processed_rows_per_second": float(p.processedRowsPerSecond or 0.0),
            "watermark": (p.eventTime or {}).get("watermark"),
            "rows_dropped_by_watermark": _dropped(p),
        }
        with self._lock:
            self._rows.append(row)
            del self._rows[: max(0, len(self._rows) - self._keep)]
            total = self._totals.setdefault(row["query_id"], [0, 0])
            total[0] += row["num_input_rows"]
            total[1] += 1
            self._drops[row["query_id"]] = sum_drops([self._drops.get(row["query_id"], {}), parse_drops(p)])
            if row["num_input_rows"] > 0:
                self._last_input[row["query_id"]] = time.time()

    def onQueryIdle(self, event):
        self.idle_events += 1

    def onQueryTerminated(self, event):
        pass

    # -- read side
    def rows(self) -> list[dict]:
        with self._lock:
            return list(self._rows)

    def totals(self, query_id: str) -> tuple[int, int]:
        """(input rows, batches) of a query over its whole life, not only the kept progress rows."""
        with self._lock:
            rows, batches = self._totals.get(query_id, (0, 0))
        return rows, batches

    def drops(self, query_id: str) -> dict[str, int]:
        """Rows read and rows dropped by reason over the query's whole life."""
        with self._lock:
            return dict(self._drops.get(query_id, {}))

    def progress_frame(self, spark: SparkSession):
        """The newest kept progress rows (``keep``); ``totals`` covers all."""
        rows = self.rows()
        schema = (
            "query_id string, name string, batch_id long, timestamp string, num_input_rows long, "
            "input_rows_per_second double, processed_rows_per_second double, watermark string, "
            "rows_dropped_by_watermark long"
        )
        return spark.createDataFrame(rows, schema)

    def stalled(self, query_id: str, limit_seconds: float, now: float | None = None) -> bool:
        """True when the query has had no input for more than ``limit_seconds``
        (counted from its start if it never had any)."""
        now = time.time() if now is None else now
        last = self._last_input.get(query_id, self._started.get(query_id))
        return last is not None and (now - last) > limit_seconds


def attach(spark: SparkSession, recorder: ProgressRecorder | None = None) -> ProgressRecorder:
    recorder = recorder or ProgressRecorder()
    spark.streams.addListener(recorder)
    return recorder


def detach(spark: SparkSession, recorder: ProgressRecorder) -> None:
    spark.streams.removeListener(recorder)


def heartbeat(recorder: ProgressRecorder, query_id: str) -> str:
    """One log line like the feed client's heartbeat: totals, rate, and rows dropped by reason if there are any."""
    rows = [r for r in recorder.rows() if r["query_id"] == query_id]
    total, batches = recorder.totals(query_id)
    rate = rows[-1]["input_rows_per_second"] if rows else 0.0
    stamp = _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
    drops = "".join(f" {reason}={n}" for reason, n in recorder.drops(query_id).items() if n and reason != "rows")
    return f"{stamp} heartbeat rows={total} rate={rate:.1f}/s{drops} batches={batches}"

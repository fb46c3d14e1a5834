"""ST10: totals cover every batch, however few progress rows are kept."""

from types import SimpleNamespace

from tidemark.streaming.monitor import ProgressRecorder, heartbeat


def _event(batch_id):
    progress = SimpleNamespace(id="q", name="n", batchId=batch_id, timestamp="t", numInputRows=10, inputRowsPerSecond=5.0,
                               processedRowsPerSecond=5.0, eventTime={}, stateOperators=[])
    return SimpleNamespace(progress=progress)


def test_many_batches_report_every_row():
    recorder = ProgressRecorder()
    for batch_id in range(1_500):
        recorder.onQueryProgress(_event(batch_id))
    assert recorder.totals("q") == (15_000, 1_500) and len(recorder.rows()) == 1_000
    assert "rows=15000 " in heartbeat(recorder, "q") and heartbeat(recorder, "q").endswith("batches=1500")
    assert recorder.totals("other") == (0, 0)

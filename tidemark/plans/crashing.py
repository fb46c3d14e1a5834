"""A delivery that fails on purpose, once after a batch became visible and once before."""

from __future__ import annotations

from ..sinks.delivered import DeliveredSink, DeliveredWriter
from ..sources.shared import get, put

CRASH = "delivery was told to fail"


class CrashingWriter(DeliveredWriter):
    """Options ``after`` and ``before``: batches whose commit fails then, once each; ``marks``: folder that remembers it."""

    def __init__(self, options):
        super().__init__(options)
        self.batches = {when: int(options[when]) for when in ("after", "before")}
        self.marks = options["marks"]

    def _fail_once(self, when: str, batch_id: int) -> None:
        mark = f"{self.marks}/{when}"
        if self.batches[when] == batch_id and get(mark) is None:
            put(mark, b"failed")
            raise RuntimeError(CRASH)

    def commit(self, messages, batchId):
        self._fail_once("before", batchId)
        super().commit(messages, batchId)
        self._fail_once("after", batchId)


class CrashingSink(DeliveredSink):
    @classmethod
    def name(cls) -> str:
        return "crashing_delivery"

    def streamWriter(self, schema, overwrite):
        return CrashingWriter(self.options)

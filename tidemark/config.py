"""Pipeline parameters (one frozen dataclass, overridable from the environment).

The defaults are the streaming job's published defaults: 30 s trigger, 2 min
watermark, 1 min tumbling window, burst threshold 200, 50,000 input rows per
trigger, UTC session zone.  The shuffle width is the cluster's unless set.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace


def _env(name: str, default: str) -> str:
    value = os.environ.get(name)
    return default if value is None or value.strip() == "" else value.strip()


@dataclass(frozen=True)
class PipelineConfig:
    # source
    kafka_bootstrap: str = "kafka-server:9092"
    kafka_topic: str = "wiki.event.raw"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 50_000
    fetch_offset_num_retries: int = 5
    fetch_offset_retry_interval_ms: int = 1_000
    kafka_session_timeout_ms: int = 60_000
    kafka_request_timeout_ms: int = 70_000
    kafka_max_poll_records: int = 1_000
    fail_on_data_loss: bool = False

    # event time and rollups
    trigger: str = "30 seconds"
    watermark: str = "2 minutes"
    window: str = "1 minute"
    burst_threshold: int = 200
    # Guard against one far-future event dragging the watermark forward (B6):
    # an interval such as "1 day"; events later than now + max_future are
    # dropped at parse time.  None disables it.  The bounded cast (years
    # 0001-9999) always applies.
    max_future: str | None = None
    # ST4: "previous" filters late rows by the previous batch's watermark
    # (this Spark version's default); "current" by the current one (stricter)
    late_policy: str = "previous"

    # A message key that comes again within the watermark counts once.
    # Off by default: a retried message then counts as often as it is sent.
    drop_repeats: bool = False

    # storage
    warehouse_path: str | None = None
    checkpoint_path: str | None = None
    lookup_path: str | None = None
    max_files_per_trigger: int | None = None  # back-pressure of the file source
    write_partitions: int | None = None  # None = rebalance by (ds, hr); n = coalesce(n)
    # catalog tables over the warehouse (S6); when set, every batch registers
    # the partitions it wrote, so readers prune through the catalog
    totals_table: str | None = None
    actions_table: str | None = None

    # Statistics of every batch's hours beside its table (sketch of keys, time bounds):
    # row estimates and newest rows then need no scan of the history
    partition_stats: bool = False

    # K5 per batch: "report" lists rows that break the keyed-table contract
    # beside the warehouse (which keeps them), "fail" stops the batch, "off"
    # skips the check.  Delivery rejects such rows in any mode.
    contract_mode: str = "report"

    # lookup dimension
    lookup_broadcast_max_rows: int = 1_000_000

    # session
    # None leaves the cluster's setting; a number is fixed into a stateful
    # checkpoint at first start
    shuffle_partitions: int | None = None
    session_time_zone: str = "UTC"
    # "rocksdb" keeps streaming state off the JVM heap (large key counts)
    state_store: str | None = None

    # column sizes of the keyed tables (checked and clipped on delivery only)
    max_wiki_len: int = 256
    max_event_type_len: int = 64
    max_label_len: int = 512
    max_language_len: int = 32

    # read side
    lookback_minutes: int = 10_080
    latest_rows: int = 2_000
    stale_minutes: float = 15.0

    kafka_producer_options: dict = field(
        default_factory=lambda: {
            "kafka.acks": "all",
            "kafka.retries": "10",
            "kafka.linger.ms": "20",
            "kafka.batch.size": "32768",
            "kafka.compression.type": "snappy",
            "kafka.request.timeout.ms": "30000",
            "kafka.delivery.timeout.ms": "120000",
            "kafka.enable.idempotence": "true",
            "kafka.max.in.flight.requests.per.connection": "1",
        }
    )

    def with_(self, **changes) -> "PipelineConfig":
        return replace(self, **changes)

    @classmethod
    def from_env(cls) -> "PipelineConfig":
        base = cls()
        return replace(
            base,
            kafka_bootstrap=_env("KAFKA_BOOTSTRAP_SERVERS", base.kafka_bootstrap),
            kafka_topic=_env("KAFKA_TOPIC", base.kafka_topic),
            starting_offsets=_env("KAFKA_STARTING_OFFSETS", base.starting_offsets),
            max_offsets_per_trigger=int(_env("KAFKA_MAX_OFFSETS_PER_TRIGGER", str(base.max_offsets_per_trigger))),
            fetch_offset_num_retries=int(_env("KAFKA_FETCH_OFFSET_NUM_RETRIES", str(base.fetch_offset_num_retries))),
            fetch_offset_retry_interval_ms=int(
                _env("KAFKA_FETCH_OFFSET_RETRY_INTERVAL_MS", str(base.fetch_offset_retry_interval_ms))
            ),
            kafka_session_timeout_ms=int(_env("KAFKA_SESSION_TIMEOUT_MS", str(base.kafka_session_timeout_ms))),
            kafka_request_timeout_ms=int(_env("KAFKA_REQUEST_TIMEOUT_MS", str(base.kafka_request_timeout_ms))),
            kafka_max_poll_records=int(_env("KAFKA_MAX_POLL_RECORDS", str(base.kafka_max_poll_records))),
            trigger=_env("TIDEMARK_TRIGGER", base.trigger),
            watermark=_env("TIDEMARK_WATERMARK", base.watermark),
            window=_env("TIDEMARK_WINDOW", base.window),
            burst_threshold=int(_env("TIDEMARK_BURST_THRESHOLD", str(base.burst_threshold))),
            drop_repeats=_env("TIDEMARK_DROP_REPEATS", "").lower() in ("1", "true", "yes"),
            warehouse_path=os.environ.get("TIDEMARK_WAREHOUSE") or base.warehouse_path,
            checkpoint_path=os.environ.get("TIDEMARK_CHECKPOINT") or base.checkpoint_path,
            lookup_path=os.environ.get("TIDEMARK_LOOKUP_CSV") or base.lookup_path,
            max_files_per_trigger=int(os.environ.get("TIDEMARK_MAX_FILES_PER_TRIGGER") or 0) or None,
            totals_table=os.environ.get("TIDEMARK_TOTALS_TABLE") or base.totals_table,
            actions_table=os.environ.get("TIDEMARK_ACTIONS_TABLE") or base.actions_table,
            partition_stats=_env("TIDEMARK_PARTITION_STATS", "").lower() in ("1", "true", "yes"),
            shuffle_partitions=int(os.environ.get("SPARK_SQL_SHUFFLE_PARTITIONS") or 0) or base.shuffle_partitions,
            state_store=os.environ.get("TIDEMARK_STATE_STORE") or base.state_store,
            lookback_minutes=int(_env("TIDEMARK_LOOKBACK_MINUTES", str(base.lookback_minutes))),
            stale_minutes=float(_env("TIDEMARK_STALE_MINUTES", str(base.stale_minutes))),
        )


DEFAULT = PipelineConfig()

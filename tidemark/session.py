"""Session settings and the shared scratch location.

Intermediate tables and streaming checkpoints live under the folder the cluster
names in ``spark.checkpoint.dir`` (a shared, fault-tolerant filesystem on a
real cluster).  Only when that setting is absent -- local tests -- do we pick a
temporary folder ourselves and register it as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .config import DEFAULT, PipelineConfig


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    config: PipelineConfig = DEFAULT,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": config.session_time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.metricsEnabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if config.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(config.shuffle_partitions)
    if config.state_store == "rocksdb":
        settings["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def job_settings(config: PipelineConfig = DEFAULT) -> dict[str, str]:
    """Settings the streaming job relies on: event time is UTC end to end, and sink retries
    replace only their own partitions (writers also ask for that themselves)."""
    return {
        "spark.sql.session.timeZone": config.session_time_zone,
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def utc_session(spark: SparkSession, config: PipelineConfig = DEFAULT) -> SparkSession:
    """``spark`` itself when its zone is the job's, else a sibling session in that zone.

    Windows and partition texts need the zone; the caller's session stays as it is.
    """
    if spark.conf.get("spark.sql.session.timeZone") == config.session_time_zone:
        return spark
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", config.session_time_zone)
    return sibling


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_value = sc.getConf().get("spark.checkpoint.dir")
        if conf_value:
            sc.setCheckpointDir(conf_value)
            return sc.getCheckpointDir() or conf_value
    try:
        value = spark.conf.get("spark.checkpoint.dir")
    except Exception:
        value = None
    return value or None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; sets a local one only when
    it is unset (tests, single-machine runs).
    """
    current = _configured_checkpoint_dir(spark)
    if current:
        return current.rstrip("/")
    master = spark.conf.get("spark.master", "local") or "local"
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared, fault-tolerant folder "
            "(checkpoints and intermediate tables go there)"
        )
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
        return (spark.sparkContext.getCheckpointDir() or local).rstrip("/")
    except Exception:
        spark.conf.set("spark.checkpoint.dir", local)
        return local


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint root."""
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), "tidemark", *tail])

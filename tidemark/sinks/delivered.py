"""K6 / K7: a streaming sink with a commit protocol; files stand in for the store that takes delivery.

Tasks write files that nobody reads yet and hand their names back.  The driver's commit writes one
manifest per run and batch, whole or not at all: with it the batch is visible, all of it and once.
A batch that the engine repeats, since it failed after the manifest and before its own log, finds
the manifest and takes its new files back; one that failed before left no manifest and is
delivered by the repetition.  Files of lost attempts are in no manifest and are never read.

Batch ids start again with a new checkpoint, so ``run_id`` names the checkpoint's life.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.shared import get, put, shared_fs

FORMAT = "delivered_files"
MANIFEST = "run_id string, batch_id long, file string, rows long"


@dataclass
class Written(WriterCommitMessage):
    """A task's file and its rows; no file for no rows."""

    file: str | None
    rows: int


class DeliveredWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.run_id = options["path"].rstrip("/"), options["run_id"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = shared_fs(f"{self.path}/data")
        name, rows, out, writer = f"{uuid.uuid4().hex}.parquet", 0, None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    system.create_dir(root)
                    out = system.open_output_stream(f"{root}/{name}")
                    writer = pq.ParquetWriter(out, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return Written(name if rows else None, rows)

    def manifest(self, batch_id: int) -> str:
        return f"{self.path}/commits/{self.run_id}-{batch_id:020d}.json"

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        if get(self.manifest(batchId)) is not None:  # visible already
            self.abort(messages, batchId)
            return
        names = [{"run_id": self.run_id, "batch_id": batchId, "file": m.file, "rows": m.rows} for m in messages if m and m.file]
        put(self.manifest(batchId), "".join(json.dumps(n) + "\n" for n in names).encode())

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        system, root = shared_fs(f"{self.path}/data")
        named = {json.loads(line)["file"] for line in (get(self.manifest(batchId)) or b"").splitlines()}
        for m in messages:
            if m and m.file and m.file not in named:
                system.delete_file(f"{root}/{m.file}")


class DeliveredSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> DeliveredWriter:
        return DeliveredWriter(self.options)


def deliver_stream(
    rows: DataFrame, path: str, checkpoint: str, run_id: str, sink: type[DataSource] = DeliveredSink, available_now: bool = False, **options: object
) -> StreamingQuery:
    """Start delivering a stream of ``rows`` into ``path``."""
    rows.sparkSession.dataSource.register(sink)
    writer = rows.writeStream.format(sink.name()).option("checkpointLocation", checkpoint)
    for name, value in {"path": path, "run_id": run_id, **options}.items():
        writer = writer.option(name, str(value))
    trigger = {"availableNow": True} if available_now else {"processingTime": "0 seconds"}
    return writer.trigger(**trigger).start()


def delivered(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of all committed batches, with ``run_id`` and ``batch_id``; nothing delivered yet gives no rows."""
    system, root = shared_fs(path)
    if any(system.get_file_info(f"{root}/{folder}").type != fs.FileType.Directory for folder in ("data", "commits")):
        return spark.createDataFrame([], schema).select("*", F.lit("").alias("run_id"), F.lit(0).cast("long").alias("batch_id"))
    names = spark.read.schema(MANIFEST).json(f"{path}/commits").select("run_id", "batch_id", "file")
    files = spark.read.schema(schema).parquet(f"{path}/data").select("*", F.col("_metadata.file_name").alias("file"))
    return files.join(names, "file").drop("file")

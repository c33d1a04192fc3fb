"""Incremental landing -> bronze with Structured Streaming.

The reference syncs its source into landing continuously and loads bronze
in daily batches. This is the same bronze append (stamp + write) run
incrementally: new landing files are picked up by a file stream, each
micro-batch becomes one stamped bronze batch, and the stream checkpoint in
the shared folder makes restarts resume where they stopped.

Each micro-batch is one part of the stream's batch, in the layout of the daily
load, and is written in overwrite mode: replayed after a failure, it replaces
its own output (idempotent sink). Raw bronze keeps every record, late and
re-sent ones too; silver keeps the latest record of a key.
"""

from __future__ import annotations

from datetime import datetime, timezone
from os import path as paths

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from callstar.session import checkpoint_root
from callstar.sources.ingest import append_batch, stamp


def _writer(bronze_path: str, origin: str, batch_ts: str):
    def write(batch: DataFrame, micro_batch: int) -> None:
        append_batch(stamp(batch, batch_ts, origin), bronze_path, batch_ts, part=micro_batch + 1)
    return write


def stream_to_bronze(spark: SparkSession, source_dir: str, schema: StructType, bronze_path: str,
                     name: str, batch_ts: str | None = None, once: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing -> bronze stream for one table.

    ``batch_ts`` is the batch the records join (by default today's, at
    midnight), so the daily load of that batch reads them. ``once=True``
    processes everything available and stops (scheduled runs); ``once=False``
    keeps polling. The checkpoint lives under ``spark.checkpoint.dir`` so any
    driver can resume the stream.
    """
    batch_ts = batch_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d 00:00:00")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ckpt = paths.join(checkpoint_root(spark), "streams", f"bronze_{name}")
    w = (reader.parquet(source_dir).writeStream.foreachBatch(_writer(bronze_path, f"landing.{name}", batch_ts))
            .option("checkpointLocation", ckpt).queryName(f"bronze_{name}"))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()

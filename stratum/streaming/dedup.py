"""Repeated deliveries on a stream: each record once, with bounded state.

A keyed state store remembers the keys seen; an event-time watermark bounds how long.  A
copy that arrives while its key is remembered adds nothing.  Rows later than the
watermark are left out and counted (their key may have been forgotten, so they cannot be
told from copies).  Rows without an event time cannot be placed: they pass as they are.

State lives in the checkpoint: restarts remember it, and a lost executor restores it.  On
a cluster use the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``), which
keeps state beyond the executor's heap.  Where a key must be unique for ever, merge the
batches into a key-bucketed table instead (``batches.scd1_sink``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_TIME = "__event_time"


@dataclass
class DedupRun:
    """Counts of one run, summed over its micro-batches."""

    rows_in: int = 0
    duplicates: int = 0
    late: int = 0


def dedup_deliveries(stream: DataFrame, keys: Sequence[str], event_time: str | Column, delay: str) -> DataFrame:
    """Each key's first row within ``delay`` of event time; all columns of ``stream``.

    Null keys are keys.  A row without an event time passes, whatever its key.
    """
    t = (F.col(event_time) if isinstance(event_time, str) else event_time).cast("timestamp")
    placed = stream.withColumn(EVENT_TIME, t)
    timed = placed.filter(F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME).unionByName(
        placed.filter(F.col(EVENT_TIME).isNull()).drop(EVENT_TIME))


def run_deduplicated(stream: DataFrame, checkpoint: str, sink_path: str | None = None, fmt: str = "parquet",
                     foreach_batch: Callable[[DataFrame, int], None] | None = None) -> DedupRun:
    """Process what is available, then stop; count copies and late rows from the progress."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    w = w.foreachBatch(foreach_batch) if foreach_batch else w.format(fmt).option("path", sink_path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    out = DedupRun()
    for p in q.recentProgress:
        out.rows_in += int(p.get("numInputRows", 0))
        for op in p.get("stateOperators", []):
            out.late += int(op.get("numRowsDroppedByWatermark", 0))
            out.duplicates += int((op.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0))
    return out

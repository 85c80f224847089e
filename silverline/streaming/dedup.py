"""Streaming deduplication into a table.

State rules (Structured Streaming): with a watermark whose column is one of the
keys, dedup state is evicted once the watermark passes; with the event-time
column outside the keys, ``mode="exact"`` never evicts, ``mode="within_watermark"``
does. Late rows are dropped in all watermark forms; the late filter lags one
micro-batch behind the batch that moved the watermark. :class:`DedupFigures` counts them.

Survivors are appended batch by batch (:func:`silverline.sources.tables.append_batch`), so the table
can be deduplicated or merged in place between runs and is written in its own format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from silverline.operators.dedup import drop_duplicates
from silverline.sources.ingest import StreamId, _trigger
from silverline.sources.tables import adopt_table, append_batch, create_table


class DedupFigures(StreamingQueryListener):
    """Rows that deduplicating streams read, dropped as late and dropped as repeats, and keys in state, by query id.

    Add it with ``spark.streams.addListener`` before a stream starts. The figures come from the progress of
    every micro-batch, however many there are, a short time after the batch.
    """

    def __init__(self):
        self.by_query: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        # counts go on over restarts with the same checkpoint
        self.by_query.setdefault(str(event.id), {"read": 0, "late": 0, "repeated": 0, "in_state": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        figures = self.by_query.setdefault(str(p.id), {"read": 0, "late": 0, "repeated": 0, "in_state": 0})
        figures["read"] += max(0, p.numInputRows)
        for op in p.stateOperators:
            if op.operatorName.startswith("dedup"):
                figures["late"] += op.numRowsDroppedByWatermark
                figures["repeated"] += dict(op.customMetrics).get("numDroppedDuplicateRows", 0)
                figures["in_state"] = op.numRowsTotal

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dedup_stream(
    stream: DataFrame,
    keys: list[str],
    table: str,
    checkpoint_location: str,
    watermark_column: str | None = None,
    watermark_delay: str | None = None,
    mode: str = "exact",
    trigger_type: str = "availableNow",
    trigger_interval: str | None = None,
    select: list[str] | None = None,
) -> StreamingQuery:
    """Start a stream that drops duplicate rows of ``stream`` and appends the survivors to ``table``."""
    if not stream.isStreaming:
        raise ValueError("dedup_stream needs a streaming DataFrame; use drop_duplicates for batches")
    out = drop_duplicates(stream, keys, watermark_column, watermark_delay, mode)
    if select:
        out = out.select(*select)
    spark = stream.sparkSession
    # an external table under the shared scratch root, not a managed one in a local warehouse
    create_table(spark, table, out.schema)
    adopt_table(spark, table)
    stream_id = StreamId(checkpoint_location)

    def apply(batch: DataFrame, batch_id: int) -> None:
        append_batch(spark, table, batch, batch_id, stream_id(spark))

    return (
        out.writeStream.foreachBatch(apply)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
        .trigger(**_trigger(trigger_type, trigger_interval))
        .start()
    )

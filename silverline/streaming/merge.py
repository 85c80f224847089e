"""MERGE inside a streaming query: each micro-batch is merged into a table.

Every batch goes through :func:`silverline.sources.tables.merge_table` with its
batch id and the id of its query, which Spark keeps in the checkpoint. Both are recorded on
the table, so a batch replayed after a failure is skipped, while other streams into the same
table, and a stream with a fresh checkpoint, count their batches on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverline.operators.merge import MergeSpec
from silverline.sources.ingest import StreamId, _trigger
from silverline.sources.tables import merge_table


def merge_stream(
    stream: DataFrame,
    target_table: str,
    spec: MergeSpec,
    checkpoint_location: str,
    trigger_type: str = "availableNow",
    trigger_interval: str | None = None,
    create_schema: StructType | None = None,
) -> StreamingQuery:
    """Start ``stream.writeStream.foreachBatch(merge into target_table)``."""
    if not stream.isStreaming:
        raise ValueError("merge_stream needs a streaming DataFrame; use merge_table for batches")
    spec.validate()

    stream_id = StreamId(checkpoint_location)

    def _apply(batch: DataFrame, batch_id: int) -> None:
        merge_table(batch.sparkSession, target_table, batch, spec, batch_id=batch_id,
                    create_schema=create_schema, stream_id=stream_id(batch.sparkSession))

    return (
        stream.writeStream.foreachBatch(_apply)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**_trigger(trigger_type, trigger_interval))
        .start()
    )

"""G1: keep a corpus current from a stream of changes.

``readStream`` of change records ``(seq, op, id, header_key, text)`` ->
``foreachBatch`` applies each micro-batch as one B3 commit of the corpus.
Idempotent: a commit records the last applied batch of each stream; a batch
replayed after a failure (same stream and batch) is skipped, so a restart
from the stream checkpoint never applies a batch twice. A stream is known by
``stream_id``, or else by its checkpoint folder: a new checkpoint is a new
stream, whose batches count from 0 again. Batches are expected in
``seq`` order (one ordered source, like a log partition); within a batch any
order is fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schema import CHANGE_SCHEMA
from ..sources.corpus import Corpus


def change_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of Parquet change records (any file source works)."""
    r = spark.readStream.schema(CHANGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def maintain(
    corpus: Corpus, changes: DataFrame, checkpoint_location: str, available_now: bool = True, stream_id: str | None = None
) -> StreamingQuery:
    """Start the maintenance query; ``available_now`` drains what is there."""
    name = stream_id or checkpoint_location

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= corpus.last_batch_id(name):
            return  # already committed (replay after a restart)
        corpus.apply_changes(batch, stream=(name, batch_id))

    w = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

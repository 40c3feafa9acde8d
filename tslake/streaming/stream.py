"""Incremental Bronze -> Silver as a Structured Streaming query (O-33).

The stream reads the *manifests*, not the landed data: a landed file alone is
never valid (it may belong to a failed batch), and the file source marks
every file it has seen, so streaming data files would mark uncommitted ones as
done. Each micro-batch of manifests goes through the batch run's own
``apply_batches``, which leaves out the batches already applied. Manifests are written under new file
names for every attempt, so a retried batch is seen again. The upsert is
idempotent, so a micro-batch replayed after a failure gives the same table:
the checkpoint plus an idempotent sink is exactly-once. The checkpoint lies
under the root, so a stream started in another session goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tslake.plans.pipeline import apply_batches
from tslake.sources import bronze
from tslake.sources.schemas import MANIFEST, SILVER_PARTITIONS

def stream_checkpoint(root: str) -> str:
    return f"{root.rstrip('/')}/_control/stream"


def apply_manifests(spark: SparkSession, root: str, manifests: DataFrame, partitions=SILVER_PARTITIONS) -> None:
    """Apply the committed batches of one micro-batch that are not applied yet."""
    apply_batches(spark, root, manifests, partitions=partitions)


def start_silver_stream(
    spark: SparkSession,
    root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    partitions=SILVER_PARTITIONS,
):
    """Start the stream; ``available_now`` processes what has landed and stops.
    ``partitions`` is the Silver layout (see ``schemas.SILVER_PARTITIONS``)."""
    checkpoint = checkpoint or stream_checkpoint(root)
    manifests = spark.readStream.schema(MANIFEST).json(bronze.manifests_path(root))
    writer = (
        manifests.writeStream.foreachBatch(lambda df, _epoch: apply_manifests(spark, root, df, partitions))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_silver_stream(spark: SparkSession, root: str, checkpoint: str | None = None, partitions=SILVER_PARTITIONS) -> None:
    query = start_silver_stream(spark, root, checkpoint, available_now=True, partitions=partitions)
    query.awaitTermination()

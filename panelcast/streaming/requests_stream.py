"""Streaming request scoring (stateless).

Request files (one JSON object per line) land in a folder; each micro-batch
is parsed, joined to the static serving lookups (stream-static joins inside
``foreachBatch``), scored for every role and written under
``<out>/batch_id=<n>``. Writing per batch id with ``overwrite`` makes a
replayed batch (after a failure) replace its own output: exactly-once
results with the file sink. No state is kept between batches, so no
watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelcast.session import ensure_checkpoint_dir


def request_stream(spark: SparkSession, in_dir: str) -> DataFrame:
    """Each line is one request; its id is a hash of the text (stable across replays)."""
    src = spark.readStream.format("text").option("maxFilesPerTrigger", 100).load(in_dir)
    return src.select(F.sha2(F.col("value"), 256).alias("request_id"), "value")


def start_scoring(spark: SparkSession, in_dir: str, out_dir: str, scorer, *,
                  checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start the stream; ``scorer(batch_df) -> DataFrame`` scores one micro-batch."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/request-stream"

    def handle(batch: DataFrame, batch_id: int) -> None:
        scorer(batch).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    w = request_stream(spark, in_dir).writeStream.foreachBatch(handle).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

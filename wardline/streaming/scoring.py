"""Scoring a stream with the stateless batch transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardline.plans.lifecycle import score


def stream_score(stream: DataFrame, prep_model, feature_model, model_set, path: str, checkpoint: str,
                 ts_col: str | None = None, watermark: str = "1 hour", **options) -> None:
    """Each micro-batch is scored as a batch and stored under its number, so a replay changes nothing.

    With ``ts_col`` identical rows are scored once, however far apart they arrive within the
    watermark: the state holds rows younger than that.
    """
    if ts_col is not None:
        rows = stream.columns
        timed = stream.withColumn("__event_time", stream[ts_col].cast("timestamp")).withWatermark("__event_time", watermark)
        stream = timed.dropDuplicatesWithinWatermark(rows).drop("__event_time")

    def store(batch: DataFrame, batch_id: int) -> None:
        score(batch, prep_model, feature_model, model_set, dedup=False, **options).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}")

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

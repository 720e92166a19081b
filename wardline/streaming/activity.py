"""Address activity per time window on a stream, with exact distinct targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["src_ip", "window_start", "window_end"]


def with_event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need an instant, not a wall-clock time."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def _placed(stream: DataFrame, ts_col: str, width: str, slide: str | None, watermark: str) -> DataFrame:
    """(src_ip, dst_ip, w) of rows with an address; the window carries the watermark."""
    timed = with_event_time(stream, ts_col).withWatermark(ts_col, watermark).where(F.col("src_ip").isNotNull())
    span = F.window(F.col(ts_col), width, slide) if slide else F.window(F.col(ts_col), width)
    return timed.select("src_ip", "dst_ip", span.alias("w"))


def _bounds(df: DataFrame, *others: str) -> DataFrame:
    return df.select("src_ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *others)


def windowed_events(stream: DataFrame, ts_col: str, width: str = "1 hour", slide: str | None = None,
                    watermark: str = "1 hour") -> DataFrame:
    """Events per address and window, for update mode. State holds only windows younger than the watermark."""
    placed = _placed(stream, ts_col, width, slide, watermark)
    return _bounds(placed.groupBy("src_ip", "w").agg(F.count("*").alias("events")), "events")


def first_targets(stream: DataFrame, ts_col: str, width: str = "1 hour", slide: str | None = None,
                  watermark: str = "1 hour") -> DataFrame:
    """Each target of an address and window once, when it is first met.

    The state is one key for each of them, dealt by all three, so a busy address is no single
    key; it goes when the window closes. A null target is none.
    """
    placed = _placed(stream, ts_col, width, slide, watermark).where(F.col("dst_ip").isNotNull())
    return _bounds(placed.dropDuplicates(["src_ip", "w", "dst_ip"]), "dst_ip")


def run_activity(spark: SparkSession, stream: DataFrame, ts_col: str, checkpoint: str, width: str = "1 hour",
                 slide: str | None = None, watermark: str = "1 hour", path: str | None = None) -> DataFrame:
    """Run over the available input and return the latest value of every window since the first run.

    ``path`` holds the results and belongs to the checkpoint: a resumed query gives the same
    one. By default it lies beside the checkpoint.

    Two queries read the stream. Of the events, update mode emits a window whenever it changes, and
    the newest version wins; of the targets, each micro-batch adds those not met before. Every
    micro-batch is stored under its number, so a replay overwrites itself.
    """
    out = path or checkpoint.rstrip("/") + "-windows"

    def run(rows: DataFrame, name: str, mode: str, summed) -> None:
        def store(batch: DataFrame, batch_id: int) -> None:
            summed(batch).write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")

        query = rows.writeStream.outputMode(mode).foreachBatch(store).option(
            "checkpointLocation", f"{checkpoint.rstrip('/')}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    events = windowed_events(stream, ts_col, width, slide, watermark)
    targets = first_targets(stream, ts_col, width, slide, watermark)
    counted = lambda batch: batch.groupBy(*KEYS).agg(F.count("*").alias("new"))
    run(events, "events", "update", lambda batch: batch)
    run(targets, "targets", "append", counted)

    def stored(name: str, column: str) -> DataFrame:
        schema = f"src_ip string, window_start timestamp, window_end timestamp, {column} long"
        return spark.read.schema(schema).option("basePath", f"{out}/{name}").parquet(f"{out}/{name}/batch=*")

    newest = F.max(F.struct(F.col("batch").cast("bigint").alias("batch"), "events")).alias("v")
    latest = stored("events", "events").groupBy(*KEYS).agg(newest).select(*KEYS, "v.events")
    met = stored("targets", "new").groupBy(*KEYS).agg(F.sum("new").alias("dst_ips"))
    return latest.join(met, KEYS, "left").select(*KEYS, "events", F.coalesce("dst_ips", F.lit(0)).cast("long").alias("dst_ips"))

"""Late data, replays and restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wardline.operators import ensemble
from wardline.streaming import activity, incremental

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, src_ip string, dst_ip string"


def write(spark, path, minutes):
    rows = [(START + timedelta(minutes=m), "10.0.0.1", f"d{m}") for m in minutes]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, source, checkpoint):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = activity.run_activity(spark, stream, "ts", checkpoint)
    return {r["window_start"].hour: r["events"] for r in out.collect()}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    write(spark, source, [0, 1, 600])
    assert run(spark, source, checkpoint) == {0: 2, 10: 1}
    write(spark, source, [601])
    assert run(spark, source, checkpoint) == {0: 2, 10: 2}  # resumed: earlier windows stay
    write(spark, source, [2, 602])
    assert run(spark, source, checkpoint) == {0: 2, 10: 3}


def test_distinct_targets_stay_exact_after_a_kill(spark, tmp_path):
    """Targets met again in later batches count once; a run that dies between batches is resumed."""
    source, checkpoint, out = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out")
    rows = []
    for part in range(3):
        own = [(START + timedelta(minutes=(7 * i + part) % 110), f"10.0.0.{i % 2}", None if i % 9 == 0 else f"d{(i + part) % 23}")
               for i in range(80)]
        spark.createDataFrame(own, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        rows += own
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)

    # both queries die in their second batch, after the state of the batch was written
    for name, rows_of, mode, summed in (
            ("events", activity.windowed_events, "update", lambda b: b),
            ("targets", activity.first_targets, "append", lambda b: b.groupBy(*activity.KEYS).agg(F.count("*").alias("new")))):
        def dies(batch, batch_id):
            if batch_id == 1:
                batch.count()
                raise RuntimeError("killed")
            summed(batch).write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")

        query = rows_of(stream(), "ts").writeStream.outputMode(mode).foreachBatch(dies).option(
            "checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
    got = activity.run_activity(spark, stream(), "ts", checkpoint, path=out).collect()
    found = {(r["src_ip"], r["window_start"].hour): (r["events"], r["dst_ips"]) for r in got}
    known = {}
    for ts, src, dst in rows:
        known.setdefault((src, ts.hour), []).append(dst)
    assert found == {k: (len(v), len({d for d in v if d})) for k, v in known.items()}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(i % 2, [float(i % 2), 1.0]) for i in range(40)], "y int, v array<double>")
    rows = rows.select("y", ensemble.array_to_vector("v").alias("features"))
    path = str(tmp_path / "in")
    rows.repartition(2).write.parquet(path)
    model = incremental.SgdLogistic(2, 2, 0.5)
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    state = str(tmp_path / "w")
    incremental.stream_incremental_train(spark, stream(), model, "y", state, str(tmp_path / "c1"))
    first = incremental.restore(spark, state)
    assert first.steps == 2 and first.last_batch == 1
    # A new checkpoint numbers the same batches from 0 again.
    incremental.stream_incremental_train(spark, stream(), first, "y", state, str(tmp_path / "c2"))
    assert first.weights == model.weights and first.steps == 2
    # A restart with a fresh model goes on from the stored one.
    rows.limit(8).write.mode("append").parquet(path)
    again = incremental.stream_incremental_train(
        spark, stream(), incremental.SgdLogistic(2, 2, 0.5), "y", state, str(tmp_path / "c1"))
    assert again.steps == incremental.restore(spark, state).steps > 2
    assert incremental.restore(spark, str(tmp_path / "none")) is None


def test_gradient_matches_the_formula(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 1.0])], "y int, v array<double>")
    model = incremental.SgdLogistic(2, 2, rate=1.0, decay=0.0)
    model.partial_fit(rows.select("y", ensemble.array_to_vector("v").alias("features")), "y")
    # At zero weights every probability is 1/2.
    expected = [(-0.5 * 1 + 0.5 * 0 + 0.5 * 1) / 3, (0.5 + 0.5) / 3, (-0.5 + 0.5 + 0.5) / 3]
    assert model.weights[0] == pytest.approx([-e for e in expected])

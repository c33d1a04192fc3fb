"""Streaming landing -> bronze: availableNow run, restart resumes, no duplicates."""
import os
import tempfile

from callstar.sources.batches import latest_batch
from callstar.streaming.ingest_stream import stream_to_bronze


def test_stream_to_bronze_resumes(spark, sf_small):
    src = tempfile.mkdtemp(prefix="callstar-landing-")
    bronze = tempfile.mkdtemp(prefix="callstar-bronze-")
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    events.write.mode("overwrite").parquet(os.path.join(src, "part1"))
    schema = events.schema
    landing = os.path.join(src, "part1")

    q = stream_to_bronze(spark, landing, schema, bronze, "events_test", "2024-02-01 00:00:00")
    q.awaitTermination()
    out = spark.read.parquet(bronze)
    assert out.count() == events.count()
    assert {"ingestion_timestamp", "origem", "batch_id", "part"} <= set(out.columns)

    # restart with no new files: the checkpoint says everything is done
    q = stream_to_bronze(spark, landing, schema, bronze, "events_test", "2024-02-01 00:00:00")
    q.awaitTermination()
    assert spark.read.parquet(bronze).count() == events.count()
    assert latest_batch(spark.read.parquet(bronze).drop("batch_id", "part")).count() == events.count()


def test_stream_keeps_late_and_resent_records(spark):
    """Raw bronze loses nothing, however late a record is; the latest of a key is silver's choice."""
    from callstar.operators.dedup import keep_latest
    src, bronze = tempfile.mkdtemp(prefix="callstar-landing-"), tempfile.mkdtemp(prefix="callstar-bronze-")
    rows = [[(1, "2024-01-10 00:00:00"), (3, "2024-01-11 00:00:00")], [(2, "2024-01-01 00:00:00"), (1, "2024-01-12 00:00:00")]]
    for i, part in enumerate(rows):
        frame = spark.createDataFrame(part, "id long, ts string").selectExpr("id", "cast(ts as timestamp) AS ts")
        frame.write.mode("append").parquet(os.path.join(src, "in"))
        schema = frame.schema
        stream_to_bronze(spark, os.path.join(src, "in"), schema, bronze, "late", "2024-02-01 00:00:00").awaitTermination()
    out = spark.read.parquet(bronze)
    assert sorted(r["id"] for r in out.collect()) == [1, 1, 2, 3]
    assert keep_latest(out, ["id"], ["ts"]).count() == 3

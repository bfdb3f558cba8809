"""File streams: exactly once, late rows, copies, missing times."""

import json

from pyspark.sql import functions as F

from tidemark.plans.calls import silver_calls
from tidemark.sources.files import read_calls
from tidemark.streaming.ingest import ingest_calls, stream_silver_calls

NOON = 1_700_000_000


def call(name, at, duration=10, segments=1, **more):
    turns = [{"speaker": "customer", "text": "very good", "start_sec": float(i)} for i in range(segments)]
    return {"call_id": name, "customer_id": 1, "agent_id": "A1", "epoch_timestamp": at, "duration_sec": duration,
            "transcript_segments": turns, "metadata": {"call_type": "x", "channel": "phone", "region": "Pune"}, **more}


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def ids(spark, path):
    return sorted(r["call_id"] for r in spark.read.parquet(path).select("call_id").collect())


def test_late_rows_copies_and_missing_times(spark, tmp_path):
    landing, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(landing, "1.json", [call("a", NOON), call("a", NOON), call("n", None), call("neg", NOON, duration=-4)])
    stream_silver_calls(spark, str(landing), out, check)
    # one hour on, the limit stands half an hour before the newest call
    put(landing, "2.json", [call("b", NOON + 3600)])
    stream_silver_calls(spark, str(landing), out, check)
    put(landing, "3.json", [
        call("late", NOON + 600), call("in time", NOON + 3600 - 1200), call("b", NOON + 3600), call("b", NOON + 3601),
    ])
    stream_silver_calls(spark, str(landing), out, check)
    assert ids(spark, out) == ["a", "b", "b", "in time"]


def test_each_file_counts_once(spark, tmp_path):
    landing, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(landing, "1.json", [call("a", NOON)])
    ingest_calls(spark, str(landing), out, check)
    put(landing, "2.json", [call("b", NOON)])
    ingest_calls(spark, str(landing), out, check)
    ingest_calls(spark, str(landing), out, check)
    rows = spark.read.parquet(out)
    assert sorted(r["call_id"] for r in rows.collect()) == ["a", "b"]
    assert rows.filter(F.col("source_file").endswith(".json") & F.col("ingestion_timestamp").isNotNull()).count() == 2


def test_batch_and_stream_agree_on_rows_in_time(spark, tmp_path):
    landing, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(landing, "1.json", [call(f"c{i}", NOON + 7 * i, segments=i % 3, _injection_type="late_arriving") for i in range(40)])
    stream_silver_calls(spark, str(landing), out, check)
    batch = silver_calls(read_calls(spark, str(landing)))
    stored = spark.read.parquet(out)
    assert stored.columns == batch.columns and "_injection_type" not in batch.columns
    assert sorted(stored.collect()) == sorted(batch.collect())

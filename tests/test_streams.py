import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace import operators as op
from millrace.sources import ParquetTable
from millrace.streaming import BY_BATCH, BY_DAY, stream_by_lateness, stream_windows

START, WIDTH = datetime(2024, 1, 1, 0, 3), timedelta(minutes=10)


def land(folder, name, minutes):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as file:
        for k, m in enumerate(minutes):
            ts = None if m is None else (START + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ")
            file.write(json.dumps({"id": f"{name}{k}", "ts": ts}) + "\n")


def stream(spark, folder):
    return spark.readStream.schema("id STRING, ts TIMESTAMP").option("maxFilesPerTrigger", 1).json(folder)


def test_windows_of_a_stream_are_those_of_the_replay(spark, tmp_path):
    folder, table = str(tmp_path / "in"), ParquetTable(spark, str(tmp_path / "t"), BY_DAY)
    for name, minutes in (("a", [95, 61, 60]), ("b", [0, 1, 10, 10, 11]), ("c", [33, -4, None])):
        land(folder, name, minutes)
        stream_windows(stream(spark, folder), "ts", START, WIDTH, "1 day", table, str(tmp_path / "c")).awaitTermination()
    got = op.with_empty_ticks(table.read().select("tick", "n"), START, WIDTH)
    batch = spark.read.schema("id STRING, ts TIMESTAMP").json(folder)
    want = op.replay_windows(batch, "ts", START, WIDTH)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(r.n_rows for r in got.collect()) == 8  # minute 0 is the end of the window before


def test_no_row_of_a_stream_is_lost_for_being_late(spark, tmp_path):
    folder = str(tmp_path / "in")
    tables = [ParquetTable(spark, str(tmp_path / name), BY_BATCH) for name in ("on_time", "late", "marks")]
    lateness, marks = timedelta(minutes=30), []
    for name, minutes in (("a", [60, 61]), ("b", [31, 30, None]), ("c", [100]), ("d", [70, 71, 31])):
        land(folder, name, minutes)
        # Each run starts anew from the checkpoint, so the watermark has to be known without the run before.
        rows = stream(spark, folder).withWatermark("ts", "30 minutes")
        query = stream_by_lateness(rows, "ts", lateness, *tables, str(tmp_path / "c"))
        query.awaitTermination()
        marks += [p["eventTime"].get("watermark") for p in query.recentProgress if p["numInputRows"]]
    on_time, late = ({r.id for r in t.read().collect()} for t in tables[:2])
    assert late == {"b0", "b1", "b2", "d0", "d2"} and on_time == {"a0", "a1", "c0", "d1"}
    # The same watermark as the query's own.
    own = tables[2].read().orderBy("batch").collect()
    best = [max(r.micros for r in own[:k]) - lateness // timedelta(microseconds=1) for k in range(1, len(own))]
    theirs = [datetime.fromisoformat(m.replace("Z", "+00:00")).timestamp() * 1e6 for m in marks[1:]]
    assert theirs == best


def test_a_repeated_batch_is_split_as_before(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), BY_BATCH)
    for _ in range(2):
        table.overwrite_partitions(spark.range(3).withColumn("batch", F.lit(4).cast("long")))
    table.overwrite_partitions(spark.range(2).withColumn("batch", F.lit(5).cast("long")))
    assert table.read().count() == 5

import datetime as dt
import json
import os
import time

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.streaming import current, exceptions, ingest, volumes

SCHEMA = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("ts", T.TimestampType()),
])


def put(folder, number, records):
    """One file per batch, in event-time order."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/f{number}.json"
    with open(path, "w") as out:
        for k, v, day, hour in records:
            out.write(json.dumps({"k": k, "v": v, "ts": f"2024-01-{day:02d}T{hour:02d}:00:00"}) + "\n")
    os.utime(path, (time.time() - 1000 + number * 10,) * 2)


def stream(spark, folder):
    return ingest.open_files(spark, str(folder), SCHEMA, "json", per_trigger=1)


def test_upsert_over_several_batches(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, 1, [("a", 1, 1, 1), ("a", 2, 1, 2), ("b", 1, 1, 1)])
    put(src, 2, [("a", 3, 2, 1), ("c", 1, 2, 1)])
    put(src, 3, [("b", 9, 1, 0), ("c", 2, 3, 1), ("c", 3, 3, 1)])
    order = ["ts", "v"]
    current.upsert_stream(stream(spark, src), out, str(tmp_path / "cp"), ["k"], order)
    want = [("a", 3), ("b", 1), ("c", 3)]
    assert rows(current.current_records(spark, out, ["k"], order), "k", "v") == want
    # A replay of a batch changes nothing.
    replay = spark.read.schema(SCHEMA).json(f"{src}/f2.json")
    current._write_batch(out, ["k"], order)(replay, 1)
    assert rows(current.current_records(spark, out, ["k"], order), "k", "v") == want
    older = spark.createDataFrame([("z", 7, dt.datetime(2020, 1, 1)), ("a", 0, dt.datetime(2020, 1, 1))], SCHEMA)
    assert rows(current.current_records(spark, out, ["k"], order, older), "k", "v") == [*want, ("z", 7)]
    # Compaction retires the deltas; a later batch is merged with the snapshot, a replayed old one is not.
    target = str(tmp_path / "snap")
    assert rows(current.compact(spark, out, target, ["k"], order, older), "k", "v") == [*want, ("z", 7)]
    assert not [d for d in os.listdir(out) if d.startswith("batch_id")]
    put(src, 4, [("a", 4, 4, 1), ("d", 1, 4, 1)])
    current.upsert_stream(stream(spark, src), out, str(tmp_path / "cp"), ["k"], order)
    current._write_batch(out, ["k"], order)(replay.withColumn("v", F.lit(99)), 1)
    later = [("a", 4), ("b", 1), ("c", 3), ("d", 1), ("z", 7)]
    assert rows(current.current_records(spark, out, ["k"], order, target=target), "k", "v") == later
    assert rows(current.compact(spark, out, target, ["k"], order), "k", "v") == later
    assert rows(current.compact(spark, out, target, ["k"], order), "k", "v") == later
    assert len(os.listdir(target)) == 1 and not [d for d in os.listdir(out) if d.startswith("batch_id")]


def test_new_codes_are_reported_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, 1, [("A", 1, 1, 5), (" a", 1, 1, 3), ("known", 1, 1, 1), ("", 1, 1, 1)])
    put(src, 2, [("a", 1, 2, 1), ("B", 1, 2, 1)])
    put(src, 3, [("b", 1, 3, 1), ("KNOWN ", 1, 3, 1)])
    master = spark.createDataFrame([(" KNOWN",), (None,)], "code string")
    write = exceptions.report_new_codes
    write(stream(spark, src), master, out, str(tmp_path / "cp"), "k", "ts", "code")
    want = [("A", 3, "2024-01-01 03:00:00"), ("B", 2, "2024-01-02 01:00:00")]
    shown = [(c, n, str(t)) for c, n, t in rows(exceptions.reported_codes(spark, out), "code", "volume", "first_seen")]
    assert shown == want
    replay = spark.read.schema(SCHEMA).json(f"{src}/f2.json")
    exceptions._report(master, out, "k", "ts", "code")(replay, 1)
    assert sorted(r["volume"] for r in exceptions.reported_codes(spark, out).collect()) == [2, 3]
    # A later run continues where the last one ended.
    put(src, 4, [("c", 1, 4, 1), ("a", 1, 4, 1)])
    write(stream(spark, src), master, out, str(tmp_path / "cp"), "k", "ts", "code")
    assert rows(exceptions.reported_codes(spark, out), "code") == [("A",), ("B",), ("C",)]


def test_replays_are_dropped(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    batch = [(f"k{i}", i, 1, i % 24) for i in range(50)]
    put(src, 1, batch)
    put(src, 2, batch)
    unique = volumes.without_replays(stream(spark, src), ["k"], "ts", "10 days")
    ingest.drain(unique, out, str(tmp_path / "cp"))
    assert spark.read.schema(SCHEMA).parquet(out).count() == 50


def test_closed_windows_equal_the_batch_counts(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    data = {n: [(f"k{i % 3}", i, n, i % 24) for i in range(40 + n)] for n in range(1, 7)}
    for n, batch in data.items():
        put(src, n, batch)
    counted = volumes.window_volume(stream(spark, src), "k", "ts", "1 day")
    ingest.drain(counted, out, str(tmp_path / "cp"))
    got = spark.read.schema(counted.schema).parquet(out)
    every = spark.read.schema(SCHEMA).json(str(src)).groupBy(F.date_trunc("day", "ts").alias("window_start"), "k").agg(F.count("*").alias("volume"))
    closed = every.filter("window_start < '2024-01-05'")
    assert rows(got, "window_start", "k", "volume") == rows(closed, "window_start", "k", "volume")


def test_ragged_stream_equals_the_batch_reader(spark, tmp_path):
    from codeloom.sources import ragged

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1,2,3,4,5,6,x, y,z,t1,t2\n1,2,3\n1,2,3,4,5,6,x,z,t1,t2\n")
    header = ["A", "B", "C", "D", "E", "F", "D1", "D2", "T1", "T2"]
    good, rejects = ingest.open_ragged(spark, str(src), header)
    ingest.drain(good, f"{tmp_path}/good", f"{tmp_path}/cp1")
    ingest.drain(rejects, f"{tmp_path}/bad", f"{tmp_path}/cp2")
    want, wrong = ragged.repair(ragged.read_lines(spark, str(src)), header)
    assert rows(spark.read.parquet(f"{tmp_path}/good")) == rows(want)
    assert rows(spark.read.parquet(f"{tmp_path}/bad")) == rows(wrong)


def test_rows_rejects_and_counters_of_one_reading(spark, tmp_path):
    from codeloom.sources import ragged

    src, out, state = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/state"
    src.mkdir()
    header = ["A", "B", "C", "D", "E", "F", "D1", "D2", "T1", "T2"]
    (src / "a.txt").write_text("1,2,3,4,5,6,x, y,z,t1,t2\n1,2,3\n\n")
    (src / "b.txt").write_text("1,2,3,4,5,6,x,z,t1,t2\n" * 5)
    first = ingest.ingest_ragged(spark, str(src), header, out, state, per_trigger=1)
    (src / "c.txt").write_text("9,8\n7,2,3,4,5,6,x,z,t1,t2\n")
    second = ingest.ingest_ragged(spark, str(src), header, out, state, per_trigger=1)
    lines = ragged.read_lines(spark, str(src))
    want, wrong = ragged.repair(lines, header)
    good, rejects = ingest.ingested(spark, out, header)
    assert good.columns == want.columns and rows(good) == rows(want)
    assert rows(rejects) == rows(wrong) and rejects.count() == 3
    assert rows(ingest.ingest_counts(spark, out)) == rows(ragged.repair_counts(lines, len(header))) == [(6, 1, 3)]
    progress = [p for q in (first, second) for p in q.recentProgress if p["numInputRows"]]
    # Every line is read once, though rows and rejects are both written.
    assert [p["numInputRows"] for p in progress] == [3, 5, 2]
    seen = [p["observedMetrics"]["repair"] for p in progress]
    assert [(m["sound"], m["repaired"], m["rejected"]) for m in seen] == [(0, 1, 2), (5, 0, 0), (1, 0, 1)]

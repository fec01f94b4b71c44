import datetime as dt
import json
import time

from pyspark.sql import functions as F

from tidewright.streaming import streams


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_landed_pages_are_distinct_events(spark, tmp_path):
    for k, ids in enumerate(([1, 2], [2, 3])):
        (tmp_path / f"{k}.json").write_text(json.dumps({"data": {"list": [{"id": i, "t": "2026-01-05 10:00:00"} for i in ids]}}))
    rows = streams.streamed_rows(streams.landed_pages(spark, str(tmp_path))).select(F.get_json_object("record", "$.id").cast("int").alias("id"), F.get_json_object("record", "$.t").cast("timestamp").alias("t"))
    assert sorted(r.id for r in drain(streams.distinct_events(rows, "id", "t"), "distinct_ids").collect()) == [1, 2, 3]


def test_windows_begin_on_mondays(spark, tmp_path):
    spark.createDataFrame([(dt.datetime(2026, 1, d, 12), "a") for d in (5, 11, 12)] + [(dt.datetime(2026, 3, 1), "a")], "t timestamp, k string").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("t timestamp, k string").parquet(str(tmp_path / "in"))
    got = {r.bucket: r.n for r in drain(streams.windowed_counts(rows, "t", ["k"], weekly=True), "weeks", "complete").collect()}
    assert got[dt.datetime(2026, 1, 5)] == 2 and got[dt.datetime(2026, 1, 12)] == 1


def test_idle_rounds_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    t = dt.datetime(2026, 1, 1)
    rows = [("a", r, int(r == 2), False, t if r == 2 else None) for r in range(1, 9)] + [("b", r, 0, True, None) for r in range(1, 9)] + [("c", 1, 1, False, t)]
    schema = "voyage string, round int, new_events int, in_catalog boolean, last_event timestamp"
    batch = spark.createDataFrame(rows, schema)
    batch.write.parquet(str(tmp_path / "in"))
    want = {r.voyage: (r.idle_rounds, r.last_event, r.inactive) for r in streams.idle_rounds_batch(batch).collect()}
    got = {r.voyage: (r.idle_rounds, r.last_event, r.inactive) for r in drain(streams.idle_rounds(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), "idle", "update").collect()}
    assert got == want == {"a": (6, t, True), "b": (8, None, False), "c": (0, t, False)}


def test_upserts_by_batch(spark):
    state = {"df": spark.createDataFrame([(1, "old", 0)], "id int, v string, at int")}
    run = streams.upsert_batches(lambda: state["df"], lambda df: state.update(df=df), "id", "at")
    run(spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "n", 1)], "id int, v string, at int"), 0)
    assert {tuple(r) for r in state["df"].collect()} == {(1, "y", 2), (2, "n", 1)}


def test_silent_voyages_retire_by_timer(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "voyage string, round int, new_events int, in_catalog boolean, last_event timestamp"
    t = dt.datetime(2026, 1, 1)
    spark.createDataFrame([("silent", 1, 1, False, t), ("known", 1, 1, True, t)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    got = []
    rows = streams.idle_rounds(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), silent_ms=400)
    q = rows.writeStream.outputMode("update").foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="200 milliseconds").start()
    try:
        end = time.time() + 60
        while time.time() < end and not (any(r.inactive for r in got) and sum(r.voyage == "known" for r in got) > streams.IDLE_ROUNDS + 1):
            time.sleep(0.2)
    finally:
        q.stop()
    silent = [r for r in got if r.voyage == "silent"]
    assert [r.idle_rounds for r in silent] == list(range(streams.IDLE_ROUNDS + 1)) and silent[-1].inactive and silent[-1].last_event == t
    known = [r for r in got if r.voyage == "known"]
    assert [r.idle_rounds for r in known] == list(range(len(known))) and not any(r.inactive for r in known)


def test_a_batch_given_twice_changes_nothing(spark):
    state = {"rows": [(1, "old", 0)]}
    schema = "id int, v string, at int"
    run = streams.upsert_batches(lambda: spark.createDataFrame(state["rows"], schema), lambda df: state.update(rows=[tuple(r) for r in df.collect()]), "id", "at")
    batch = spark.createDataFrame([(1, "x", 1), (2, "n", 1)], schema)
    run(batch, 7)
    once = sorted(state["rows"])
    run(batch, 7)
    assert sorted(state["rows"]) == once == [(1, "x", 1), (2, "n", 1)]

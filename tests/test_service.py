"""The service from settings, its logs and spans, segments of state, and the commit log as a stream."""

import io
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidelog import config
from tidelog.operators import fold, masking
from tidelog.service import Service
from tidelog.shipping import ship
from tidelog.sources import commitlog
from tidelog.streaming import logs, observe, sinks


def entry(op, i, cells, ts, table="users"):
    body = op.encode() + json.dumps({"keyspace": "shop", "table": table, "pk": {"id": str(i)}, "ck": {}, "cols": cells, "ts": ts, "ttl": None}).encode()
    return len(body).to_bytes(4, "big") + body


def settings(tmp_path, **more):
    on = lambda **o: {"enabled": True, "options": {"key": "id", "columns": ["name", "email"], **o}}
    values = {"keyspace": "shop", "table": "users", "source_path": str(tmp_path / "log"), "work_path": str(tmp_path / "work"), "phi_key": "k", "probe_interval_s": 0.1, "destinations": {"postgres": on(), "clickhouse": on(), "timescaledb": on(every="day")}}
    return config.build(config.Settings, values | more)


def write(tmp_path, name, *entries):
    (tmp_path / "log").mkdir(exist_ok=True)
    with open(tmp_path / "log" / name, "ab") as f:
        f.write(b"".join(entries))


def test_run_resumes_and_masks_and_sends_bad_events_off(spark, tmp_path):
    day = 86_400_000_000
    write(tmp_path, "CommitLog-7-1.log", entry("I", 1, {"name": "a", "email": "x@y"}, 10), entry("I", 2, {"name": "b"}, day), entry("I", 9, {"name": "z"}, 5, "orders"), (20).to_bytes(4, "big") + b"GARBAGE DATA 1234567")
    first = Service(settings(tmp_path), spark).run()
    assert {k: v["events_written"] for k, v in first.items()} == {"postgres": 2, "clickhouse": 2, "timescaledb": 2}
    write(tmp_path, "CommitLog-7-2.log", entry("U", 1, {"name": "c"}, 20), entry("D", 2, {}, 2 * day))
    write(tmp_path, "CommitLog-7-1.log", entry("I", 3, {"name": None}, 11))
    again = Service(settings(tmp_path), spark)
    assert again.run()["postgres"]["events_written"] == 3
    digest = masking.Rules(key="k")
    email = spark.range(1).select(digest.expression(F.lit("x@y"), "pii_hash")).first()[0]
    assert sorted((r.id, r.name, r.email) for r in again.sinks["postgres"].read(spark).collect()) == [("1", "c", email), ("3", None, None)]
    assert again.sinks["clickhouse"].read(spark).count() == 4 and again.sinks["timescaledb"].read(spark).count() == 4
    dead = again.dead.read(spark)
    assert dead.count() == 3 and {r.error_message for r in dead.collect()} == {"unknown operation"}
    assert again.offsets.read(spark, "POSTGRES")["events"] == 5


def test_run_continuous_ends_at_shutdown(spark, tmp_path):
    write(tmp_path, "CommitLog-7-1.log", entry("I", 1, {"name": "a"}, 10))
    s = Service(settings(tmp_path, destinations={"clickhouse": {"enabled": True, "options": {"key": "id", "columns": ["name"]}}}), spark)
    t = threading.Thread(target=s.run_continuous)
    t.start()
    until = time.time() + 60
    while time.time() < until and s.sinks["clickhouse"].state.events_written < 1:
        time.sleep(0.2)
    write(tmp_path, "CommitLog-7-1.log", entry("I", 2, {"name": "b"}, 11))
    while time.time() < until and s.sinks["clickhouse"].state.events_written < 2:
        time.sleep(0.2)
    s.shutdown()
    t.join(60)
    assert not t.is_alive() and s.sinks["clickhouse"].read(spark).count() == 2 and s.health.healthy


def test_stream_of_frames_in_pieces(spark, tmp_path):
    write(tmp_path, "CommitLog-7-1.log", *[entry("I", i, {"name": "n" * i}, i) for i in range(50)])
    write(tmp_path, "CommitLog-7-10.log", *[entry("I", i, {}, i) for i in range(50, 60)], b"\0\0")
    ship(spark).dataSource.register(commitlog.CommitLogSource)
    stream = spark.readStream.format("commitlog").option("path", str(tmp_path / "log")).option("piecebytes", 500).load()
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = commitlog.parse(spark.read.schema(stream.schema).parquet(str(tmp_path / "out")))
    assert sorted(r.timestamp_micros for r in got.collect()) == list(range(60))


def test_segments_are_merged_and_replays_change_nothing(spark, tmp_path):
    sink = sinks.UpsertSink("POSTGRES", str(tmp_path), ["k"], ["a"], ["seq"], together=3)
    kind = "k int, seq int, op string, a string, has_a boolean"
    for i in range(11):
        batch = spark.createDataFrame([(i % 4, i, "UPDATE", f"v{i}", True)], kind)
        sink.write_batch(batch, i)
        if i % 3 == 2:
            sink.write_batch(batch, i)
    assert sink.segments.whole(spark) == [(0, 8), (9, 9), (10, 10)]
    assert sorted((r.k, r.a) for r in sink.read(spark).collect()) == [(0, "v8"), (1, "v9"), (2, "v10"), (3, "v7")]
    store = sinks.OffsetStore(str(tmp_path / "offsets"), together=3)
    for i in [*range(7), 5, 2]:
        assert store.commit(spark, "POSTGRES", i, spark.createDataFrame([(i, 10 * i)], "seq int, ts_us int"), "seq", "ts_us")
    assert store.read(spark, "POSTGRES") == {"events": 7, "last_position": 6, "last_ts_us": 60, "batch_id": 6}


def test_dead_letters_replace_their_own_and_raise(spark, tmp_path):
    store = sinks.DeadLetterSink("DLQ", str(tmp_path / "d"))
    rows = spark.createDataFrame([("a", "P", "t", "2024-01-01 00:00:00")], "event_id string, destination string, error_type string, failed_at string")
    for origin in ("x", "y", "x"):
        store.write_batch(rows, 1, origin)
    assert store.read(spark).count() == 2
    (tmp_path / "file").write_text("no folder")
    broken = sinks.DeadLetterSink("DLQ", str(tmp_path / "file"))
    with pytest.raises(Exception):
        broken.write_batch(rows, 1)
    assert broken.state.errors_count == 1


def test_logs_hide_masked_fields_and_spans_nest():
    out, spans = io.StringIO(), []
    logs.configure("DEBUG", "json", out)
    logs.exporters.append(spans.append)
    try:
        with logs.bound(table="users"), logs.span("outer"), logs.span("inner"):
            logs.get_logger("tidelog.x").info("written", email="a@b", rows=3)
        with pytest.raises(ValueError), logs.span("bad"):
            raise ValueError("no")
    finally:
        logs.exporters.clear()
        logs.configure("CRITICAL")
    line = json.loads(out.getvalue().splitlines()[0])
    assert (line["event"], line["email"], line["rows"], line["table"], line["level"]) == ("written", "***", 3, "users", "info")
    assert [s["name"] for s in spans] == ["inner", "outer", "bad"] and spans[0]["parent_id"] == spans[1]["span_id"] == line.get("none", spans[1]["span_id"])
    assert spans[0]["trace_id"] == spans[1]["trace_id"] != spans[2]["trace_id"] and spans[2]["status"] == "error"


def test_probes_of_ports_and_periodic_ones():
    server = observe.serve(0)
    health, stop = observe.Health(), threading.Event()
    t = observe.every(0.05, health, {"up": observe.reaches("127.0.0.1", server.server_address[1]), "down": observe.reaches("127.0.0.1", 1, 0.2)}, stop)
    until = time.time() + 10
    while time.time() < until and len(health.dependencies) < 2:
        time.sleep(0.05)
    stop.set()
    t.join(10)
    server.shutdown()
    assert {k: v["status"] for k, v in health.dependencies.items()} == {"up": "up", "down": "down"} and health.dependencies["down"]["latency_ms"] == 0


def test_parity_sees_repeated_rows_and_rows_project_without_settings(spark):
    a, b = (spark.createDataFrame(x, "k int, v int") for x in ([(1, 1), (2, 2), (3, 3)], [(1, 1), (1, 1), (2, 2), (4, 4)]))
    assert sorted(map(tuple, fold.parity(a, b, ["k"]).collect())) == [(1, "different"), (3, "missing_right"), (4, "missing_left")]
    e = spark.createDataFrame([({"id": "1", "x": "p"}, {"x": "c"}, {"y": None, "id": "9"})], "partition_key map<string,string>, clustering_key map<string,string>, columns map<string,string>")
    assert e.select(fold.project_row().alias("m")).first().m == {"id": "9", "x": "c", "y": None}


def test_settings_from_environment_and_limits(tmp_path, monkeypatch):
    monkeypatch.setenv("TIDELOG_KEY", "secret")
    (tmp_path / "a.yaml").write_text("phi_key: ${TIDELOG_KEY}\npii_salt: ${NOT_SET:-salt}\ndestinations:\n  postgres: {enabled: true, options: {a: {b: 1, c: 2}}}\n")
    (tmp_path / "b.yaml").write_text("destinations:\n  postgres: {options: {a: {c: 3}}}\n")
    s = config.load(str(tmp_path / "a.yaml"), str(tmp_path / "b.yaml"))
    assert (s.phi_key, s.pii_salt, s.destinations.postgres.enabled, s.destinations.postgres.options) == ("secret", "salt", True, {"a": {"b": 1, "c": 3}})
    with pytest.raises(ValueError):
        config.load(pipeline={"batch_size": 0})


def test_triggers_take_a_bounded_number_of_pieces(tmp_path):
    write(tmp_path, "CommitLog-7-1.log", *[entry("I", i, {}, i) for i in range(20)])
    reader = commitlog._Reader(str(tmp_path / "log"), 200, 3)
    whole = reader.latestOffset()
    pieces = reader.partitions({}, whole)
    assert len(pieces) > 3 and sum(p.end - p.start for p in pieces) == whole["CommitLog-7-1.log"]
    write(tmp_path, "CommitLog-7-1.log", *[entry("I", i, {}, i) for i in range(20)])
    some = reader.latestOffset()
    assert len(reader.partitions(whole, some)) == 3 and reader.latestOffset() != some

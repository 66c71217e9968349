"""The change-log engine: unit vectors, replays against a sequential model, sources, streams."""

import hashlib
import hmac
import json
import random
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from tidelog import config
from tidelog.functions import scalar
from tidelog.operators import evolution, fold, masking, offsets, quality, typemap
from tidelog.sources import commitlog
from tidelog.streaming import observe, pipeline, retry, sinks

LOG = "user_id bigint, ck bigint, seq bigint, ts_us bigint, op string, a string, has_a boolean, b string, has_b boolean"


def random_log(n, seed, users=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        op = r.choice(("INSERT", "UPDATE", "UPDATE", "UPDATE", "DELETE"))
        ha, hb = (r.random() < 0.6, r.random() < 0.5) if op != "DELETE" else (False, False)
        rows.append((r.randrange(users), r.randrange(3), i, 1000 + i, op, r.choice(("x", "y", None)) if ha else None, ha, r.choice(("p", None)) if hb else None, hb))
    return rows


def replay(rows, clustered, scope_partition=True):
    state = {}
    for u, ck, seq, _, op, a, ha, b, hb in rows:
        key = (u, ck) if clustered else (u,)
        if op == "DELETE":
            for k in [k for k in state if (k[0] == u if scope_partition else k == key)]:
                del state[k]
            continue
        cells = state.setdefault(key, {"a": None, "b": None})
        cells |= {k: v for k, v, h in (("a", a, ha), ("b", b, hb)) if h} | {"last": seq}
    return {k: (v["a"], v["b"], v["last"]) for k, v in state.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("clustered,scope", [(False, True), (True, True), (True, False)])
def test_fold_equals_replay(spark, seed, clustered, scope):
    rows = random_log(120, seed)
    shuffled = rows[:]
    random.Random(9).shuffle(shuffled)
    keys = ["user_id", "ck"] if clustered else ["user_id"]
    out = fold.upsert_fold(spark.createDataFrame(shuffled, LOG), keys, ["a", "b"], ["seq"], ["user_id"] if scope and clustered else None)
    assert {tuple(r[k] for k in keys): (r.a, r.b, r.last.seq) for r in out.collect()} == replay(rows, clustered, scope)


def test_states_merge_in_any_order_and_number(spark):
    rows = random_log(90, 5)
    parts = [fold.partial(spark.createDataFrame(rows[i::3], LOG), ["user_id"], ["a", "b"], ["seq"]) for i in range(3)]
    merged = fold.merge(parts[2].union(parts[0]).union(parts[1]).union(parts[0]), ["user_id"], ["a", "b"])
    assert {(r.user_id,): (r.a, r.b, r.last.seq) for r in fold.finish(merged, ["user_id"], ["a", "b"]).collect()} == replay(rows, False)


def test_digests_equal_hashlib(spark):
    texts = ["user@example.com", "", None, "MRN-12345", "é日本"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for key in ("test-secret-key", "k" * 100):
        for r in df.select("t", scalar.sha256_hex(F.col("t")).alias("s"), scalar.hmac_sha256_hex(F.col("t"), key).alias("h")).collect():
            assert r.s == (None if r.t is None else hashlib.sha256(r.t.encode()).hexdigest())
            assert r.h == (None if r.t is None else hmac.new(key.encode(), r.t.encode(), hashlib.sha256).hexdigest())


def test_classification_and_mask(spark):
    rules = masking.Rules(key="k")
    names = {"email": "pii_hash", "phone": "pii_hash", "SSN": "pii_hash", "className": "pii_hash", "ip_address": "pii_hash", "medical_record_number": "phi_token", "patient_id_email": "phi_token", "age": "none", "city": "none"}
    assert {n: rules.classify(n) for n in names} == names
    with pytest.raises(ValueError):
        masking.mask(spark.createDataFrame([("x",)], "diagnosis string"), masking.Rules())
    assert masking.Rules(strategies={"email": "passthrough"}).classify("email") == "none"


def test_types_and_compatibility():
    assert typemap.mapped("text", "CLICKHOUSE") == "String" and typemap.mapped("MAP<TEXT,INT>", "POSTGRES") is None and typemap.mapped("MAP<TEXT,INT>", "POSTGRES", strict=False) == "jsonb"
    old = evolution.TableSchema("k", "t", {"id": "uuid", "a": "int", "b": "text"}, ("id",))
    new = old.evolve({"id": "uuid", "a": "bigint", "c": "text"})
    assert [(c.change_type, c.column_name, c.is_compatible()) for c in old.compare(new)] == [("ADD_COLUMN", "c", True), ("ALTER_TYPE", "a", True), ("DROP_COLUMN", "b", True)]
    assert old.fingerprint() == old.with_version(2).fingerprint() != new.fingerprint()
    assert old.compare(evolution.TableSchema("k", "t", dict(old.columns), ("id", "a")))[0].is_compatible() is False
    with pytest.raises(ValueError):
        evolution.TableSchema("k", "t", {"a": "int"}, ("id",))


def test_incompatible_tables_pause_alone(spark):
    reg = evolution.Registry()
    a, b = (evolution.TableSchema("k", t, {"id": "uuid", "v": "int"}, ("id",)) for t in ("a", "b"))
    for s in (a, b, a.evolve({"id": "uuid", "v": "text"}), b.evolve({"id": "uuid", "v": "bigint"})):
        reg.register(s)
    good, bad = reg.route(spark.createDataFrame([("k", "a"), ("k", "b")], "keyspace string, table_name string"))
    assert [r.table_name for r in good.collect()] == ["b"] and [r.table_name for r in bad.collect()] == ["a"]


def test_offsets_refuse_to_go_back_and_add_up(spark):
    kind = "table_name string, keyspace string, partition_id bigint, destination string, last_event_timestamp_micros bigint, events_replicated_count bigint"
    held = spark.createDataFrame([("t", "k", 1, "P", 50, 100), ("t", "k", 2, "P", 50, 100)], kind)
    fresh = spark.createDataFrame([("t", "k", 1, "P", 50, 10), ("t", "k", 2, "P", 40, 10), ("t", "k", 3, "P", 5, 1)], kind)
    assert sorted((r.partition_id, r.last_event_timestamp_micros, r.events_replicated_count) for r in offsets.upsert(held, fresh).collect()) == [(1, 50, 110), (2, 50, 100), (3, 5, 1)]


def test_retry():
    policy, waits, calls = retry.RetryPolicy(jitter=False), [], []

    def fails():
        calls.append(1)
        raise ConnectionError("refused")

    with pytest.raises(ConnectionError):
        retry.call(fails, policy, sleep=waits.append)
    assert len(calls) == 3 and waits == [1.0, 2.0] and scalar.backoff_seconds(12, jitter=False) == 60
    assert retry.retryable(Exception("invalid connection")) and not retry.retryable(Exception("syntax error")) and retry.retryable(Exception("odd"))


def test_frames_end_at_bad_lengths():
    frame = lambda e: len(e).to_bytes(4, "big") + e
    two = frame(b"I" * 12) + frame(b"U" * 20)
    assert [f[0] for f in commitlog.frames(two)] == [0, 16]
    for tail in (b"\0\0\0\0abc", (100_000_001).to_bytes(4, "big") + b"x", frame(b"z" * 30)[:-1], b"\0\0"):
        assert len(list(commitlog.frames(two + tail))) == 2
    assert [f[0] for f in commitlog.frames(two, 16)] == [16]


def test_segments_parse_resume_and_sort_by_number(spark, tmp_path):
    body = lambda op, i: (lambda e: len(e).to_bytes(4, "big") + e)(op + json.dumps({"keyspace": "k", "table": "t", "pk": {"id": str(i)}, "ck": {}, "cols": {"a": None}, "ts": i, "ttl": None}).encode())
    (tmp_path / "CommitLog-7-2.log").write_bytes(body(b"I", 1) + body(b"U", 2))
    (tmp_path / "CommitLog-7-10.log").write_bytes(body(b"D", 3) + (20).to_bytes(4, "big") + b"GARBAGE DATA 1234567" + (5).to_bytes(4, "big") + b"I{}  ")
    good, bad = commitlog.read_events(spark, str(tmp_path), "k", "t")
    rows = sorted(good.collect(), key=lambda r: r.timestamp_micros)
    assert [r.event_type for r in rows] == ["INSERT", "UPDATE", "DELETE"] and rows[0].columns == {"a": None} and bad.count() == 2
    after, _ = commitlog.read_events(spark, str(tmp_path), start_file="CommitLog-7-2.log", start_position=rows[1].position)
    assert [r.timestamp_micros for r in after.collect()] == [3]


def test_stream_equals_batch_with_restart(spark, tmp_path):
    rows = random_log(100, 7)
    sink = sinks.UpsertSink("POSTGRES", str(tmp_path / "out"), ["user_id"], ["a", "b"], ["seq"])
    store = sinks.OffsetStore(str(tmp_path / "offsets"))
    for part in (rows[:60], rows[60:]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        pipeline.start(stream, sink, str(tmp_path / "check"), offsets=store).awaitTermination()
    assert {(r.user_id,): (r.a, r.b, r.last.seq) for r in sink.read(spark).collect()} == replay(rows, False)
    assert store.read(spark, "POSTGRES")["events"] == 100


def test_failing_sink_goes_to_dead_letters(spark, tmp_path):
    class Broken(sinks.AppendSink):
        def write_batch(self, batch, batch_id):
            raise ValueError("syntax error at 1")

    spark.createDataFrame(random_log(10, 1), LOG).write.parquet(str(tmp_path / "in"))
    dead = sinks.DeadLetterSink("DLQ", str(tmp_path / "dlq"))
    broken = Broken("CLICKHOUSE", str(tmp_path / "x"), {})
    pipeline.start(spark.readStream.schema(LOG).parquet(str(tmp_path / "in")), broken, str(tmp_path / "c"), dead=dead).awaitTermination()
    assert dead.count(spark).collect()[0]["count"] == 10 and broken.state.health == "unhealthy"


def test_contract_rules(spark):
    kind = "event_type string, timestamp_micros bigint, partition_key map<string,string>, columns map<string,string>, captured_at timestamp, keyspace string, table_name string, ttl_seconds int"
    rows = [("INSERT", 1, {"a": "1"}, {"b": "2"}, None, "k", "t", None), ("DELETE", 0, {}, {"b": "1"}, None, "K", None, -1), (None, None, None, None, None, None, None, None)]
    got = [r.v for r in spark.createDataFrame(rows, kind).select(quality.event_violations(strict=True).alias("v")).collect()]
    assert got[0] == [] and got[1] == ["timestamp", "partition_key", "keyspace", "table_name", "ttl", "delete_columns"] and "event_type" in got[2]


def test_settings_merge_and_check(tmp_path):
    (tmp_path / "a.yaml").write_text("table: orders\npipeline:\n  batch_size: 7\n  retry: {max_attempts: 2}\n")
    s = config.load(str(tmp_path / "a.yaml"), pipeline={"batch_size": 8})
    assert (s.table, s.pipeline.batch_size, s.pipeline.retry.max_attempts, s.destinations.postgres.enabled) == ("orders", 8, 2, False)
    with pytest.raises(ValueError):
        config.load(nothing=1)


def test_health_and_metrics_pages():
    health, metrics = observe.Health(), observe.Metrics()
    server = observe.serve(0, health, metrics)
    at = f"http://127.0.0.1:{server.server_address[1]}"
    with pytest.raises(urllib.error.HTTPError) as e:
        urllib.request.urlopen(f"{at}/health")
    assert e.value.code == 503
    health.probe({"a": lambda: True})
    metrics.add("events_processed_total", 3, destination="POSTGRES", table="t")
    metrics.observe(0.05, "POSTGRES")
    assert json.load(urllib.request.urlopen(f"{at}/health"))["status"] == "healthy"
    text = urllib.request.urlopen(f"{at}/metrics").read().decode()
    assert 'events_processed_total{destination="POSTGRES",table="t"} 3' in text and 'replication_duration_seconds_bucket{destination="POSTGRES",le="0.1"} 1' in text
    health.probe({"a": lambda: 1 / 0})
    assert not health.healthy
    server.shutdown()


def test_entry_and_queries_have_sql():
    import __spark_entry__ as e

    from tidelog.plans import catalog

    assert catalog.QUERIES.keys() == catalog.SQL.keys() and catalog.QUERIES.keys() <= e.queries().keys()

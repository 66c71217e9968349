"""Named queries over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import scalar
from tidelog.operators import accounting, evolution, fold, masking, offsets, quality, typemap
from tidelog.sources import adapters, commitlog
from tidelog.sources.adapters import COLUMNS, read
from tidelog.streaming import pipeline, sinks

#: A fixed present, so that results don't change: 2024-02-01 in microseconds.
NOW = 1_706_745_600_000_000
KEY = "test-secret-key"
DESTINATIONS = ("POSTGRES", "CLICKHOUSE", "TIMESCALEDB")
RULES = masking.Rules(key=KEY)

QUERIES: dict = {}
SQL: dict[str, str] = {}

LOG = """log AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id AS seq, epoch_us(ts) AS ts_us, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op, event_type, value, props,
 event_type IN ('signup', 'purchase', 'click') AS has_value, event_type IN ('signup', 'purchase', 'view') AS has_props FROM events)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def log(spark: SparkSession, d: str) -> DataFrame:
    return adapters.change_log(read(spark, d, "events"))


def shared(spark: SparkSession, name: str) -> str:
    """A new folder that executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidelog-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def mounted(path: str) -> str:
    """A path that every machine has mounted, for files that aren't Spark's own."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if ":" in path.split("/")[0]:
        raise ValueError(f"segment files need a mounted folder, not {path}")
    return path


# Folds

_FOLD = f"""WITH {LOG}, del AS (SELECT user_id, max(seq) AS d FROM log WHERE op = 'DELETE' GROUP BY 1), w AS (SELECT l.* FROM log l LEFT JOIN del USING (user_id) WHERE op <> 'DELETE' AND seq > coalesce(d, -1))
SELECT user_id, arg_max(value, seq) FILTER (WHERE has_value) AS value, arg_max(props, seq) FILTER (WHERE has_props) AS props, max(seq) AS last_seq FROM w GROUP BY 1"""


@query(_FOLD)
def upsert_fold(spark, d):
    return fold.upsert_fold(log(spark, d), ["user_id"], COLUMNS, ["seq"]).select("user_id", *COLUMNS, F.col("last.seq").alias("last_seq"))


@query(f"""WITH {LOG}, del AS (SELECT user_id, max(seq) AS d FROM log WHERE op = 'DELETE' GROUP BY 1), w AS (SELECT l.* FROM log l LEFT JOIN del USING (user_id) WHERE op <> 'DELETE' AND seq > coalesce(d, -1))
SELECT user_id, day, arg_max(value, seq) FILTER (WHERE has_value) AS value, arg_max(props, seq) FILTER (WHERE has_props) AS props, max(seq) AS last_seq FROM w GROUP BY 1, 2""")
def upsert_fold_clustered(spark, d):
    return fold.upsert_fold(log(spark, d), ["user_id", "day"], COLUMNS, ["seq"], scope=["user_id"]).select("user_id", "day", *COLUMNS, F.col("last.seq").alias("last_seq"))


@query(f"""WITH {LOG}, del AS (SELECT user_id, day, max(seq) AS d FROM log WHERE op = 'DELETE' GROUP BY 1, 2), w AS (SELECT l.* FROM log l LEFT JOIN del USING (user_id, day) WHERE op <> 'DELETE' AND seq > coalesce(d, -1))
SELECT user_id, day, arg_max(value, seq) FILTER (WHERE has_value) AS value, arg_max(props, seq) FILTER (WHERE has_props) AS props, max(seq) AS last_seq FROM w GROUP BY 1, 2""")
def upsert_fold_exact_delete(spark, d):
    return fold.upsert_fold(log(spark, d), ["user_id", "day"], COLUMNS, ["seq"]).select("user_id", "day", *COLUMNS, F.col("last.seq").alias("last_seq"))


@query(f"""WITH {LOG}, o AS (SELECT *, {{'t': ts_us, 's': seq}} AS k FROM log), del AS (SELECT user_id, max(k) AS d FROM o WHERE op = 'DELETE' GROUP BY 1), w AS (SELECT o.* FROM o LEFT JOIN del USING (user_id) WHERE op <> 'DELETE' AND (d IS NULL OR k > d))
SELECT user_id, arg_max(value, k) FILTER (WHERE has_value) AS value, arg_max(props, k) FILTER (WHERE has_props) AS props, max(k).t AS last_ts_us FROM w GROUP BY 1""")
def lww_by_timestamp(spark, d):
    return fold.upsert_fold(log(spark, d), ["user_id"], COLUMNS, ["ts_us", "seq"]).select("user_id", *COLUMNS, F.col("last.ts_us").alias("last_ts_us"))


@query(f"WITH {LOG} SELECT seq, user_id, op, CASE WHEN has_value THEN value ELSE 0.0::DOUBLE END AS value, CASE WHEN has_props THEN props ELSE '' END AS props FROM log WHERE op <> 'DELETE'")
def append_log(spark, d):
    return fold.append_log(log(spark, d), {"value": 0.0, "props": ""}).select("seq", "user_id", "op", "value", "props")


@query(f"WITH {LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS n FROM log) SELECT user_id, seq, op, value, props, op = 'DELETE' AS is_deleted FROM r WHERE n = 1")
def replacing_latest(spark, d):
    return fold.replacing(log(spark, d).select("user_id", "seq", "op", "value", "props"), ["user_id"], "seq").withColumn("is_deleted", F.col("op") == "DELETE")


@query(f"WITH {LOG} SELECT user_id, max(seq) AS deleted_at, count(*) AS deletes FROM log WHERE op = 'DELETE' GROUP BY 1")
def tombstones(spark, d):
    return fold.tombstones(log(spark, d), ["user_id"], "seq")


@query("SELECT 'shop.orders:' || o_custkey || '::' || epoch_us(o_orderdate) AS event_key, min(o_orderkey) AS o_orderkey, count(*) AS copies FROM orders GROUP BY 1")
def event_key_dedup(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", scalar.micros("o_orderdate").alias("us"))
    key = scalar.event_key(F.lit("shop"), F.lit("orders"), [F.col("o_custkey")], [], F.col("us"))
    return fold.deduplicate(o, key, "o_orderkey").select("event_key", "o_orderkey", "copies")


@query(f"WITH {LOG} SELECT seq, user_id, op FROM log WHERE seq % 3 <> 0 OR ts_us + 86400000000 * (seq % 30) > {NOW}")
def ttl_expiry(spark, d):
    timed = log(spark, d).withColumns({"timestamp_micros": F.col("ts_us"), "ttl_seconds": F.when(F.col("seq") % 3 == 0, ((F.col("seq") % 30) * 86400).cast("int"))})
    return fold.live_at(timed, NOW).select("seq", "user_id", "op")


@query(f"WITH {LOG}, a AS (SELECT user_id, max(seq) AS v FROM log WHERE op <> 'DELETE' GROUP BY 1), b AS (SELECT user_id, max(seq) AS v FROM log GROUP BY 1) SELECT user_id, CASE WHEN a.v IS NULL THEN 'missing_left' WHEN b.v IS NULL THEN 'missing_right' ELSE 'different' END AS difference FROM a FULL JOIN b USING (user_id) WHERE a.v IS DISTINCT FROM b.v")
def destination_parity(spark, d):
    rows = log(spark, d)
    a, b = (x.groupBy("user_id").agg(F.max("seq").alias("v")) for x in (rows.filter("op <> 'DELETE'"), rows))
    return fold.parity(a, b, ["user_id"])


# Filters, counts

@query(f"WITH {LOG} SELECT seq, user_id, op FROM log WHERE user_id % 2 = 0")
def table_filter(spark, d):
    named = log(spark, d).withColumn("table_name", F.when(F.col("user_id") % 2 == 0, "users").otherwise("orders"))
    return named.filter("table_name = 'users'").select("seq", "user_id", "op")


@query(f"WITH {LOG} SELECT op, event_type, count(*) AS events FROM log GROUP BY 1, 2")
def op_counts(spark, d):
    return accounting.counters(log(spark, d), ["op", "event_type"])


# Masking

_HMAC = """sha256(from_hex('{o}') || unhex(sha256(from_hex('{i}') || encode({x}))))"""


def _hmac_sql(x: str) -> str:
    raw = KEY.encode().ljust(64, b"\0")
    return _HMAC.format(o=bytes(b ^ 0x5C for b in raw).hex(), i=bytes(b ^ 0x36 for b in raw).hex(), x=x)


@query("SELECT c_custkey, sha256(c_name) AS email, c_mktsegment AS city FROM customer")
def mask_pii_customer(spark, d):
    return masking.mask(read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("email"), F.col("c_mktsegment").alias("city")), RULES)


@query(f"SELECT c_custkey, {_hmac_sql('c_name')} AS patient_id, c_acctbal AS balance FROM customer")
def mask_phi_customer(spark, d):
    return masking.mask(read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("patient_id"), F.col("c_acctbal").alias("balance")), RULES)


@query(f"SELECT s_suppkey, sha256(s_name) AS ip_address, {_hmac_sql('s_name')} AS Patient_ID_no, sha256(CAST(s_nationkey AS VARCHAR)) AS phone, s_acctbal FROM supplier")
def mask_by_classification(spark, d):
    s = read(spark, d, "supplier")
    return masking.mask(s.select("s_suppkey", F.col("s_name").alias("ip_address"), F.col("s_name").alias("Patient_ID_no"), F.col("s_nationkey").alias("phone"), "s_acctbal"), RULES)


@query(f"WITH {LOG} SELECT seq, CASE WHEN has_value AND op <> 'DELETE' THEN sha256(CAST(CAST(value * 100 AS BIGINT) AS VARCHAR)) END AS email, CASE WHEN has_props AND op <> 'DELETE' THEN props END AS props FROM log")
def mask_cells(spark, d):
    cells = F.map_filter(F.create_map(F.lit("email"), F.round(F.col("value") * 100).cast("bigint").cast("string"), F.lit("props"), F.col("props")), lambda k, v: (F.col("op") != "DELETE") & F.when(k == "email", F.col("has_value")).otherwise(F.col("has_props")))
    masked = log(spark, d).select("seq", masking.mask_cells(cells, RULES).alias("c"))
    return masked.select("seq", F.col("c")["email"].alias("email"), F.col("c")["props"].alias("props"))


@query("SELECT conv_id, turn, f.field, f.classification, f.strategy FROM conversations, (VALUES ('email', 'PII', 'HASH'), ('diagnosis', 'PHI', 'HMAC')) f(field, classification, strategy)")
def mask_audit(spark, d):
    c = read(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("email"), F.col("text").alias("diagnosis"))
    return masking.audit(c, RULES, ["conv_id", "turn"])


@query("SELECT name, CASE WHEN lower(name) SIMILAR TO '.*(medical_record_number|patient_id|diagnosis|prescription).*' THEN 'phi_token' WHEN lower(name) SIMILAR TO '.*(email|phone|ssn|credit_card|address).*' THEN 'pii_hash' ELSE 'none' END AS strategy FROM (VALUES ('email'), ('IP_Address'), ('className'), ('patient_id_email'), ('age'), ('created_at'), ('Diagnosis'), ('ssn'), ('city')) t(name)")
def classify_fields(spark, d):
    names = ["email", "IP_Address", "className", "patient_id_email", "age", "created_at", "Diagnosis", "ssn", "city"]
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn("strategy", RULES.classified(F.col("name")))


@query("SELECT name, CASE name WHEN 'email' THEN 'none' WHEN 'city' THEN 'phi_token' WHEN 'Nickname' THEN 'pii_hash' WHEN 'blood_type' THEN 'phi_token' ELSE 'none' END AS strategy FROM (VALUES ('email'), ('city'), ('Nickname'), ('blood_type'), ('age')) t(name)")
def masking_rules_from_file(spark, d):
    """Parts of names from a YAML file, and strategies by column."""
    with tempfile.NamedTemporaryFile("w", suffix=".yaml") as f:
        f.write("pii_fields: [email, nickname]\nphi_fields: [blood_type]\n")
        f.flush()
        rules = masking.Rules.load(f.name, key=KEY, strategies={"email": "passthrough", "city": "tokenize"})
    return spark.createDataFrame([(n, rules.classify(n)) for n in ("email", "city", "Nickname", "blood_type", "age")], "name string, strategy string")


@query(f"SELECT c_custkey, c_name AS email, {_hmac_sql('c_mktsegment')} AS city, sha256('salt' || c_phone) AS phone FROM (SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_phone FROM customer)")
def mask_by_strategy(spark, d):
    """Overrides by column: passed through, a token, and a salted digest."""
    rules = masking.Rules(key=KEY, salt="salt", strategies={"email": "passthrough", "city": "tokenize"})
    c = read(spark, d, "customer")
    return masking.mask(c.select("c_custkey", F.col("c_name").alias("email"), F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("string").alias("phone")), rules)


# Offsets and accounting

_BATCH = f"{LOG}, n AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY user_id % 8 ORDER BY seq) - 1) / 100) AS BIGINT) AS batch_id, user_id % 8 AS partition_id FROM log), b AS (SELECT partition_id, batch_id, count(*) AS events, max(seq) AS last_position, max(ts_us) AS last_ts_us FROM n GROUP BY 1, 2)"


def _batches(spark, d) -> DataFrame:
    numbered = offsets.batches(log(spark, d).withColumn("partition_id", F.col("user_id") % 8), 100, "seq", ["partition_id"])
    return offsets.batch_offsets(numbered, ["partition_id"], "seq", "ts_us")


@query(f"WITH {_BATCH} SELECT * FROM b")
def batch_offsets(spark, d):
    return _batches(spark, d)


@query(f"WITH {_BATCH} SELECT partition_id, batch_id, events, CAST(sum(events) OVER (PARTITION BY partition_id ORDER BY batch_id) AS BIGINT) AS events_replicated FROM b")
def offsets_cumulative(spark, d):
    return offsets.cumulative(_batches(spark, d), ["partition_id"]).select("partition_id", "batch_id", "events", "events_replicated")


@query(f"WITH {_BATCH}, m AS (SELECT *, CASE partition_id % 3 WHEN 0 THEN 'POSTGRES' WHEN 1 THEN 'CLICKHOUSE' ELSE 'TIMESCALEDB' END AS destination FROM b) SELECT destination, max(last_position) AS last_position, arg_max(last_ts_us, last_position) AS last_ts_us FROM m GROUP BY 1")
def latest_offset_per_destination(spark, d):
    to = F.element_at(F.array(*map(F.lit, DESTINATIONS)), (F.col("partition_id") % 3 + 1).cast("int"))
    return offsets.latest(_batches(spark, d).select(to.alias("destination"), "last_position", "last_ts_us"), ["destination"], "last_position")


def _offsets(spark, d) -> DataFrame:
    """An offset of each partition, committed at its last event's time."""
    last = log(spark, d).groupBy((F.col("user_id") % 8).alias("partition_id")).agg(F.max("seq").alias("commitlog_position"), F.max("ts_us").alias("last_event_timestamp_micros"), F.count("*").alias("events")).withColumn("commitlog_file", F.lit("CommitLog-7-1.log"))
    return offsets.create(last, "users", "ecommerce", "POSTGRES", count=None).withColumn("last_committed_at", F.timestamp_micros("last_event_timestamp_micros"))


_OFFSETS = f"{LOG}, o AS (SELECT user_id % 8 AS partition_id, max(seq) AS commitlog_position, max(ts_us) AS last_event_timestamp_micros, count(*) AS events_replicated_count FROM log GROUP BY 1)"


@query(f"WITH {_OFFSETS} SELECT partition_id, 'POSTGRES' AS destination, commitlog_position, last_event_timestamp_micros, events_replicated_count, 36 AS id_length FROM o")
def create_offsets(spark, d):
    """New offsets, each with an id of its own."""
    return _offsets(spark, d).select("partition_id", "destination", "commitlog_position", "last_event_timestamp_micros", "events_replicated_count", F.length("offset_id").alias("id_length"))


@query(f"WITH {_OFFSETS} SELECT partition_id, commitlog_position FROM o WHERE partition_id = 3")
def read_offset(spark, d):
    held = _offsets(spark, d)
    none = offsets.read(held, "users", "ecommerce", 3, "CLICKHOUSE")
    return offsets.read(held, "users", "ecommerce", 3, "POSTGRES").union(none).select("partition_id", "commitlog_position")


@query(f"WITH {LOG} SELECT seq FROM log WHERE ts_us >= {NOW} - 7 * 86400000000")
def offset_cleanup(spark, d):
    """Offsets of the last seven days stay."""
    rows = log(spark, d).select("seq", F.timestamp_micros("ts_us").alias("last_committed_at"))
    return offsets.clean(rows, F.timestamp_micros(F.lit(NOW))).select("seq")


@query(f"WITH {LOG}, v AS (SELECT seq, array_to_string(list_filter([CASE WHEN seq % 13 = 0 THEN 'position' END, CASE WHEN seq % 17 = 0 THEN 'timestamp' END, CASE WHEN seq % 19 = 0 THEN 'count' END, CASE WHEN ts_us > {NOW} THEN 'committed_at' END, CASE WHEN seq % 23 = 0 THEN 'commitlog_file' END], lambda x: x IS NOT NULL), ',') AS violations FROM log) SELECT * FROM v WHERE violations <> ''")
def offset_contract(spark, d):
    n = F.col("seq")
    rows = log(spark, d).select(
        "seq", F.when(n % 13 == 0, -1).otherwise(n).alias("commitlog_position"), F.when(n % 17 == 0, -5).otherwise(F.col("ts_us")).alias("last_event_timestamp_micros"), F.when(n % 19 == 0, None).otherwise(1).alias("events_replicated_count"),
        F.timestamp_micros("ts_us").alias("last_committed_at"), F.when(n % 23 == 0, "CommitLog-7.log").otherwise("CommitLog-7-12.log").alias("commitlog_file"),
    )
    return rows.select("seq", F.array_join(quality.offset_violations(F.timestamp_micros(F.lit(NOW))), ",").alias("violations")).filter("violations <> ''")


@query(f"WITH {_BATCH}, f AS (SELECT CASE partition_id % 3 WHEN 0 THEN 'POSTGRES' WHEN 1 THEN 'CLICKHOUSE' ELSE 'TIMESCALEDB' END AS destination, batch_id, events, batch_id % 4 = 3 AS failed, last_ts_us FROM b), s AS (SELECT destination, CAST(coalesce(sum(events) FILTER (WHERE NOT failed), 0) AS BIGINT) AS events_written, count(*) FILTER (WHERE failed) AS errors_count, max(batch_id) FILTER (WHERE failed) AS last_error_batch, CAST(max(last_ts_us) FILTER (WHERE NOT failed) - min(last_ts_us) FILTER (WHERE NOT failed) AS DOUBLE) / 1000000.0::DOUBLE AS seconds FROM f GROUP BY 1) SELECT destination, events_written, errors_count, last_error_batch, round(CAST(events_written AS DOUBLE) / seconds, 9) AS events_per_second FROM s")
def sink_statistics(spark, d):
    to = F.element_at(F.array(*map(F.lit, DESTINATIONS)), (F.col("partition_id") % 3 + 1).cast("int"))
    written = _batches(spark, d).select(to.alias("destination"), "batch_id", "events", (F.col("batch_id") % 4 == 3).alias("failed"), F.col("last_ts_us").alias("at_us"))
    return accounting.sink_statistics(written).withColumn("events_per_second", F.round("events_per_second", 9))


@query(f"WITH {LOG}, t AS (SELECT user_id, max(ts_us) AS deleted_us FROM log WHERE op = 'DELETE' GROUP BY 1) SELECT user_id, deleted_us FROM t WHERE deleted_us + 864000000000 > {NOW}")
def tombstone_expiry(spark, d):
    """Tombstones whose ten days of grace aren't over."""
    return fold.expire(fold.tombstones(log(spark, d), ["user_id"], "ts_us").withColumnRenamed("deleted_at", "deleted_us"), NOW).select("user_id", "deleted_us")


@query(f"WITH {LOG}, j AS (SELECT seq, user_id, ts_us - CASE WHEN seq % 11 = 0 THEN 172800000000 ELSE 0 END AS t FROM log), p AS (SELECT *, lag(t) OVER (PARTITION BY user_id ORDER BY seq) AS previous_ts_us FROM j) SELECT user_id, seq, t, previous_ts_us FROM p WHERE t < previous_ts_us")
def offset_monotonic_violations(spark, d):
    jittered = log(spark, d).select("seq", "user_id", (F.col("ts_us") - F.when(F.col("seq") % 11 == 0, F.lit(172_800_000_000)).otherwise(0)).alias("t"))
    return offsets.backward(jittered, ["user_id"], "seq", "t").select("user_id", "seq", "t", "previous_ts_us")


@query("SELECT event_id AS position, user_id % 3 AS destination_no FROM events WHERE user_id % 3 = 2 OR event_id // 1000 > CASE user_id % 3 WHEN 0 THEN 0 ELSE 1 END OR (event_id // 1000 = CASE user_id % 3 WHEN 0 THEN 0 ELSE 1 END AND event_id > CASE user_id % 3 WHEN 0 THEN 500 ELSE 1200 END)")
def offset_resume(spark, d):
    rows = read(spark, d, "events").select(F.floor(F.col("event_id") / 1000).cast("bigint").alias("file_no"), F.col("event_id").alias("position"), (F.col("user_id") % 3).alias("destination_no"))
    held = spark.createDataFrame([(0, 0, 500), (1, 1, 1200)], "destination_no bigint, last_file_no bigint, last_position bigint")
    return offsets.resume(rows, held, ["destination_no"]).select("position", "destination_no")


@query(f"""WITH {LOG}, e AS (SELECT user_id % 8 AS partition_id, seq % 2 AS fresh, max(ts_us) AS t, count(*) AS n FROM log GROUP BY 1, 2), h AS (SELECT * FROM e WHERE fresh = 0), f AS (SELECT * FROM e WHERE fresh = 1)
SELECT partition_id, greatest(h.t, f.t) AS last_event_timestamp_micros, CAST(h.n + CASE WHEN f.t >= h.t THEN f.n ELSE 0 END AS BIGINT) AS events_replicated_count FROM h JOIN f USING (partition_id)""")
def offset_upsert(spark, d):
    e = log(spark, d).groupBy((F.col("user_id") % 8).alias("partition_id"), (F.col("seq") % 2).alias("fresh")).agg(F.max("ts_us").alias("last_event_timestamp_micros"), F.count("*").alias("events_replicated_count"))
    e = e.withColumns({"table_name": F.lit("users"), "keyspace": F.lit("ecommerce"), "destination": F.lit("POSTGRES")})
    return offsets.upsert(e.filter("fresh = 0").drop("fresh"), e.filter("fresh = 1").drop("fresh")).select("partition_id", "last_event_timestamp_micros", "events_replicated_count")


@query(f"WITH {LOG} SELECT user_id % 3 AS destination_no, max(ts_us) AS last_ts_us, greatest(0.0::DOUBLE, (CAST({NOW} AS DOUBLE) - CAST(max(ts_us) AS DOUBLE)) / CAST(1000000 AS DOUBLE)) AS lag_s FROM log GROUP BY 1")
def replication_lag(spark, d):
    last = log(spark, d).groupBy((F.col("user_id") % 3).alias("destination_no")).agg(F.max("ts_us").alias("last_ts_us"))
    return last.withColumn("lag_s", scalar.replication_lag(F.lit(NOW), F.col("last_ts_us")))


_LAGS = f"{LOG}, g AS (SELECT event_type, (ts_us // 1000) % 5000 AS lag_ms FROM log)"


@query(f"WITH {_LAGS}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY lag_ms) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM g) SELECT event_type, max(lag_ms) FILTER (WHERE i = floor(n * 0.5::DOUBLE)) AS p50, max(lag_ms) FILTER (WHERE i = floor(n * 0.95::DOUBLE)) AS p95, max(lag_ms) FILTER (WHERE i = floor(n * 0.99::DOUBLE)) AS p99 FROM r GROUP BY 1")
def lag_percentiles(spark, d):
    g = log(spark, d).select("event_type", (F.floor(F.col("ts_us") / 1000) % 5000).cast("bigint").alias("lag_ms"))
    return accounting.nearest_rank(g, "lag_ms", ["event_type"], {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("WITH g AS (SELECT event_type, CAST(event_id % 12000 AS DOUBLE) / 1000 AS s FROM events), k AS (SELECT * FROM (VALUES ('0.001', 0.001::DOUBLE), ('0.01', 0.01::DOUBLE), ('0.1', 0.1::DOUBLE), ('0.5', 0.5::DOUBLE), ('1.0', 1.0::DOUBLE), ('2.5', 2.5::DOUBLE), ('5.0', 5.0::DOUBLE), ('10.0', 10.0::DOUBLE), ('+Inf', 'inf'::DOUBLE)) t(le, b)) SELECT event_type, le, count(*) FILTER (WHERE s <= b) AS n FROM g, k GROUP BY 1, 2")
def duration_histogram(spark, d):
    return accounting.histogram(read(spark, d, "events"), (F.col("event_id") % 12000).cast("double") / 1000, ["event_type"])


@query(f"WITH {_BATCH}, s AS (SELECT partition_id, batch_id, CAST(events AS DOUBLE) / (CAST(last_ts_us - lag(last_ts_us) OVER (PARTITION BY partition_id ORDER BY batch_id) AS DOUBLE) / 1000000.0::DOUBLE) AS rate, last_ts_us - lag(last_ts_us) OVER (PARTITION BY partition_id ORDER BY batch_id) AS gap FROM b), f AS (SELECT * FROM s WHERE gap > 0) SELECT partition_id, batch_id, round(avg(rate) OVER (PARTITION BY partition_id ORDER BY batch_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 9) AS moving_rate FROM f")
def throughput_moving_avg(spark, d):
    return accounting.moving_rate(_batches(spark, d), "events", "last_ts_us", ["partition_id"]).select("partition_id", "batch_id", F.round("moving_rate", 9).alias("moving_rate"))


@query(f"WITH {LOG}, c AS (SELECT user_id % 3 AS destination_no, count(*) AS captured, count(*) FILTER (WHERE op <> 'DELETE') AS committed FROM log GROUP BY 1) SELECT destination_no, captured - committed AS backlog FROM c")
def backlog_depth(spark, d):
    rows = log(spark, d).withColumn("destination_no", F.col("user_id") % 3)
    done = rows.filter("op <> 'DELETE'").groupBy("destination_no", "op").agg(F.count("*").alias("events"))
    return accounting.backlog(rows, done, ["destination_no"])


@query("SELECT event_type, user_id % 2 AS shard, bool_and(value < 400) AS healthy, count(*) AS dependencies FROM events GROUP BY 1, 2")
def health_rollup(spark, d):
    checks = read(spark, d, "events").select("event_type", (F.col("user_id") % 2).alias("shard"), F.when(F.col("value") < 400, "up").otherwise("down").alias("status"))
    return accounting.rollup_health(checks, ["event_type", "shard"])


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'unhealthy' WHEN event_id % 2000 > 1000 THEN 'degraded' ELSE 'healthy' END AS health FROM events")
def sink_health(spark, d):
    return read(spark, d, "events").select("event_id", scalar.sink_health(F.col("event_type") != "error", F.col("event_id") % 2000).alias("health"))


@query("SELECT CAST(a AS INTEGER) AS attempt, least(1.0::DOUBLE * pow(2.0::DOUBLE, a - 1), 60.0::DOUBLE) AS wait_s FROM range(1, 13) t(a)")
def backoff_schedule(spark, d):
    return spark.range(1, 13).select(F.col("id").cast("int").alias("attempt"), scalar.backoff(F.col("id")).alias("wait_s"))


@query("SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS chunk_start, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def hypertable_chunks(spark, d):
    rows = accounting.chunks(read(spark, d, "lineitem").select("l_shipdate", "l_quantity"), "l_shipdate")
    return rows.groupBy(F.to_date("chunk_start").alias("chunk_start")).agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


# Quality and dead letters

def _dirty(spark, d) -> DataFrame:
    """Generic events, some of which break each rule."""
    e = adapters.generic_events(log(spark, d))
    n = F.col("event_id").cast("bigint")
    none = F.create_map().cast("map<string,string>")
    return e.withColumns({
        "timestamp_micros": F.when(n % 13 == 0, 0).otherwise(F.col("timestamp_micros")), "partition_key": F.when(n % 17 == 0, none).otherwise(F.col("partition_key")), "columns": F.when(n % 19 == 0, none).otherwise(F.col("columns")),
        "keyspace": F.when(n % 23 == 0, "Bad-Name").otherwise(F.col("keyspace")), "ttl_seconds": F.when(n % 29 == 0, -1).cast("int"),
    })


_RULES = """list_filter([CASE WHEN seq % 13 = 0 THEN 'timestamp' END, CASE WHEN seq % 17 = 0 THEN 'partition_key' END, CASE WHEN op <> 'DELETE' AND seq % 19 = 0 THEN 'columns' END, CASE WHEN seq % 23 = 0 THEN 'keyspace' END, CASE WHEN seq % 29 = 0 THEN 'ttl' END], lambda x: x IS NOT NULL)"""


@query(f"WITH {LOG}, v AS (SELECT CAST(seq AS VARCHAR) AS event_id, array_to_string({_RULES}, ',') AS violations FROM log) SELECT * FROM v WHERE violations <> ''")
def contract_violations(spark, d):
    now = F.timestamp_micros(F.lit(NOW))
    return quality.split(_dirty(spark, d), quality.event_violations(now=now))[1].select("event_id", F.array_join("violations", ",").alias("violations"))


@query(f"WITH {LOG} SELECT CAST(seq AS VARCHAR) AS event_id, concat_ws(',', CASE WHEN has_value AND try_cast(CASE WHEN seq % 5 = 0 THEN 'x' ELSE CAST(seq AS VARCHAR) END AS BIGINT) IS NULL THEN 'value' END, CASE WHEN seq % 7 = 0 THEN 'flag' END) AS columns FROM log WHERE (has_value AND seq % 5 = 0) OR seq % 7 = 0")
def type_mismatches(spark, d):
    rows = log(spark, d).select(F.col("seq").cast("string").alias("event_id"), F.create_map(F.lit("value"), F.when(F.col("has_value"), F.when(F.col("seq") % 5 == 0, "x").otherwise(F.col("seq").cast("string"))), F.lit("flag"), F.when(F.col("seq") % 7 == 0, "maybe").otherwise("true"), F.lit("note"), F.lit("any")).alias("columns"))
    return rows.select("event_id", F.array_join(quality.mismatches({"value": "varint", "flag": "boolean", "note": "list<text>"}), ",").alias("columns")).filter("columns <> ''")


@query(f"WITH {LOG} SELECT CAST(seq AS VARCHAR) AS event_id, 'props' AS unknown FROM log WHERE has_props AND op <> 'DELETE'")
def unknown_columns(spark, d):
    e = adapters.generic_events(log(spark, d))
    return e.select("event_id", F.array_join(quality.unknown_columns(["user_id", "value"]), ",").alias("unknown")).filter("unknown <> ''")


@query(f"WITH {LOG} SELECT CAST(seq AS VARCHAR) AS event_id, 'user_id' AS missing FROM log WHERE seq % 17 = 0")
def missing_partition_key(spark, d):
    return _dirty(spark, d).select("event_id", F.array_join(quality.missing_keys(["user_id"]), ",").alias("missing")).filter("missing <> ''")


_DEAD = f"WITH {LOG}, v AS (SELECT *, array_to_string({_RULES}, ',') AS violations FROM log)"


@query(f"{_DEAD} SELECT CAST(seq AS VARCHAR) AS event_id, op AS event_type, 'POSTGRES' AS destination, 'contract_violation' AS error_type, violations AS error_message FROM v WHERE violations <> ''")
def dlq_rows(spark, d):
    """Through the JSON store and back."""
    now = F.timestamp_micros(F.lit(NOW))
    bad = quality.split(_dirty(spark, d), quality.event_violations(now=now))[1]
    store = sinks.DeadLetterSink("DLQ", shared(spark, "dlq"))
    store.write_batch(quality.dead_letters(bad, "POSTGRES", "contract_violation", F.array_join("violations", ","), now).drop("violations"), 0)
    return store.read(spark).select("event_id", "event_type", "destination", "error_type", "error_message")


@query(f"{_DEAD} SELECT CASE seq % 3 WHEN 0 THEN 'POSTGRES' WHEN 1 THEN 'CLICKHOUSE' ELSE 'TIMESCALEDB' END AS destination, op AS error_type, count(*) AS n FROM v WHERE violations <> '' GROUP BY 1, 2")
def dlq_counts(spark, d):
    bad = quality.split(_dirty(spark, d), quality.event_violations(now=F.timestamp_micros(F.lit(NOW))))[1]
    to = F.element_at(F.array(*map(F.lit, DESTINATIONS)), (F.col("event_id").cast("bigint") % 3 + 1).cast("int"))
    return bad.groupBy(to.alias("destination"), F.col("event_type").alias("error_type")).agg(F.count("*").alias("n"))


@query("WITH m AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Connection refused' WHEN 1 THEN 'permission denied for table' WHEN 2 THEN 'invalid connection string' WHEN 3 THEN 'Syntax error at 1' ELSE 'disk full' END AS message FROM events) SELECT event_id, regexp_matches(lower(message), 'connection|timeout|temporary|unavailable|network|unreachable|refused|reset|broken pipe') OR NOT regexp_matches(lower(message), 'permission denied|authentication failed|syntax error|invalid|does not exist') AS retryable FROM m")
def retryable_errors(spark, d):
    texts = F.array(*map(F.lit, ("Connection refused", "permission denied for table", "invalid connection string", "Syntax error at 1", "disk full")))
    return read(spark, d, "events").select("event_id", scalar.is_retryable(F.element_at(texts, (F.col("event_id") % 5 + 1).cast("int"))).alias("retryable"))


# Types and schemas

_CQL = ("UUID", "text", "Int", "DECIMAL", "frozen<address>", "TUPLE<int,text>", "counter", "MAP<TEXT,INT>", "MAP", "duration", "timestamp")
_CQL_VALUES = ", ".join(f"('{c}')" for c in _CQL)
#: Fixed values, written out again so that the queries' SQL doesn't read the map that it checks: type, row store, column store.
_TYPES_SQL = """m AS (SELECT t.target, x.cql_type, CASE t.target WHEN 'CLICKHOUSE' THEN x.c ELSE x.r END AS mapped FROM (VALUES ('POSTGRES'), ('TIMESCALEDB'), ('CLICKHOUSE')) t(target), (VALUES
 ('UUID', 'uuid', 'UUID'), ('TEXT', 'text', 'String'), ('VARCHAR', 'varchar', 'String'), ('INT', 'integer', 'Int32'), ('BIGINT', 'bigint', 'Int64'), ('FLOAT', 'real', 'Float32'), ('DOUBLE', 'double precision', 'Float64'), ('DECIMAL', 'numeric', 'Decimal(18, 2)'), ('BOOLEAN', 'boolean', 'UInt8'),
 ('TIMESTAMP', 'timestamptz', 'DateTime64(3)'), ('DATE', 'date', 'Date'), ('TIME', 'time', 'String'), ('BLOB', 'bytea', 'String'), ('MAP', 'jsonb', 'String'), ('LIST', 'jsonb', 'String'), ('SET', 'jsonb', 'String'), ('TUPLE', 'jsonb', 'String'), ('UDT', 'jsonb', 'String')) x(cql_type, r, c))"""


@query(f"WITH {_TYPES_SQL} SELECT target, cql_type, mapped FROM m")
def type_map_all_targets(spark, d):
    return typemap.table(spark).select("target", "cql_type", "mapped")


@query(f"WITH {_TYPES_SQL}, c AS (SELECT * FROM (VALUES {_CQL_VALUES}) t(cql_type)), t AS (SELECT DISTINCT target FROM m) SELECT t.target, c.cql_type, coalesce(m.mapped, CASE t.target WHEN 'CLICKHOUSE' THEN 'String' ELSE 'text' END) AS mapped, m.mapped IS NULL OR regexp_matches(upper(c.cql_type), 'FROZEN<|TUPLE<|COUNTER') AS incompatible FROM c CROSS JOIN t LEFT JOIN m ON m.target = t.target AND m.cql_type = upper(c.cql_type)")
def incompatible_columns(spark, d):
    c = spark.createDataFrame([(x,) for x in _CQL], "cql_type string")
    rows = [c.select(F.lit(t).alias("target"), "cql_type", typemap.map_column(F.col("cql_type"), t).alias("mapped"), typemap.incompatible(F.col("cql_type"), t).alias("incompatible")) for t in typemap.TARGETS]
    return rows[0].union(rows[1]).union(rows[2])


_OLD, _NEW = {"id": "uuid", "age": "int", "name": "text", "city": "text", "score": "float", "tag": "TEXT"}, {"id": "uuid", "age": "bigint", "name": "int", "score": "double", "tag": "text", "email": "text"}
_values = lambda x: ", ".join(f"('{k}', '{v}')" for k, v in x.items())
_WIDE = "lower(old_type) || '>' || lower(new_type) IN ('int>bigint', 'float>double', 'decimal>double', 'text>varchar', 'varchar>text')"


@query(f"WITH o AS (SELECT * FROM (VALUES {_values(_OLD)}) t(column_name, old_type)), n AS (SELECT * FROM (VALUES {_values(_NEW)}) t(column_name, new_type)), j AS (SELECT *, CASE WHEN old_type IS NULL THEN 'ADD_COLUMN' WHEN new_type IS NULL THEN 'DROP_COLUMN' WHEN lower(old_type) <> lower(new_type) THEN 'ALTER_TYPE' END AS change_type FROM o FULL JOIN n USING (column_name)) SELECT column_name, old_type, new_type, change_type, CASE WHEN change_type = 'ALTER_TYPE' THEN {_WIDE} ELSE true END AS is_compatible FROM j WHERE change_type IS NOT NULL")
def schema_diff(spark, d):
    old, new = (spark.createDataFrame(list(x.items()), "column_name string, cql_type string") for x in (_OLD, _NEW))
    return evolution.diff(old, new).select("column_name", "old_type", "new_type", "change_type", "is_compatible")


_KINDS = ("int", "bigint", "float", "double", "decimal", "text", "varchar", "uuid")


@query(f"WITH k AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{x}{chr(39)})' for x in _KINDS)}) t(x)), p AS (SELECT a.x AS old_type, b.x AS new_type FROM k a, k b WHERE a.x <> b.x) SELECT old_type, new_type, {_WIDE} AS is_compatible FROM p")
def schema_compat_matrix(spark, d):
    pairs = [(a, b) for a in _KINDS for b in _KINDS if a != b]
    return spark.createDataFrame(pairs, "old_type string, new_type string").withColumn("is_compatible", evolution.compatible(F.col("old_type"), F.col("new_type")))


@query(f"""WITH {_TYPES_SQL}, s AS (SELECT * FROM (VALUES ('id', 'uuid'), ('age', 'int'), ('name', 'text')) t(column_name, old_type)), g AS (SELECT * FROM (VALUES (1, 'age', 'bigint'), (2, 'city', 'varchar'), (3, 'name', NULL), (4, 'age', 'frozen<x>')) t(change, column_name, new_type)),
 a AS (SELECT g.change, coalesce(s.column_name, g.column_name) AS column_name, s.old_type, g.new_type, s.column_name IS NOT DISTINCT FROM g.column_name OR s.column_name IS NULL AS touched FROM g, s UNION ALL SELECT change, column_name, NULL, new_type, true FROM g WHERE column_name NOT IN (SELECT column_name FROM s))
SELECT a.change, t.target, a.column_name, coalesce(m.mapped, CASE t.target WHEN 'CLICKHOUSE' THEN 'String' ELSE 'text' END) AS mapped FROM a CROSS JOIN (SELECT DISTINCT target FROM m) t LEFT JOIN m ON m.target = t.target AND m.cql_type = upper(CASE WHEN touched THEN new_type ELSE old_type END) WHERE NOT (touched AND new_type IS NULL)""")
def apply_schema_change(spark, d):
    schema = evolution.TableSchema.create_initial("shop", "users", {"id": "uuid", "age": "int", "name": "text"}, ("id",))
    changes = [evolution.Change("ALTER_TYPE", "age", "int", "bigint"), evolution.Change("ADD_COLUMN", "city", None, "varchar"), evolution.Change("DROP_COLUMN", "name", "text"), evolution.Change("ALTER_TYPE", "age", "int", "frozen<x>")]
    rows = [(i + 1, t, c, m) for i, change in enumerate(changes) for t in typemap.TARGETS for c, m in evolution.apply(schema, change, t).items()]
    return spark.createDataFrame(rows, "change int, target string, column_name string, mapped string")


@query("SELECT * FROM (VALUES ('CLICKHOUSE', 'a', 'f,t'), ('CLICKHOUSE', 'b', ''), ('POSTGRES', 'a', 'f,t'), ('POSTGRES', 'b', ''), ('TIMESCALEDB', 'a', 'f,t'), ('TIMESCALEDB', 'b', '')) t(target, table_name, columns)")
def incompatible_by_schema(spark, d):
    rows = [("shop", "a", "id", "uuid"), ("shop", "a", "t", "tuple<int,int>"), ("shop", "a", "f", "frozen<x>"), ("shop", "b", "id", "uuid"), ("shop", "b", "m", "map")]
    schemas = spark.createDataFrame(rows, "keyspace string, table_name string, column_name string, cql_type string")
    parts = [typemap.incompatible_of(schemas, t).select(F.lit(t).alias("target"), "table_name", F.array_join("columns", ",").alias("columns")) for t in typemap.TARGETS]
    return parts[0].union(parts[1]).union(parts[2])


@query(f"WITH {_TYPES_SQL} SELECT cql_type, CASE cql_type WHEN 'TIMESTAMP' THEN 'timestamptz(3)' WHEN 'LIST' THEN 'text[]' ELSE mapped END AS mapped FROM m WHERE target = 'POSTGRES'")
def type_map_overlay(spark, d):
    """A destination's own names over those of another."""
    found = typemap.overlay(typemap.ROW_STORE, {"TIMESTAMP": "timestamptz(3)", "LIST": "text[]"})
    return spark.createDataFrame(list(found.items()), "cql_type string, mapped string")


@query("SELECT * FROM (VALUES (1, true, ''), (2, false, 'v'), (3, false, 'id,v'), (4, true, ''), (5, false, 'id')) t(pair, compatible, columns)")
def schema_pairs(spark, d):
    """Pairs of schemas: equal; a narrowed column; another key and a narrowed column; widened and added; a new key."""
    make = evolution.TableSchema.create_initial
    base = make("shop", "users", {"id": "uuid", "v": "int", "w": "text"}, ("w",), ("id",))
    others = (base, base.evolve({"id": "uuid", "v": "text", "w": "text"}), make("shop", "users", {"id": "uuid", "v": "text", "w": "text"}, ("w",)), base.evolve({"id": "uuid", "v": "bigint", "w": "varchar", "x": "int"}), make("shop", "users", {"id": "uuid", "v": "int", "w": "text"}, ("w",)))
    found = [evolution.incompatible(base, x) for x in others]
    return spark.createDataFrame([(i + 1, not x, ",".join(sorted({c.column_name for c in x}))) for i, x in enumerate(found)], "pair int, compatible boolean, columns string")


@query("SELECT t.target, c.name, c.ok AND (c.target IS NULL OR c.target = t.target) AS supported FROM (VALUES ('POSTGRES'), ('CLICKHOUSE'), ('TIMESCALEDB')) t(target), (VALUES ('add_known', true, NULL), ('add_unknown', false, NULL), ('widen', true, NULL), ('narrow', false, NULL), ('drop', true, NULL)) c(name, ok, target)")
def supported_changes(spark, d):
    changes = {"add_known": evolution.Change("ADD_COLUMN", "x", None, "varchar"), "add_unknown": evolution.Change("ADD_COLUMN", "x", None, "duration"), "widen": evolution.Change("ALTER_TYPE", "x", "int", "bigint"), "narrow": evolution.Change("ALTER_TYPE", "x", "bigint", "int"), "drop": evolution.Change("DROP_COLUMN", "x", "duration")}
    return spark.createDataFrame([(t, n, evolution.supported(c, t)) for t in typemap.TARGETS for n, c in changes.items()], "target string, name string, supported boolean")


def _registry() -> evolution.Registry:
    """Three tables with later versions: a widened type; a narrowed one; a renamed column, and a narrowed one with an override."""
    found = evolution.Registry()
    first = [evolution.TableSchema.create_initial("shop", t, {"id": "uuid", "v": "int", "w": "text"}, ("id",)) for t in ("a", "b", "c")]
    for x in (*first, first[0].evolve({"id": "uuid", "v": "bigint", "w": "text"}), first[1].evolve({"id": "uuid", "v": "text", "w": "text"}), first[2].evolve({"id": "uuid", "v": "float", "x": "text"})):
        found.register(x)
    found.overrides["shop.c", "v"] = lambda c: c.cast("int")
    return found


@query("SELECT * FROM (VALUES ('shop.a', 2, 'ALTER_TYPE', 'v', 'int', 'bigint', true), ('shop.b', 2, 'ALTER_TYPE', 'v', 'int', 'text', false), ('shop.c', 2, 'ADD_COLUMN', 'x', NULL, 'text', true), ('shop.c', 2, 'ALTER_TYPE', 'v', 'int', 'float', false), ('shop.c', 2, 'DROP_COLUMN', 'w', 'text', NULL, true)) t(table_name, version, change_type, column_name, old_type, new_type, compatible)")
def schema_audit(spark, d):
    return _registry().audit(spark)


@query(f"WITH {LOG}, t AS (SELECT seq, chr(CAST(97 + user_id % 3 AS INTEGER)) AS table_name FROM log) SELECT seq, table_name, table_name = 'b' AS dead FROM t")
def route_by_policy(spark, d):
    """Events of a table with an incompatible change go off, unless it is overridden; others go on."""
    events = log(spark, d).select("seq", F.lit("shop").alias("keyspace"), F.chr(F.col("user_id") % 3 + 97).alias("table_name"))
    good, bad = _registry().route(events)
    return good.withColumn("dead", F.lit(False)).union(bad.withColumn("dead", F.lit(True))).select("seq", "table_name", "dead")


@query(f"WITH {LOG} SELECT seq, user_id AS customer_id, value AS amount FROM log")
def rename_columns(spark, d):
    return evolution.rename(log(spark, d).select("seq", "user_id", "value"), {"user_id": "customer_id", "value": "amount", "none": "other"})


@query("SELECT * FROM (VALUES (1, NULL, 2, true), (2, 1, 3, false), (5, 1, 2, true)) t(version, previous, columns, as_first)")
def schema_versions(spark, d):
    first = evolution.TableSchema.create_initial("shop", "users", {"id": "uuid", "v": "int"}, ("id",))
    found = (first, first.evolve({**first.columns, "w": "text"}), first.with_version(5))
    return spark.createDataFrame([(x.version, x.previous, len(x.columns), x.fingerprint() == first.fingerprint()) for x in found], "version int, previous int, columns int, as_first boolean")


@query(f"WITH {LOG} SELECT seq, CAST(value * 100 AS BIGINT) AS n, CAST(value AS DOUBLE) AS f, ts_us AS at, has_value AS b, CAST(user_id AS VARCHAR) AS id, CAST(day AS DATE) AS day FROM log")
def convert_values(spark, d):
    """Text cells as their types."""
    cells = log(spark, d).select("seq", F.round(F.col("value") * 100).cast("bigint").cast("string").alias("n"), F.col("value").cast("string").alias("f"), F.col("ts_us").cast("string").alias("at"), F.col("has_value").cast("string").alias("b"), F.col("user_id").cast("string").alias("id"), F.col("day").cast("string").alias("day"))
    kinds = {"n": "BIGINT", "f": "DOUBLE", "at": "TIMESTAMP", "b": "BOOLEAN", "id": "UUID", "day": "DATE"}
    return cells.select("seq", *[typemap.convert(F.col(c), t).alias(c) for c, t in kinds.items()])


@query(f"WITH {LOG} SELECT seq, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN op <> 'DELETE' AND has_props THEN props END AS props, 1 + CAST((op <> 'DELETE' AND has_value) AS INTEGER) + CAST((op <> 'DELETE' AND has_props) AS INTEGER) AS cells FROM log")
def project_rows(spark, d):
    e = adapters.generic_events(log(spark, d)).select(F.col("event_id").cast("bigint").alias("seq"), fold.project_row().alias("m"))
    return e.select("seq", F.col("m")["user_id"].alias("user_id"), F.col("m")["props"].alias("props"), F.size("m").alias("cells"))


# Sources, sinks and streams

@query(f"WITH {LOG} SELECT op AS event_type, CAST(user_id AS VARCHAR) AS user_id, ts_us AS timestamp_micros, CASE WHEN op <> 'DELETE' AND has_props THEN props END AS props, CAST((op <> 'DELETE' AND has_value) AS INTEGER) + CAST((op <> 'DELETE' AND has_props) AS INTEGER) AS cells FROM log")
def commitlog_roundtrip(spark, d):
    """The change log as segment files, read back."""
    folder = shared(spark, "segments")
    rows = adapters.generic_events(log(spark, d)).withColumn("seq", F.col("event_id").cast("bigint"))
    rows = rows.withColumn("commitlog_file", F.concat(F.lit("CommitLog-7-"), F.floor(F.col("seq") / 2000).cast("string"), F.lit(".log")))
    commitlog.write_segments(rows, mounted(folder))
    good, _ = commitlog.read_events(spark, folder, "ecommerce", "users")
    return good.select("event_type", F.col("partition_key")["user_id"].alias("user_id"), "timestamp_micros", F.col("columns")["props"].alias("props"), F.size("columns").alias("cells"))


@query(_FOLD)
def stream_upsert_fold(spark, d):
    """The same fold, batch by batch, into a versioned table."""
    sink = sinks.UpsertSink("POSTGRES", shared(spark, "upsert"), ["user_id"], COLUMNS, ["seq"])
    stream = adapters.change_log(pipeline.file_stream(spark, f"{d}/events.parquet"))
    pipeline.start(stream, sink, shared(spark, "checkpoint")).awaitTermination()
    return sink.read(spark).select("user_id", *COLUMNS, F.col("last.seq").alias("last_seq"))


@query(f"WITH {LOG} SELECT seq, user_id, op, CASE WHEN has_value THEN value ELSE 0.0::DOUBLE END AS value FROM log WHERE op <> 'DELETE'")
def stream_append(spark, d):
    sink = sinks.AppendSink("CLICKHOUSE", shared(spark, "append"), {"value": 0.0, "props": ""})
    stream = adapters.change_log(pipeline.file_stream(spark, f"{d}/events.parquet"))
    pipeline.start(stream, sink, shared(spark, "checkpoint")).awaitTermination()
    return sink.read(spark).select("seq", "user_id", "op", "value")


@query("SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS events, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def daily_activity(spark, d):
    return read(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))


@query(f"WITH {LOG} SELECT strftime(date_trunc('month', make_timestamp(ts_us)), '%Y-%m-%d') AS chunk, op, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM log WHERE op <> 'DELETE' GROUP BY 1, 2")
def stream_hypertable(spark, d):
    """Appended in chunks of a month, and counted by chunk as stored."""
    sink = sinks.HypertableSink("TIMESCALEDB", shared(spark, "chunks"), {"value": 0.0, "props": ""}, "at")
    stream = adapters.change_log(pipeline.file_stream(spark, f"{d}/events.parquet")).withColumn("at", F.timestamp_micros("ts_us"))
    pipeline.start(stream, sink, shared(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(sink.path).groupBy(F.date_format("chunk", "yyyy-MM-dd").alias("chunk"), "op").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query(f"WITH {LOG} SELECT CAST(user_id AS VARCHAR) AS event_key, count(*) > 0 AS seen FROM log GROUP BY 1")
def stream_deduplicated(spark, d):
    """The first event of each key, within a watermark that all of them fit."""
    stream = adapters.change_log(pipeline.file_stream(spark, f"{d}/events.parquet")).select(F.col("user_id").cast("string").alias("event_key"), F.timestamp_micros("ts_us").alias("at"))
    path = shared(spark, "distinct")
    pipeline.deduplicated(stream, "at", "3650 days").writeStream.format("parquet").option("path", path).option("checkpointLocation", shared(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select("event_key", F.lit(True).alias("seen"))


@query(f"WITH {LOG} SELECT op AS event_type, CAST(user_id AS VARCHAR) AS user_id, ts_us AS timestamp_micros FROM log")
def stream_commitlog(spark, d):
    """Segment files as a stream: the driver plans pieces of them, executors read them."""
    folder, path = shared(spark, "segments"), shared(spark, "frames")
    rows = adapters.generic_events(log(spark, d)).withColumn("seq", F.col("event_id").cast("bigint"))
    commitlog.write_segments(rows.withColumn("commitlog_file", F.concat(F.lit("CommitLog-7-"), F.floor(F.col("seq") / 2000).cast("string"), F.lit(".log"))), mounted(folder))
    spark.dataSource.register(commitlog.CommitLogSource)
    stream = spark.readStream.format("commitlog").option("path", mounted(folder)).option("piecebytes", 64 << 10).load()
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    found = commitlog.parse(spark.read.schema(stream.schema).parquet(path))
    return found.select("event_type", F.col("partition_key")["user_id"].alias("user_id"), "timestamp_micros")


@query(f"WITH {LOG}, e AS (SELECT seq, CASE WHEN seq % 31 = 0 THEN 'X' ELSE op[1] END AS k, CASE user_id % 3 WHEN 0 THEN 'time_series' WHEN 1 THEN 'sessions' ELSE 'people' END AS t, seq % 5 = 0 AS ttl FROM log), f AS (SELECT seq, CASE k WHEN 'I' THEN 'INSERT' WHEN 'U' THEN 'UPDATE' WHEN 'D' THEN 'DELETE' END AS event_type, CASE t WHEN 'people' THEN 'users' ELSE t END AS table_name, CASE WHEN t = 'time_series' THEN 1 ELSE 0 END AS clustering, k, ttl FROM e) SELECT seq AS position, event_type, table_name, clustering, CASE WHEN k = 'D' THEN 0 ELSE 2 END AS cells, CASE WHEN ttl THEN 3600 END AS ttl_seconds, CASE WHEN k = 'X' THEN 'unknown operation' END AS parse_error FROM f")
def plain_entries(spark, d):
    """Entries that hold an operation and a table's name alone."""
    table = F.element_at(F.array(*map(F.lit, ("time_series", "sessions", "people"))), (F.col("user_id") % 3 + 1).cast("int"))
    op = F.when(F.col("seq") % 31 == 0, "X").otherwise(F.substring("op", 1, 1))
    rows = log(spark, d).select(F.lit("CommitLog-7-1.log").alias("commitlog_file"), F.col("seq").alias("position"), F.encode(F.concat(op, F.lit(" INTO "), table, F.when(F.col("seq") % 5 == 0, " USING TTL 10").otherwise("")), "UTF-8").alias("entry"))
    found = commitlog.parse_plain(rows, NOW)
    return found.select("position", "event_type", "table_name", F.size("clustering_key").alias("clustering"), F.size("columns").alias("cells"), "ttl_seconds", "parse_error")

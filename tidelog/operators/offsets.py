"""Progress of each destination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["table_name", "keyspace", "partition_id", "destination"]


def batches(log: DataFrame, size: int, order: str, groups: list[str] | None = None) -> DataFrame:
    """Adds batch_id: each `size` rows in order, within `groups`. Without groups the order is global and one task numbers all rows; give groups on large data."""
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return log.withColumn("batch_id", F.floor((F.row_number().over(w.orderBy(order)) - 1) / size).cast("bigint"))


def batch_offsets(numbered: DataFrame, groups: list[str], order: str, ts: str) -> DataFrame:
    """Each batch's rows, and position and time of its last event."""
    return numbered.groupBy(*groups, "batch_id").agg(F.count("*").alias("events"), F.max(order).alias("last_position"), F.max_by(ts, order).alias("last_ts_us"))


def cumulative(offsets: DataFrame, groups: list[str]) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return offsets.withColumn("events_replicated", F.sum("events").over(w))


def latest(offsets: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last offset of each key, with all events counted."""
    rest = [c for c in offsets.columns if c not in keys]
    return offsets.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__x")).select(*keys, "__x.*")


def upsert(held: DataFrame, fresh: DataFrame) -> DataFrame:
    """Offsets after fresh ones: the later time wins, an equal one replaces, an earlier one is refused; counts add up."""
    rest = [c for c in held.columns if c not in (*KEY, "events_replicated_count")]
    both = held.withColumn("__n", F.lit(0)).unionByName(fresh.withColumn("__n", F.lit(1)))
    seen = Window.partitionBy(*KEY)
    both = both.withColumn("__floor", F.max(F.when(F.col("__n") == 0, F.col("last_event_timestamp_micros"))).over(seen)).filter("__n = 0 OR __floor IS NULL OR last_event_timestamp_micros >= __floor")
    return both.groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.struct("last_event_timestamp_micros", "__n")).alias("__x"), F.sum("events_replicated_count").alias("events_replicated_count")).select(*KEY, "__x.*", "events_replicated_count").select(*held.columns)


def backward(offsets: DataFrame, groups: list[str], order: str, ts: str) -> DataFrame:
    """Offsets whose time is before their predecessor's."""
    w = Window.partitionBy(*groups).orderBy(order)
    return offsets.withColumn("previous_ts_us", F.lag(ts).over(w)).filter(F.col(ts) < F.col("previous_ts_us"))


def resume(log: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """What each key's destination has not committed; offsets hold last_file_no and last_position."""
    joined = log.join(offsets, keys, "left")
    after = F.struct("file_no", "position") > F.struct(F.col("last_file_no").alias("file_no"), F.col("last_position").alias("position"))
    return joined.filter(F.col("last_position").isNull() | after).select(*log.columns)


def clean(offsets: DataFrame, now, days: int = 7) -> DataFrame:
    return offsets.filter(F.col("last_committed_at") >= now - F.expr(f"INTERVAL {days} DAYS"))


def read(offsets: DataFrame, table: str, keyspace: str, partition_id: int, destination: str) -> DataFrame:
    """The one offset of a key, or no row."""
    return offsets.filter((F.col("table_name") == table) & (F.col("keyspace") == keyspace) & (F.col("partition_id") == partition_id) & (F.col("destination") == destination))


def create(batches: DataFrame, table: str, keyspace: str, destination: str, count: int | None = 1) -> DataFrame:
    """New offsets of partitions (partition_id, commitlog_file, commitlog_position, last_event_timestamp_micros, and events if count is None): a fresh id each, committed now."""
    events = F.col("events") if count is None else F.lit(count).cast("bigint")
    return batches.select(
        F.expr("uuid()").alias("offset_id"), F.lit(table).alias("table_name"), F.lit(keyspace).alias("keyspace"), F.col("partition_id").cast("bigint"), F.lit(destination).alias("destination"), "commitlog_file",
        F.col("commitlog_position").cast("bigint"), F.col("last_event_timestamp_micros").cast("bigint"), F.current_timestamp().alias("last_committed_at"), events.alias("events_replicated_count"),
    )

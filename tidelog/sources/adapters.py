"""Change logs derived from ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.scalar import micros
from tidelog.shipping import ship

COLUMNS = ["value", "props"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def change_log(events: DataFrame) -> DataFrame:
    """user_id, day, seq, ts_us, op, event_type, value, props, has_value, has_props of the `events` table: sign-ups insert, errors delete, other events update some columns."""
    kind = F.col("event_type")
    return events.select(
        "user_id", F.to_date("ts").alias("day"), F.col("event_id").alias("seq"), micros("ts").alias("ts_us"),
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("op"), "event_type", "value", "props",
        kind.isin("signup", "purchase", "click").alias("has_value"), kind.isin("signup", "purchase", "view").alias("has_props"),
    )


def generic_events(log: DataFrame, keyspace: str = "ecommerce", table: str = "users") -> DataFrame:
    """The change log as generic events: maps of keys and cells."""
    cells = F.map_filter(F.create_map(F.lit("value"), F.col("value").cast("string"), F.lit("props"), F.col("props")), lambda k, v: (F.col("op") != "DELETE") & (((k == "value") & F.col("has_value")) | ((k == "props") & F.col("has_props"))))
    return log.select(
        F.col("seq").cast("string").alias("event_id"), F.col("op").alias("event_type"), F.lit(table).alias("table_name"), F.lit(keyspace).alias("keyspace"), F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("partition_key"),
        F.create_map().cast("map<string,string>").alias("clustering_key"), cells.alias("columns"), F.col("ts_us").alias("timestamp_micros"), F.timestamp_micros("ts_us").alias("captured_at"), F.lit(None).cast("int").alias("ttl_seconds"),
    )

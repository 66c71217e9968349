"""Schemas of change events, offsets, dead letters, schema versions and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()
_MAP = T.MapType(_S, _S)
OPERATIONS = ("INSERT", "UPDATE", "DELETE")
DESTINATIONS = ("POSTGRES", "CLICKHOUSE", "TIMESCALEDB")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: Cells are JSON texts by column: an absent key is "not changed", a null value "set to null".
CHANGE_EVENT = _struct(event_id=_S, event_type=_S, table_name=_S, keyspace=_S, partition_key=_MAP, clustering_key=_MAP, columns=_MAP, timestamp_micros=_L, captured_at=_TS, ttl_seconds=_I, commitlog_file=_S, commitlog_position=_L)
OFFSET = _struct(offset_id=_S, table_name=_S, keyspace=_S, partition_id=_L, destination=_S, commitlog_file=_S, commitlog_position=_L, last_event_timestamp_micros=_L, last_committed_at=_TS, events_replicated_count=_L)
COLUMN = _struct(name=_S, cql_type=_S, is_partition_key=T.BooleanType(), is_clustering_key=T.BooleanType(), is_static=T.BooleanType())
SCHEMA_CHANGE = _struct(change_type=_S, column_name=_S, old_type=_S, new_type=_S)
SCHEMA_VERSION = _struct(schema_id=_S, table_name=_S, keyspace=_S, version_number=_I, columns=T.MapType(_S, COLUMN), partition_keys=T.ArrayType(_S), clustering_keys=T.ArrayType(_S), detected_at=_TS, previous_version=_I, schema_changes=T.ArrayType(SCHEMA_CHANGE))
DEAD_LETTER = _struct(event_id=_S, event_type=_S, table_name=_S, keyspace=_S, partition_key=_MAP, clustering_key=_MAP, columns=_MAP, timestamp_micros=_L, captured_at=_TS, ttl_seconds=_I, destination=_S, error_type=_S, error_message=_S, failed_at=_TS)
SINK_STATE = _struct(sink_id=_S, destination=_S, enabled=T.BooleanType(), health=_S, last_write_at=_TS, latency_ms=T.DoubleType(), events_written=_L, errors_count=_L, last_error=_S, last_error_at=_TS, backlog_depth=_L, events_per_second=T.DoubleType())
#: One row of the log that folds take: the operation, an order, and for each column its value and whether the event has it.
PAYLOAD = _struct(keyspace=_S, table=_S, pk=_MAP, ck=_MAP, cols=_MAP, ts=_L, ttl=_I)

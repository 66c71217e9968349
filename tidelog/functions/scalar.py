"""Scalar expressions: digests, keys, lag, backoff. All are native columns."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(value: Column) -> Column:
    """Hex SHA-256 of the value's text in UTF-8; null stays null, the empty text has its own digest."""
    return F.sha2(value.cast("string"), 256)


def hmac_sha256_hex(value: Column, key: str) -> Column:
    """Hex HMAC-SHA256 of the value's text, composed of two digests over the padded key."""
    import hashlib

    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in raw)) for pad in (0x36, 0x5C))
    first = F.sha2(F.concat(inner, F.encode(value.cast("string"), "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def event_key(keyspace: Column, table: Column, partition: list[Column], clustering: list[Column], timestamp_micros: Column) -> Column:
    """Identity of a change: `keyspace.table:partition values:clustering values:micros`; a null value is the word None, so it keeps its place."""
    joined = [F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("None")) for c in cs]) for cs in (partition, clustering)]
    return F.concat_ws(":", F.concat_ws(".", keyspace, table), *joined, timestamp_micros.cast("string"))


def offset_key(keyspace: Column, table: Column, partition_id: Column, destination: Column) -> Column:
    return F.concat(keyspace, F.lit("."), table, F.lit(":partition_"), partition_id.cast("string"), F.lit(":"), destination)


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def replication_lag(now_us: Column, last_us: Column) -> Column:
    """Seconds from the last event to now, not below 0."""
    return F.greatest(F.lit(0.0), (now_us.cast("double") - last_us.cast("double")) / F.lit(1e6))


def backoff(attempt: Column, base: float = 1.0, multiplier: float = 2.0, most: float = 60.0) -> Column:
    """Seconds before attempt `attempt` (from 1), without jitter."""
    return F.least(F.lit(base) * F.pow(F.lit(multiplier), attempt.cast("double") - 1), F.lit(most))


def backoff_seconds(attempt: int, base: float = 1.0, multiplier: float = 2.0, most: float = 60.0, jitter: bool = True) -> float:
    """The same on the driver, then up to a quarter more or less."""
    wait = min(base * multiplier ** (attempt - 1), most)
    return max(0.0, wait + (random.uniform(-0.25, 0.25) * wait if jitter else 0.0))


#: What makes an error worth another attempt, looked for first, and what makes it permanent.
RETRYABLE = ("connection", "timeout", "temporary", "unavailable", "network", "unreachable", "refused", "reset", "broken pipe")
PERMANENT = ("permission denied", "authentication failed", "syntax error", "invalid", "does not exist")


def is_retryable(message: Column) -> Column:
    low = F.lower(message)
    return F.when(low.rlike("|".join(RETRYABLE)), True).when(low.rlike("|".join(PERMANENT)), False).otherwise(True)


def sink_health(healthy: Column, latency_ms: Column) -> Column:
    return F.when(~healthy, "unhealthy").when(latency_ms > 1000, "degraded").otherwise("healthy")

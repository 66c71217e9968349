"""Folding a change log into table state.

A fold is one aggregation: for each key and column the last event that has the column, the last write, and the last
delete. These are maxima, so partial results merge in any order, in a batch, between batches and in a stream; a column
counts if its event came after the delete. No join with tombstones is needed, and hot keys are aggregated before a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partial(log: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """State of each key: `__<c>` (order and value of column c's last event), `__write`, `__delete`. `log` has op, order columns, and for each column its value and has_<c>."""
    seq = F.struct(*order)
    writes = F.col("op") != "DELETE"
    return log.groupBy(*keys).agg(
        *[F.max_by(F.struct(seq.alias("s"), F.col(c).alias("v")), F.when(writes & F.col(f"has_{c}"), seq)).alias(f"__{c}") for c in columns],
        F.max(F.when(writes, seq)).alias("__write"), F.max(F.when(~writes, seq)).alias("__delete"),
    )


def merge(states: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """States of equal keys as one; any number of copies of one state is that state."""
    return states.groupBy(*keys).agg(*[F.max_by(f"__{c}", F.col(f"__{c}.s")).alias(f"__{c}") for c in columns], F.max("__write").alias("__write"), F.max("__delete").alias("__delete"))


def finish(states: DataFrame, keys: list[str], columns: list[str], scope: list[str] | None = None) -> DataFrame:
    """Live rows: keys, columns and the order of the last write. `scope`: key columns whose delete covers all rows of them (the partition key); else a delete covers its own key."""
    if scope and scope != keys:
        # A maximum for each scope, then a join that may be split: no task holds all rows of a scope.
        deletes = states.groupBy(*scope).agg(F.max("__delete").alias("__all")).filter("__all IS NOT NULL")
        states = states.join(deletes, scope, "left").withColumn("__delete", F.col("__all")).drop("__all")
    states = states.filter("__write IS NOT NULL AND (__delete IS NULL OR __write > __delete)")
    value = lambda c: F.when(F.col("__delete").isNull() | (F.col(f"__{c}.s") > F.col("__delete")), F.col(f"__{c}.v"))
    return states.select(*keys, *[value(c).alias(c) for c in columns], F.col("__write").alias("last"))


def upsert_fold(log: DataFrame, keys: list[str], columns: list[str], order: list[str], scope: list[str] | None = None) -> DataFrame:
    """Column-level last write wins. An absent column keeps its value, an explicit null overwrites, a delete clears what came before it. Ties of order go to the greater value struct of the aggregation; orders should be unique."""
    return finish(partial(log, keys, columns, order), keys, columns, scope)


def tombstones(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    return log.filter("op = 'DELETE'").groupBy(*keys).agg(F.max(order).alias("deleted_at"), F.count("*").alias("deletes"))


def append_log(log: DataFrame, defaults: dict) -> DataFrame:
    """Every write as a row, deletes dropped; a column that the event lacks takes its default."""
    return log.filter("op <> 'DELETE'").withColumns({c: F.when(F.col(f"has_{c}"), F.col(c)).otherwise(F.lit(v)) for c, v in defaults.items()})


def replacing(rows: DataFrame, keys: list[str], version: str, keep_deleted: bool = True) -> DataFrame:
    """The row of the greatest version of each key, as a maximum of structs, which is aggregated before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, version)]
    out = rows.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("__x")).select(*keys, "__x.*")
    return out if keep_deleted else out.filter("op <> 'DELETE'")


def deduplicate(rows: DataFrame, identity: Column, order: str) -> DataFrame:
    """The first row of each identity."""
    return rows.groupBy(identity.alias("event_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("__x"), F.count("*").alias("copies")).select("event_key", "__x.*", "copies")


def live_at(log: DataFrame, now_us: int) -> DataFrame:
    """Without events whose time to live is over."""
    return log.filter(F.col("ttl_seconds").isNull() | (F.col("timestamp_micros") + F.col("ttl_seconds").cast("bigint") * 1_000_000 > F.lit(now_us)))


def expired(tombstones: DataFrame, now_us: int, grace_seconds: int = 864_000) -> Column:
    """Whether a tombstone of time `deleted_us` may go: its grace (ten days by default) is over, so every destination has had time to see it."""
    return F.col("deleted_us") + F.lit(grace_seconds * 1_000_000) <= F.lit(now_us)


def expire(tombstones: DataFrame, now_us: int, grace_seconds: int = 864_000) -> DataFrame:
    """Tombstones that are still needed."""
    return tombstones.filter(~expired(tombstones, now_us, grace_seconds))


def project_row() -> Column:
    """One map of a generic event's keys and cells; later ones win, whatever the session's rule for repeated keys."""
    pk, ck, cells = (F.coalesce(F.col(c), F.create_map().cast("map<string,string>")) for c in ("partition_key", "clustering_key", "columns"))
    free = lambda m, *later: F.map_filter(m, lambda k, v: ~F.exists(F.array(*[F.map_contains_key(x, k) for x in later]), lambda b: b))
    return F.map_concat(free(pk, ck, cells), free(ck, cells), cells)


def parity(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows are missing or different in one of two destinations; a key's rows are compared with their numbers, by count and sum of hashes."""
    rest = [c for c in a.columns if c not in keys]
    left, right = (x.select(*keys, *rest).groupBy(*keys).agg(F.struct(F.count("*").alias("n"), F.sum(F.xxhash64(*rest).cast("decimal(38,0)")).alias("h"), F.max(F.struct(*rest)).alias("x")).alias(n)) for x, n in ((a, "__a"), (b, "__b")))
    joined = left.join(right, keys, "full_outer").filter(~F.col("__a").eqNullSafe(F.col("__b")))
    return joined.select(*keys, F.when(F.col("__a").isNull(), "missing_left").when(F.col("__b").isNull(), "missing_right").otherwise("different").alias("difference"))

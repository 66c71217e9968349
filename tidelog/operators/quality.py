"""Contract and schema checks; bad rows are marked and split off, and never fail a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = "^[a-z_][a-z0-9_]*$"
SEGMENT = "^CommitLog-[0-9]+-[0-9]+\\.log$"


def _found(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks, in order; a null condition is broken."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))


def _empty(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def event_violations(strict: bool = False, now: Column | None = None) -> Column:
    """Of generic change events."""
    now = F.current_timestamp() if now is None else now
    rules = {
        "event_type": F.col("event_type").isin("INSERT", "UPDATE", "DELETE"), "timestamp": F.col("timestamp_micros") > 0, "partition_key": ~_empty("partition_key"),
        "columns": (F.col("event_type") == "DELETE") | ~_empty("columns"), "captured_at": F.col("captured_at").isNull() | (F.col("captured_at") <= now),
        "keyspace": F.col("keyspace").rlike(NAME) & (F.length("keyspace") <= 255), "table_name": F.col("table_name").rlike(NAME) & (F.length("table_name") <= 255),
        "ttl": F.col("ttl_seconds").isNull() | (F.col("ttl_seconds") >= 0),
    }
    if strict:
        rules["delete_columns"] = (F.col("event_type") != "DELETE") | _empty("columns")
    return _found(rules)


def offset_violations(now: Column | None = None) -> Column:
    now = F.current_timestamp() if now is None else now
    return _found({"position": F.col("commitlog_position") >= 0, "timestamp": F.col("last_event_timestamp_micros") >= 0, "count": F.col("events_replicated_count") >= 0, "committed_at": F.col("last_committed_at").isNull() | (F.col("last_committed_at") <= now), "commitlog_file": F.col("commitlog_file").rlike(SEGMENT)})


def type_ok(value: Column, cql: str) -> Column:
    """Whether a text cell reads as the type; the first part found in the type's name decides, unknown types pass."""
    low = cql.lower()
    # The order in which types are looked for.
    kinds = (("text", None), ("varchar", None), ("int", "bigint"), ("bigint", "bigint"), ("double", "double"), ("float", "double"), ("decimal", "double"), ("boolean", "boolean"), ("uuid", None), ("timestamp", None))
    cast = next((to for part, to in kinds if part in low), None)
    return F.lit(True) if cast is None else value.isNull() | value.try_cast(cast).isNotNull()


def mismatches(types: dict[str, str], cell=None) -> Column:
    """Names of columns whose cells don't read as their types."""
    cell = cell or (lambda c: F.col("columns")[c])
    return F.array_compact(F.array(*[F.when(~type_ok(cell(c), t), F.lit(c)) for c, t in types.items()])) if types else F.array().cast("array<string>")


def unknown_columns(columns: list[str]) -> Column:
    return F.array_sort(F.array_except(F.map_keys("columns"), F.array(*map(F.lit, columns))))


def missing_keys(keys: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(~F.coalesce(F.map_contains_key("partition_key", k), F.lit(False)), F.lit(k)) for k in keys]))


def split(df: DataFrame, violations: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without violations, and the others with theirs."""
    marked = df.withColumn("violations", violations)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def dead_letters(bad: DataFrame, destination: str, error_type: str, message: Column, failed_at: Column) -> DataFrame:
    return bad.withColumns({"destination": F.lit(destination), "error_type": F.lit(error_type), "error_message": message, "failed_at": failed_at})

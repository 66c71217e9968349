"""Types of the source in each destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type, and its name in a row store and in a column store.
_TYPES = (
    ("UUID", "uuid", "UUID"), ("TEXT", "text", "String"), ("VARCHAR", "varchar", "String"), ("INT", "integer", "Int32"), ("BIGINT", "bigint", "Int64"), ("FLOAT", "real", "Float32"),
    ("DOUBLE", "double precision", "Float64"), ("DECIMAL", "numeric", "Decimal(18, 2)"), ("BOOLEAN", "boolean", "UInt8"), ("TIMESTAMP", "timestamptz", "DateTime64(3)"), ("DATE", "date", "Date"), ("TIME", "time", "String"),
    ("BLOB", "bytea", "String"), ("MAP", "jsonb", "String"), ("LIST", "jsonb", "String"), ("SET", "jsonb", "String"), ("TUPLE", "jsonb", "String"), ("UDT", "jsonb", "String"),
)
ROW_STORE, COLUMN_STORE = {a: b for a, b, _ in _TYPES}, {a: c for a, _, c in _TYPES}
TARGETS = {"POSTGRES": ROW_STORE, "TIMESCALEDB": ROW_STORE, "CLICKHOUSE": COLUMN_STORE}
SPARK = {"UUID": T.StringType(), "TEXT": T.StringType(), "VARCHAR": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "DECIMAL": T.DecimalType(38, 10), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.LongType(), "DATE": T.DateType(), "TIME": T.StringType(), "BLOB": T.BinaryType()}
FALLBACK = {"POSTGRES": "text", "TIMESCALEDB": "text", "CLICKHOUSE": "String"}


def overlay(base: dict, over: dict) -> dict:
    return {**base, **over}


def table(spark: SparkSession) -> DataFrame:
    """cql_type, target, mapped: a row for each pair."""
    return spark.createDataFrame([(c, t, m) for t, types in TARGETS.items() for c, m in types.items()], "cql_type string, target string, mapped string")


def mapped(cql: str, target: str, strict: bool = True) -> str | None:
    """A type's name in the target; None if it has none. Without `strict`, parameters are left out first."""
    name = cql.upper() if strict else cql.upper().split("<")[0].split("(")[0]
    return TARGETS[target].get(name)


def map_column(cql: Column, target: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in TARGETS[target].items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.upper(cql)), F.lit(FALLBACK[target]))


def incompatible(cql: Column, target: str) -> Column:
    """Frozen, tuple and counter types, and those without a name in the target."""
    up = F.upper(cql)
    known = F.create_map(*[F.lit(x) for kv in TARGETS[target].items() for x in kv])
    return up.contains("FROZEN<") | up.contains("TUPLE<") | up.contains("COUNTER") | F.try_element_at(known, up).isNull()


def incompatible_of(schemas: DataFrame, target: str) -> DataFrame:
    """For each schema (keyspace, table_name, column_name, cql_type), its columns that the target can't hold, in order; none as an empty list."""
    bad = F.when(incompatible(F.col("cql_type"), target), F.col("column_name"))
    return schemas.groupBy("keyspace", "table_name").agg(F.sort_array(F.collect_list(bad)).alias("columns"))


def convert(value: Column, cql: str) -> Column:
    """A text cell as its type; times stay numbers of microseconds, identifiers and unknown types stay text."""
    return value.cast(SPARK.get(cql.upper(), T.StringType()))


def handle_unsupported(df: DataFrame, columns: dict[str, str], target: str, strategy: str = "dlq") -> tuple[DataFrame, DataFrame]:
    """Rows for the target and rows for the dead-letter store: `skip` leaves unsupported columns out, `json` writes them as JSON text, `dlq` sends rows off."""
    bad = [c for c, t in columns.items() if mapped(t, target) is None]
    if strategy == "skip":
        return df.drop(*bad), df.limit(0)
    if strategy == "json":
        return df.withColumns({c: F.to_json(F.struct(c)) for c in bad}), df.limit(0)
    return (df.limit(0), df) if bad else (df, df.limit(0))

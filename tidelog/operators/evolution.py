"""Versions of table schemas, their differences, and what a destination can follow."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import typemap

#: Changes of type that keep all values (fixed values).
WIDENINGS = (("int", "bigint"), ("float", "double"), ("decimal", "double"), ("text", "varchar"), ("varchar", "text"))


@dataclass(frozen=True)
class Change:
    change_type: str
    column_name: str
    old_type: str | None = None
    new_type: str | None = None

    def is_compatible(self) -> bool:
        return self.change_type in ("ADD_COLUMN", "DROP_COLUMN") or ((self.old_type or "").lower(), (self.new_type or "").lower()) in WIDENINGS


def changes(old: dict[str, str], new: dict[str, str]) -> list[Change]:
    """Of columns, by name: added ones, then dropped ones and those of another type, whatever its case. diff() is the same over tables."""
    kinds = {True: lambda c: Change("ADD_COLUMN", c, None, new[c]), False: lambda c: Change("DROP_COLUMN", c, old[c]) if c not in new else Change("ALTER_TYPE", c, old[c], new[c])}
    moved = [c for c in old if new.get(c, "").lower() != old[c].lower()]
    return [kinds[c not in old](c) for c in [*(c for c in new if c not in old), *moved]]


@dataclass(frozen=True)
class TableSchema:
    keyspace: str
    table_name: str
    columns: dict[str, str]
    partition_keys: tuple[str, ...]
    clustering_keys: tuple[str, ...] = ()
    version: int = 1
    previous: int | None = None
    renames: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        keys = {*self.partition_keys, *self.clustering_keys}
        if self.version < 1 or not self.partition_keys or not keys <= {*self.columns} or (self.version > 1 and self.previous is None):
            raise ValueError("a schema has a version from 1, keys among its columns, and a predecessor after version 1")

    @classmethod
    def create_initial(cls, keyspace: str, table_name: str, columns: dict[str, str], partition_keys: tuple[str, ...], clustering_keys: tuple[str, ...] = ()) -> TableSchema:
        """Version 1, without a predecessor."""
        return cls(keyspace, table_name, dict(columns), tuple(partition_keys), tuple(clustering_keys))

    def with_version(self, version: int) -> TableSchema:
        return replace(self, version=version, previous=self.version)

    def evolve(self, columns: dict[str, str]) -> TableSchema:
        return replace(self, columns=dict(columns), version=self.version + 1, previous=self.version)

    def fingerprint(self) -> str:
        """SHA-256 of the content, whatever the version or the order of columns."""
        content = {"keyspace": self.keyspace, "table": self.table_name, "columns": dict(sorted(self.columns.items())), "partition": list(self.partition_keys), "clustering": list(self.clustering_keys)}
        return hashlib.sha256(json.dumps(content, sort_keys=True).encode()).hexdigest()

    def compare(self, other: TableSchema) -> list[Change]:
        """What happened to keys, then to columns. A key that came or went, or keys in another order, are changes that no destination can follow."""
        out: list[Change] = []
        for role in ("partition_key", "clustering_key"):
            before, after = (getattr(x, f"{role}s") for x in (self, other))
            if sorted(before) == sorted(after):
                out += [Change("ALTER_TYPE", ",".join(before), role, f"{role}:{','.join(after)}")] * (before != after)
                continue
            flip = {False: (f"not_{role}", role), True: (role, f"not_{role}")}
            out += [Change("ALTER_TYPE", k, *flip[k in before]) for k in sorted({*before} ^ {*after}, key=[*before, *after].index)]
        return out + changes(self.columns, other.columns)


def compatible(old: Column, new: Column) -> Column:
    pair = F.concat_ws(">", F.lower(old), F.lower(new))
    return pair.isin(*[f"{a}>{b}" for a, b in WIDENINGS])


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between two tables of column_name and cql_type."""
    joined = old.withColumnRenamed("cql_type", "old_type").join(new.withColumnRenamed("cql_type", "new_type"), "column_name", "full_outer")
    kind = F.when(F.col("old_type").isNull(), "ADD_COLUMN").when(F.col("new_type").isNull(), "DROP_COLUMN").when(F.lower("old_type") != F.lower("new_type"), "ALTER_TYPE")
    return joined.withColumn("change_type", kind).filter("change_type IS NOT NULL").withColumn("is_compatible", F.when(F.col("change_type") == "ALTER_TYPE", compatible(F.col("old_type"), F.col("new_type"))).otherwise(True))


def incompatible(old: TableSchema, new: TableSchema) -> list[Change]:
    """Changes that no destination can follow; the two are compatible if there are none."""
    return [c for c in old.compare(new) if not c.is_compatible()]


def supported(change: Change, target: str) -> bool:
    return change.is_compatible() and (change.new_type is None or typemap.mapped(change.new_type, target) is not None)


def apply(schema: TableSchema, change: Change, target: str) -> dict[str, str]:
    """A destination's column types after a change."""
    out = {c: typemap.mapped(t, target) or typemap.FALLBACK[target] for c, t in schema.columns.items()}
    if change.change_type == "DROP_COLUMN":
        out.pop(change.column_name, None)
    else:
        out[change.column_name] = typemap.mapped(change.new_type or "", target) or typemap.FALLBACK[target]
    return out


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


class Registry:
    """Schemas by table; `overrides` turn an incompatible column's cells into what the destination takes."""

    def __init__(self):
        self.schemas: dict[str, list[TableSchema]] = {}
        self.overrides: dict[tuple[str, str], Callable[[Column], Column]] = {}
        self.log: list[dict] = []

    def register(self, schema: TableSchema) -> list[Change]:
        held = self.schemas.setdefault(f"{schema.keyspace}.{schema.table_name}", [])
        changes = held[-1].compare(schema) if held else []
        self.log += [{"table": f"{schema.keyspace}.{schema.table_name}", "version": schema.version, "change": c, "compatible": c.is_compatible()} for c in changes]
        held.append(schema)
        return changes

    def get(self, keyspace: str, table: str) -> TableSchema | None:
        return (self.schemas.get(f"{keyspace}.{table}") or [None])[-1]

    def audit(self, spark: SparkSession) -> DataFrame:
        """The log of changes as a table; a row for each change of a registered version."""
        rows = [(x["table"], x["version"], x["change"].change_type, x["change"].column_name, x["change"].old_type, x["change"].new_type, x["compatible"]) for x in self.log]
        return spark.createDataFrame(rows, "table_name string, version int, change_type string, column_name string, old_type string, new_type string, compatible boolean")

    def paused(self) -> set[str]:
        """Tables whose latest change is incompatible: their events go to the dead-letter store, others go on."""
        return {x["table"] for x in self.log if not x["compatible"] and x["version"] == self.schemas[x["table"]][-1].version and (x["table"], x["change"].column_name) not in self.overrides}

    def route(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        name, off = F.concat_ws(".", "keyspace", "table_name"), sorted(self.paused())
        stop = name.isin(*off) if off else F.lit(False)
        return events.filter(~stop), events.filter(stop)

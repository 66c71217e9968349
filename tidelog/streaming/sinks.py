"""Destinations of micro-batches. A batch written twice leaves one result: what is written is named by its batch."""

from __future__ import annotations

import json
import math
from abc import ABC, abstractmethod
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field
from time import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import fold
from tidelog.streaming import logs


@dataclass
class SinkState:
    """Counters and health of one destination."""

    destination: str
    health: str = "unknown"
    events_written: int = 0
    errors_count: int = 0
    last_error: str | None = None
    last_write: float | None = None
    backlog_depth: int = 0
    samples: deque = field(default_factory=lambda: deque(maxlen=10))

    def wrote(self, n: int, now: float | None = None) -> None:
        now = time() if now is None else now
        if self.last_write is not None and now > self.last_write:
            self.samples.append(n / (now - self.last_write))
        self.events_written, self.last_write = self.events_written + n, now

    def failed(self, error: str) -> None:
        self.errors_count, self.last_error, self.health = self.errors_count + 1, error, "unhealthy"

    def update_health(self, healthy: bool, latency_ms: float) -> None:
        self.health = "unhealthy" if not healthy else "degraded" if latency_ms > 1000 else "healthy"

    @property
    def throughput(self) -> float:
        return sum(self.samples) / len(self.samples) if self.samples else 0.0

    def stats(self) -> dict:
        return {"destination": self.destination, "health": self.health, "events_written": self.events_written, "errors_count": self.errors_count, "last_error": self.last_error, "events_per_second": self.throughput, "backlog_depth": self.backlog_depth}


class Sink(ABC):
    def __init__(self, name: str, path: str):
        self.path, self.state = path.rstrip("/"), SinkState(name)

    @abstractmethod
    def write_batch(self, batch: DataFrame, batch_id: int) -> int:
        """Write a change log's rows; how many counted."""

    @abstractmethod
    def read(self, spark: SparkSession) -> DataFrame: ...

    def health_check(self, spark: SparkSession) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole folders in a folder: those whose job has ended."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Segments:
    """Folders <first>-<last> of what batches first to last have written. Wider ones replace those within them."""

    def __init__(self, path: str, together: int = 8):
        self.path, self.together = path, together

    def whole(self, spark: SparkSession) -> list[tuple[int, int]]:
        """In order, without those that a wider one holds."""
        found = sorted((tuple(map(int, n.split("-"))) for n in _children(spark, self.path)), key=lambda x: (x[0], -x[1]))
        out: list[tuple[int, int]] = []
        for x in found:
            if not out or x[1] > out[-1][1]:
                out.append(x)
        return out

    def place(self, first: int, last: int) -> str:
        return f"{self.path}/{first}-{last}"

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a wider segment has the batch already."""
        return any(a <= batch_id <= b and a < b for a, b in self.whole(spark))

    def compact(self, spark: SparkSession, merged: Callable[[list[str]], DataFrame], save: Callable[[DataFrame, str], None]) -> None:
        """Neighbours of one size, `together` of them, become one: a row is written again once for each size, not for each batch."""
        while True:
            found = self.whole(spark)
            size = lambda x: int(math.log(x[1] - x[0] + 1, self.together) + 1e-9)
            run = next((found[i : i + self.together] for i in range(len(found) - self.together + 1) if len({size(x) for x in found[i : i + self.together]}) == 1), None)
            if run is None:
                return
            save(merged([self.place(*x) for x in run]), self.place(run[0][0], run[-1][1]))
            for x in run:
                _delete(spark, self.place(*x))


class UpsertSink(Sink):
    """Table state as segments of mergeable fold states. A batch writes its own partial fold; segments are merged now and then, and by readers, in any order. Stands for stores with upserts."""

    def __init__(self, name: str, path: str, keys: list[str], columns: list[str], order: list[str], scope: list[str] | None = None, together: int = 8):
        super().__init__(name, path)
        self.keys, self.columns, self.order, self.scope, self.segments = keys, columns, order, scope, Segments(self.path, together)

    def write_batch(self, batch: DataFrame, batch_id: int) -> int:
        spark, seen = batch.sparkSession, Observation()
        if self.segments.holds(spark, batch_id):
            return 0
        fresh = fold.partial(batch.observe(seen, F.count(F.lit(1)).alias("n")), self.keys, self.columns, self.order)
        fresh.write.mode("overwrite").parquet(self.segments.place(batch_id, batch_id))
        self.segments.compact(spark, lambda paths: fold.merge(spark.read.parquet(*paths), self.keys, self.columns), lambda df, path: df.write.mode("overwrite").parquet(path))
        return seen.get["n"]

    def read(self, spark: SparkSession) -> DataFrame:
        state = spark.read.parquet(*[self.segments.place(*x) for x in self.segments.whole(spark)])
        return fold.finish(fold.merge(state, self.keys, self.columns), self.keys, self.columns, self.scope)


class AppendSink(Sink):
    """Rows appended under batch=<id>; deletes are dropped, absent columns take defaults. Stands for column stores."""

    def __init__(self, name: str, path: str, defaults: dict):
        super().__init__(name, path)
        self.defaults = defaults

    def write_batch(self, batch: DataFrame, batch_id: int) -> int:
        rows = fold.append_log(batch, self.defaults)
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return rows.count()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")


class HypertableSink(AppendSink):
    """The same in chunks of time, with sorted, compressed files for pruning."""

    def __init__(self, name: str, path: str, defaults: dict, time: str, every: str = "month"):
        super().__init__(name, path, defaults)
        self.time, self.every = time, every

    def write_batch(self, batch: DataFrame, batch_id: int) -> int:
        rows = fold.append_log(batch, self.defaults).withColumn("chunk", F.date_format(F.date_trunc(self.every, self.time), "yyyy-MM-dd"))
        rows.repartition("chunk").sortWithinPartitions(self.time).write.mode("overwrite").option("compression", "zstd").partitionBy("chunk").parquet(f"{self.path}/batch={batch_id}")
        return rows.count()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch", "chunk")


class DeadLetterSink(Sink):
    """JSON lines by batch, origin, destination and day. A batch written again replaces its own rows; a failure is kept in the state and raised, so that the batch comes again."""

    def write_batch(self, batch: DataFrame, batch_id: int, origin: str = "all") -> int:
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("date", F.date_format("failed_at", "yyyy-MM-dd"))
        try:
            rows.write.mode("overwrite").partitionBy("destination", "date").json(f"{self.path}/batch={origin.lower()}-{batch_id}")
        except Exception as e:
            self.state.failed(str(e))
            raise
        n = seen.get["n"]
        self.state.wrote(n)
        return n

    def read(self, spark: SparkSession, destination: str | None = None) -> DataFrame:
        found = spark.read.json(self.path).drop("batch")
        return found.filter(F.col("destination") == destination) if destination else found

    def count(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).groupBy("destination", "error_type", "date").count()


class OffsetStore:
    """Offsets of each destination's batches, in segments that are merged now and then; a batch that comes twice counts once."""

    KIND = "events bigint, last_position bigint, last_ts_us bigint, batch_id bigint, committed_at timestamp"

    def __init__(self, path: str, together: int = 8):
        self.path, self.together = path.rstrip("/"), together

    def _segments(self, destination: str) -> Segments:
        return Segments(f"{self.path}/{destination}", self.together)

    @staticmethod
    def _sum(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("last_position", "last_ts_us", "batch_id", "committed_at"), "batch_id").alias("x")
        return rows.agg(F.sum("events").alias("events"), last).filter("events IS NOT NULL").select("events", "x.*")

    def commit(self, spark: SparkSession, destination: str, batch_id: int, rows: DataFrame, order: str, ts: str) -> bool:
        """Whether the batch's offset is held now; a failure to write it is no error of the batch."""
        segments = self._segments(destination)
        try:
            if not segments.holds(spark, batch_id):
                found = rows.agg(F.count("*").alias("events"), F.max(order).alias("last_position"), F.max_by(ts, order).alias("last_ts_us")).filter("events > 0")
                found.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "committed_at": F.current_timestamp()}).write.mode("overwrite").json(segments.place(batch_id, batch_id))
                segments.compact(spark, lambda paths: self._sum(spark.read.schema(self.KIND).json(paths)), lambda df, path: df.write.mode("overwrite").json(path))
            return True
        except Exception:
            logs.get_logger(__name__).exception("offset not committed", destination=destination, batch_id=batch_id)
            return False

    def read(self, spark: SparkSession, destination: str) -> dict | None:
        segments = self._segments(destination)
        paths = [segments.place(*x) for x in segments.whole(spark)]
        r = self._sum(spark.read.schema(self.KIND).json(paths)).first() if paths else None
        return {k: v for k, v in r.asDict().items() if k != "committed_at"} if r else None


def dumps(state: SinkState) -> str:
    return json.dumps(state.stats())

"""The replication service: streams from a commit log to each enabled destination, as the settings say, until it is told to stop.

    python -m tidelog.service settings.yaml [more.yaml ...]
"""

from __future__ import annotations

import signal
import sys
import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import config
from tidelog.operators import masking, quality
from tidelog.session import session
from tidelog.shipping import ship
from tidelog.sources import commitlog
from tidelog.streaming import logs, observe, pipeline, retry, sinks

#: How each destination keeps rows: as state, appended, or in chunks of time.
UPSERT, APPEND, CHUNKS = "postgres", "clickhouse", "timescaledb"


def as_log(events: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Generic events as the rows that folds take, in order of time, then segment and place."""
    known: list[Column] = [F.map_contains_key("columns", c).alias(f"has_{c}") for c in columns]
    return events.select("*", F.col("partition_key")[key].alias(key), F.col("event_type").alias("op"), F.col("timestamp_micros").alias("ts_us"), F.col("position").alias("seq"), commitlog.order_of(F.col("commitlog_file")).alias("segment"), F.timestamp_micros("timestamp_micros").alias("at"), *[F.col("columns")[c].alias(c) for c in columns], *known)


class Service:
    """run() streams what is there; run_continuous() goes on until shutdown(). Each destination has its own query, offsets and checkpoint."""

    def __init__(self, settings: config.Settings, spark: SparkSession | None = None):
        self.settings, self.spark = settings, spark or session()
        self.log, self.health, self.metrics = logs.get_logger("tidelog.service"), observe.Health(), observe.Metrics()
        self.queries: list = []
        self.server = None
        self._stop = threading.Event()
        at = settings.work_path.rstrip("/")
        self.sinks = self._sinks(at)
        self.dead = sinks.DeadLetterSink("DLQ", settings.dlq_path if "/" in settings.dlq_path else f"{at}/{settings.dlq_path}")
        self.offsets = sinks.OffsetStore(f"{at}/offsets")

    def _sinks(self, at: str) -> dict[str, sinks.Sink]:
        out: dict[str, sinks.Sink] = {}
        for name in (UPSERT, APPEND, CHUNKS):
            d = getattr(self.settings.destinations, name)
            if not d.enabled:
                continue
            path, o, title = d.path or f"{at}/{name}", d.options, name.upper()
            columns, defaults = list(o.get("columns", ["value"])), dict(o.get("defaults", {}))
            defaults = {c: defaults.get(c, "") for c in columns}
            if name == UPSERT:
                out[name] = sinks.UpsertSink(title, path, [o.get("key", "id")], columns, ["ts_us", "segment", "seq"])
            elif name == APPEND:
                out[name] = sinks.AppendSink(title, path, defaults)
            else:
                out[name] = sinks.HypertableSink(title, path, defaults, "at", o.get("every", "month"))
        return out

    def _stream(self) -> DataFrame:
        ship(self.spark).dataSource.register(commitlog.CommitLogSource)
        return self.spark.readStream.format("commitlog").option("path", self.settings.source_path).load()

    def _split(self, name: str):
        """Batches of frames as masked events of the wanted table, and those that break a rule."""
        s, o = self.settings, getattr(self.settings.destinations, name).options
        rules = masking.Rules(key=s.phi_key, salt=s.pii_salt)

        def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
            found = commitlog.parse(batch)
            wanted = found.filter((F.col("keyspace") == s.keyspace) & (F.col("table_name") == s.table) | F.col("parse_error").isNotNull())
            broken = F.when(F.col("parse_error").isNotNull(), F.array("parse_error")).otherwise(quality.event_violations())
            good, bad = quality.split(wanted.withColumn("captured_at", F.timestamp_micros("timestamp_micros")), broken)
            good = good.withColumn("columns", masking.mask_cells(F.col("columns"), rules))
            bad = quality.dead_letters(bad, name.upper(), "contract_violation", F.array_join("violations", ","), F.current_timestamp())
            return as_log(good, o.get("key", "id"), list(o.get("columns", ["value"]))), bad

        return split

    def _progress(self, name: str):
        def told(x: dict) -> None:
            self.metrics.set("events_written", x["events_written"], destination=name.upper())
            self.metrics.set("errors", x["errors_count"], destination=name.upper())
            self.log.info("batch written", **{k: x[k] for k in ("batch_id", "destination", "events_written", "errors_count", "health")})

        return told

    def probes(self) -> dict:
        out = {name: (lambda s=s: s.state.health != "unhealthy") for name, s in self.sinks.items()}
        return out | {"source": lambda: observe.folder_exists(self.spark, self.settings.source_path)}

    def start(self, available_now: bool) -> None:
        s = self.settings
        r = s.pipeline.retry
        policy = retry.RetryPolicy(r.max_attempts, r.base_ms / 1000, r.max_ms / 1000, r.multiplier, r.jitter)
        if s.http_port >= 0 and self.server is None:
            self.server = observe.serve(s.http_port, self.health, self.metrics)
        self.log.info("replication starts", table=s.table, keyspace=s.keyspace, destinations=",".join(self.sinks))
        for name, sink in self.sinks.items():
            checkpoint = f"{s.work_path.rstrip('/')}/checkpoints/{name}"
            self.queries.append(pipeline.start(self._stream(), sink, checkpoint, self.offsets, self.dead, policy, split=self._split(name), available_now=available_now, interval=f"{s.pipeline.poll_interval_ms} milliseconds", on_progress=self._progress(name)))

    def run(self) -> dict[str, dict]:
        """All that is there, then stop; the statistics of each destination."""
        try:
            self.start(available_now=True)
            for q in self.queries:
                q.awaitTermination()
        finally:
            self.shutdown()
        return {name: s.state.stats() for name, s in self.sinks.items()}

    def run_continuous(self) -> None:
        """Until shutdown(), or until every query has ended. Dependencies are probed now and then."""
        try:
            self.start(available_now=False)
            probed = 0.0
            while not self._stop.wait(0.2) and any(q.isActive for q in self.queries):
                if time.time() - probed >= self.settings.probe_interval_s:
                    self.health.probe(self.probes())
                    probed = time.time()
        finally:
            self.shutdown()
        if errors := [str(e) for q in self.queries if (e := q.exception())]:
            raise RuntimeError("; ".join(errors))

    def shutdown(self, *_) -> None:
        """Batches under way end; then all stops. May be called again, and from a signal."""
        if not self._stop.is_set():
            self.log.info("replication stops")
        self._stop.set()
        for e in pipeline.stop(self.queries):
            self.log.error("query not stopped", error=e)
        if self.server:
            self.server.shutdown()
            self.server = None


def main(paths: list[str]) -> int:
    settings = config.load(*paths)
    logs.configure(settings.log_level, settings.log_format)
    service = Service(settings)
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: service._stop.set())
    try:
        service.run_continuous()
    except Exception as e:
        service.log.error("replication failed", error=str(e)[:1000])
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

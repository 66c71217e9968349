"""Streams of a change log: one query for each destination, each with its own checkpoint and progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.streaming import logs, retry
from tidelog.streaming.sinks import DeadLetterSink, OffsetStore, Sink


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a table, one file or a folder of files."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = path.rstrip("/").rsplit("/", 1)
    single = [f for f in table.inputFiles() if f.rstrip("/").endswith("/" + name[1])]
    return reader.option("pathGlobFilter", name[1]).parquet(name[0]) if single else reader.parquet(path)


def start(stream: DataFrame, sink: Sink, checkpoint: str, offsets: OffsetStore | None = None, dead: DeadLetterSink | None = None, policy: retry.RetryPolicy | None = None, order: str = "seq", ts: str = "ts_us", split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None, available_now: bool = True, interval: str = "100 milliseconds", on_progress: Callable[[dict], None] | None = None):
    """Start a query. Each batch is split into good and bad rows, written with retries, then committed; what can't be written goes to the dead-letter store and the stream goes on. A batch that not even that store takes fails, and comes again."""
    policy = policy or retry.RetryPolicy()

    name, log = sink.state.destination, logs.get_logger(__name__)

    def each(batch: DataFrame, batch_id: int) -> None:
        with logs.bound(destination=name, batch_id=batch_id), logs.span("batch_write", destination=name):
            handle(batch, batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split(batch) if split else (batch, None)
            if bad is not None and dead is not None:
                dead.write_batch(bad, batch_id, f"{name}-bad")
            try:
                n = retry.call(sink.write_batch, policy, good, batch_id)
                sink.state.wrote(n)
                sink.state.update_health(True, 0.0)
                if offsets:
                    offsets.commit(batch.sparkSession, sink.state.destination, batch_id, good, order, ts)
            except Exception as e:
                sink.state.failed(str(e))
                if dead is None:
                    raise
                log.error("batch goes to the dead-letter store", error=str(e)[:500], error_type=type(e).__name__)
                lost = good.withColumns({"destination": F.lit(sink.state.destination), "error_type": F.lit(type(e).__name__), "error_message": F.lit(str(e)[:500]), "failed_at": F.current_timestamp()})
                dead.write_batch(lost, batch_id, f"{name}-lost")
            if on_progress:
                on_progress({"batch_id": batch_id, **sink.state.stats()})
        finally:
            batch.unpersist()

    writer = stream.writeStream.queryName(sink.state.destination.lower()).option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def fan_out(stream: DataFrame, sinks: list[Sink], checkpoints: str, **options) -> list:
    """A query for each sink; one that fails doesn't hold up the others."""
    return [start(stream, s, f"{checkpoints.rstrip('/')}/{s.state.destination.lower()}", **options) for s in sinks]


def stop(queries: list) -> list[str]:
    """Stop all; errors are returned, not raised."""
    errors = []
    for q in queries:
        try:
            q.stop()
        except Exception as e:
            errors.append(str(e))
    return errors


def deduplicated(stream: DataFrame, time: str, delay: str = "10 minutes") -> DataFrame:
    """Without repeated event keys within the watermark's delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_key"])


def rates(stream: DataFrame, time: str, every: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    """Events by kind in tumbling windows."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, every), "op").agg(F.count("*").alias("events"))

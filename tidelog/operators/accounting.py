"""Counters, gauges, histograms and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Upper bounds of the duration histogram in seconds (fixed values).
BUCKETS = (0.001, 0.01, 0.1, 0.5, 1.0, 2.5, 5.0, 10.0)


def counters(df: DataFrame, labels: list[str], name: str = "events") -> DataFrame:
    return df.groupBy(*labels).agg(F.count("*").alias(name))


def histogram(df: DataFrame, seconds: Column, labels: list[str], buckets: tuple[float, ...] = BUCKETS) -> DataFrame:
    """Cumulative counts by bound `le`, one pass: a sum for each bound, then a row for each."""
    sums = [F.sum(F.when(seconds <= b, 1).otherwise(0)).alias(f"b{i}") for i, b in enumerate(buckets)]
    wide = df.groupBy(*labels).agg(*sums, F.count("*").alias("total"), F.sum(seconds).alias("sum"))
    rows = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)], F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("n")))
    return wide.select(*labels, F.explode(rows).alias("x")).select(*labels, "x.le", "x.n")


def nearest_rank(df: DataFrame, value: str, labels: list[str], shares: dict[str, float]) -> DataFrame:
    """The value at 0-based place floor(n * share) of the sorted ones, for each label. Rows are counted by value before they move, so a task gets the distinct values of a label."""
    counted = df.groupBy(*labels, value).agg(F.count("*").alias("__c"))
    w = Window.partitionBy(*labels)
    placed = counted.withColumns({"__to": F.sum("__c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)), "__n": F.sum("__c").over(w)})
    at = lambda s: F.floor(F.col("__n") * F.lit(s))
    return placed.groupBy(*labels).agg(*[F.max(F.when((at(s) < F.col("__to")) & (at(s) >= F.col("__to") - F.col("__c")), F.col(value))).alias(k) for k, s in shares.items()])


def moving_rate(batches: DataFrame, events: str, at_us: str, labels: list[str], last: int = 10) -> DataFrame:
    """Mean of the last samples of events a second; the first batch and those without time since the one before give none."""
    w = Window.partitionBy(*labels).orderBy("batch_id")
    gap = (F.col(at_us) - F.lag(at_us).over(w)).cast("double") / F.lit(1e6)
    sampled = batches.withColumn("gap_s", gap).filter("gap_s > 0").withColumn("rate", F.col(events).cast("double") / F.col("gap_s"))
    return sampled.withColumn("moving_rate", F.avg("rate").over(w.rowsBetween(1 - last, 0)))


def backlog(captured: DataFrame, committed: DataFrame, labels: list[str]) -> DataFrame:
    """Events captured and not committed, by destination."""
    a, b = captured.groupBy(*labels).agg(F.count("*").alias("captured")), committed.groupBy(*labels).agg(F.sum("events").alias("committed"))
    return a.join(b, labels, "left").select(*labels, (F.col("captured") - F.coalesce("committed", F.lit(0))).alias("backlog"))


def sink_statistics(batches: DataFrame) -> DataFrame:
    """Of each destination, from its log of batches (destination, batch_id, events, failed, at_us): events written, errors, the last error's batch, and events a second from first to last write."""
    good = F.when(~F.col("failed"), F.col("events"))
    seconds = (F.max(F.when(~F.col("failed"), F.col("at_us"))) - F.min(F.when(~F.col("failed"), F.col("at_us")))).cast("double") / F.lit(1e6)
    return batches.groupBy("destination").agg(
        F.coalesce(F.sum(good), F.lit(0)).alias("events_written"), F.count_if("failed").alias("errors_count"), F.max(F.when(F.col("failed"), F.col("batch_id"))).alias("last_error_batch"),
        F.when(seconds > 0, F.sum(good).cast("double") / seconds).alias("events_per_second"),
    )


def rollup_health(checks: DataFrame, labels: list[str]) -> DataFrame:
    return checks.groupBy(*labels).agg(F.coalesce(F.bool_and(F.col("status") == "up"), F.lit(False)).alias("healthy"), F.count("*").alias("dependencies"))


def chunks(df: DataFrame, time: str, every: str = "month") -> DataFrame:
    """The time partition of each row, as chunk_start."""
    return df.withColumn("chunk_start", F.date_trunc(every, time))

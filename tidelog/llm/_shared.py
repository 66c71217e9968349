"""Folders, tables and Arrow chunks that the operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.shipping import ship

#: Bytes of text that a worker handles at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18
#: Bytes of the Arrow batches between the JVM and the workers, about; a larger row is a batch of its own.
BATCH_BYTES = 4 << 20
#: Up to so many bytes are broadcast, behind a count of them; beyond, tables are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        if got.isDefined():
            return got.get()
        found = tempfile.mkdtemp(prefix="tidelog-")
        spark.sparkContext.setCheckpointDir(found)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """The shared folder as a mounted path, for files that workers map into memory."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if ":" in path.split("/")[0]:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {path}")
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and a lost executor costs no recomputation."""
    return _through(df, new_path(df.sparkSession, name))


def _through(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Stages:
    """The staged tables of one operator, deleted when it ends, however it ends; result() alone stays."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.home, self.n = spark, new_path(spark, name), 0

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        drop_path(self.spark, self.home)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        return _through(df, f"{self.home}/{self.n}-{name}")

    def result(self, df: DataFrame) -> DataFrame:
        return _through(df, f"{self.home}-result")


def if_small(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A staged table, marked for broadcast if its rows, of at most row_bytes bytes each, are within the bound; else for a join that Spark may split."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df.hint("shuffle_merge")


def release() -> None:
    """Give memory that a task no longer uses back to the system, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries do so of themselves
        pass


def bounded(spark: SparkSession) -> SparkSession:
    """The package is on the executors and Arrow batches hold BATCH_BYTES at most, whatever the rows' number."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return ship(spark)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """run() over each partition's batches of bounded size."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            release()

    bounded(df.sparkSession)
    return df.mapInArrow(tidy, schema)


def map_groups(grouped, spark: SparkSession, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    def tidy(table):
        try:
            return run(table)
        finally:
            release()

    bounded(spark)
    return grouped.applyInArrow(tidy, schema)


def as_text(column: pa.Array) -> pa.Array:
    """Texts with nulls as empty, with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def offsets(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def text_bytes(column: pa.Array) -> np.ndarray:
    off, data = offsets(column), column.buffers()[2] if len(column) else None
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Row ranges of about `most` bytes of text, each with its text column."""
    for batch in batches:
        column = as_text(batch.column(text))
        off, at = offsets(column), 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), column.slice(at, to - at)
            at = to


def map_chunks(df: DataFrame, per_chunk: Callable[..., pa.RecordBatch], schema: str, text: str = "text", setup: Callable | None = None, most: int = CHUNK_BYTES) -> DataFrame:
    """per_chunk over all rows; setup() is called once in each task and its result handed on."""

    def run(batches):
        extra = (setup(),) if setup else ()
        for batch, column in chunks(batches, text, most):
            yield per_chunk(batch, column, *extra)

    return map_batches(df, run, schema)


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def kept(documents: DataFrame, keep: list[str] | None, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """__id, __text and the columns of `keep`, each column once; and where each `kept_` column is."""
    home, columns = {}, [F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text")]
    for i, c in enumerate(keep or []):
        home[f"kept_{c}"] = "__id" if c == doc_id else "__text" if c == text else f"__k_{i}"
        if c not in (doc_id, text):
            columns.append(F.col(f"`{c}`").alias(f"__k_{i}"))
    return documents.select(*columns), home


def carried(batch: pa.RecordBatch, home: dict[str, str]) -> dict[str, pa.Array]:
    return {name: batch.column(at) for name, at in home.items()}


def carried_schema(source: DataFrame, home: dict[str, str]) -> str:
    return "".join(f", `{name}` {source.schema[at].dataType.simpleString()}" for name, at in home.items())

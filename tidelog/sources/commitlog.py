"""Segments of a commit log: files CommitLog-<a>-<b>.log of frames, a 4-byte big-endian length and that many bytes.

An entry is an operation byte, I, U or D, and a JSON object {keyspace, table, pk, ck, cols, ts, ttl}. A frame of length 0
or over 100,000,000, or one cut off by the file's end, ends its file: a reader comes back to that place when the file has
grown. Entries that can't be read are marked, not dropped.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidelog.model import PAYLOAD
from tidelog.shipping import ship

LARGEST = 100_000_000
_FRAMES = "commitlog_file string, position bigint, next_position bigint, entry binary"


def frames(content: bytes, start: int = 0):
    """Place, next place and entry of each whole frame from `start` on."""
    at = start
    while at + 4 <= len(content):
        (size,) = struct.unpack_from(">I", content, at)
        if not 0 < size <= LARGEST or at + 4 + size > len(content):
            return
        yield at, at + 4 + size, content[at + 4 : at + 4 + size]
        at += 4 + size


def _batches(name: str, found, bytes_: int = 4 << 20):
    """Frames of a file as record batches of bounded size, as they are read."""
    held, size = [], 0
    for f in found:
        held.append((name, *f))
        size += len(f[2]) + 64
        if size >= bytes_:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["commitlog_file", "position", "next_position", "entry"])


def order_of(name: Column) -> Column:
    """A segment's two numbers: names sort by them, not as text."""
    return F.struct(*[F.regexp_extract(name, r"CommitLog-(\d+)-(\d+)\.log", i).cast("bigint").alias(f"n{i}") for i in (1, 2)])


def read_frames(spark: SparkSession, folder: str, start: dict[str, int] | None = None) -> DataFrame:
    """commitlog_file, position, next_position, entry of all segments; `start` has a place for files read before."""
    begin = start or {}

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                name = path.rsplit("/", 1)[-1]
                yield from _batches(name, frames(content, begin.get(name, 0)))

    files = ship(spark).read.format("binaryFile").option("pathGlobFilter", "CommitLog-*.log").load(folder).select("path", "content")
    return files.mapInArrow(run, _FRAMES)


def parse(rows: DataFrame) -> DataFrame:
    """Generic events of frames, with `parse_error` where an entry can't be read."""
    op = F.substring(F.col("entry"), 1, 1).cast("string")
    body = F.from_json(F.expr("substring(entry, 2)").cast("string"), PAYLOAD)
    kind = F.when(op == "I", "INSERT").when(op == "U", "UPDATE").when(op == "D", "DELETE")
    error = F.when(F.octet_length("entry") < 10, "entry of less than 10 bytes").when(kind.isNull(), "unknown operation").when(F.col("b.table").isNull(), "unreadable payload")
    none = F.create_map().cast("map<string,string>")
    return rows.withColumn("b", body).select(
        F.concat_ws(":", "commitlog_file", F.col("position").cast("string")).alias("event_id"), kind.alias("event_type"), F.col("b.table").alias("table_name"), F.col("b.keyspace").alias("keyspace"), F.coalesce("b.pk", none).alias("partition_key"),
        F.coalesce("b.ck", none).alias("clustering_key"), F.coalesce("b.cols", none).alias("columns"), F.col("b.ts").alias("timestamp_micros"), F.col("b.ttl").alias("ttl_seconds"), "commitlog_file", "position", error.alias("parse_error"),
    )


def parse_plain(rows: DataFrame, now_us: int, keyspace: str = "ecommerce") -> DataFrame:
    """Generic events of entries without a payload: the operation byte and the table's name are all that is read, the rest is made up as fixed."""
    text, op = F.col("entry").cast("string"), F.substring(F.col("entry"), 1, 1).cast("string")
    kind = F.when(op == "I", "INSERT").when(op == "U", "UPDATE").when(op == "D", "DELETE")
    error = F.when(F.octet_length("entry") < 10, "entry of less than 10 bytes").when(kind.isNull(), "unknown operation")
    table = F.when(text.contains("time_series"), "time_series").when(text.contains("sessions"), "sessions").otherwise("users")
    none = F.create_map().cast("map<string,string>")
    # Fixed values.
    cells = F.create_map(F.lit("email"), F.lit("parsed@example.com"), F.lit("age"), F.lit("30"))
    return rows.select(
        F.concat_ws(":", "commitlog_file", F.col("position").cast("string")).alias("event_id"), kind.alias("event_type"), table.alias("table_name"), F.lit(keyspace).alias("keyspace"), F.create_map(F.lit("user_id"), F.expr("uuid()")).alias("partition_key"),
        F.when(table == "time_series", F.create_map(F.lit("timestamp"), F.lit(str(now_us)))).otherwise(none).alias("clustering_key"), F.when(kind == "DELETE", none).otherwise(cells).alias("columns"), F.lit(now_us).cast("bigint").alias("timestamp_micros"),
        F.when(text.contains("TTL "), 3600).alias("ttl_seconds"), "commitlog_file", "position", error.alias("parse_error"),
    )


def read_events(spark: SparkSession, folder: str, keyspace: str | None = None, table: str | None = None, start_file: str | None = None, start_position: int = -1) -> tuple[DataFrame, DataFrame]:
    """Events in log order after a place, and the entries that can't be read. An unknown start file means from the oldest."""
    rows = read_frames(spark, folder)
    if start_file:
        here, first = order_of(F.col("commitlog_file")), order_of(F.lit(start_file))
        rows = rows.filter((here > first) | ((here == first) & (F.col("position") > start_position)))
    found = parse(rows)
    good = found.filter("parse_error IS NULL").drop("parse_error")
    if keyspace:
        good = good.filter(F.col("keyspace") == keyspace)
    if table:
        good = good.filter(F.col("table_name") == table)
    return good, found.filter("parse_error IS NOT NULL")


def encode(events: DataFrame) -> DataFrame:
    """commitlog_file, order and frame of events that have those two columns; absent cells stay absent, nulls stay null."""
    body = F.to_json(F.struct(F.col("keyspace"), F.col("table_name").alias("table"), F.col("partition_key").alias("pk"), F.col("clustering_key").alias("ck"), F.col("columns").alias("cols"), F.col("timestamp_micros").alias("ts"), F.col("ttl_seconds").alias("ttl")), {"ignoreNullFields": "false"})
    entry = F.encode(F.concat(F.substring("event_type", 1, 1), body), "UTF-8")
    length = F.expr("unhex(lpad(hex(octet_length(e)), 8, '0'))")
    return events.withColumn("e", entry).select("commitlog_file", "seq", F.concat(length, F.col("e")).alias("frame"))


def write_segments(events: DataFrame, folder: str) -> None:
    """A file for each commitlog_file, its frames in order of seq, in a folder that all executors have mounted; files are replaced whole."""
    os.makedirs(folder, exist_ok=True)

    def run(batches):
        out, name, temp = None, None, None

        def close():
            if out:
                out.close()
                os.replace(temp, f"{folder}/{name}")

        for b in batches:
            for file, frame in zip(b.column("commitlog_file").to_pylist(), b.column("frame").to_pylist(), strict=True):
                if file != name:
                    close()
                    name, temp = file, f"{folder}/.{file}.{uuid.uuid4().hex}"
                    out = open(temp, "wb")  # noqa: SIM115
                out.write(frame)
        close()
        yield from ()

    ship(events.sparkSession)
    encode(events).repartition("commitlog_file").sortWithinPartitions("commitlog_file", "seq").mapInArrow(run, "x int").count()


def ends(f: BinaryIO, start: int, most: int) -> tuple[list[int], int]:
    """Ends of pieces of at most `most` bytes, or one frame, from `start` on, and how many frames they hold. Only the frames' lengths are read."""
    f.seek(0, os.SEEK_END)
    size, at, out, n = f.tell(), start, [], 0
    piece = start
    while at + 4 <= size:
        f.seek(at)
        (length,) = struct.unpack(">I", f.read(4))
        if not 0 < length <= LARGEST or at + 4 + length > size:
            break
        if at > piece and at + 4 + length - piece > most:
            out.append(at)
            piece = at
        at, n = at + 4 + length, n + 1
    return (out + [at] if at > start else out), n


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int


class CommitLogSource(DataSource):
    """spark.readStream.format("commitlog").option("path", folder): frames of growing segments, each from the place it was left at.

    The driver lists files and reads the frames' lengths; executors read the frames, a task for each `piecebytes` of a
    file. The folder must be mounted on them. A trigger takes `maxpieces` pieces at most, but for the first one after a start.
    """

    @classmethod
    def name(cls) -> str:
        return "commitlog"

    def schema(self) -> str:
        return _FRAMES

    def streamReader(self, schema):
        return _Reader(self.options["path"], int(self.options.get("piecebytes", 32 << 20)), int(self.options.get("maxpieces", 0)))


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, most: int, pieces: int):
        self.folder, self.most, self.pieces, self.at = folder, most, pieces, None

    def _names(self) -> list[str]:
        names = [n for n in os.listdir(self.folder) if re.fullmatch(r"CommitLog-\d+-\d+\.log", n)] if os.path.isdir(self.folder) else []
        return sorted(names, key=lambda n: tuple(map(int, re.findall(r"\d+", n))))

    def _cut(self, name: str, start: int) -> list[int]:
        with open(f"{self.folder}/{name}", "rb") as f:
            return ends(f, start, self.most)[0]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Places by file. In order of files, so that a limit leaves the later ones."""
        out, left = dict(self.at or {}), self.pieces if self.at is not None and self.pieces else 1 << 62
        for name in self._names():
            cuts = self._cut(name, out.get(name, 0))[:left]
            if cuts:
                out[name], left = cuts[-1], left - len(cuts)
            if not left:
                break
        return out

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        self.at = dict(end)
        out = []
        for name, stop in end.items():
            begin = start.get(name, 0)
            for cut in self._cut(name, begin) if stop > begin else ():
                if cut > stop:
                    break
                out.append(Piece(f"{self.folder}/{name}", begin, cut))
                begin = cut
            if begin < stop:
                out.append(Piece(f"{self.folder}/{name}", begin, stop))
        return out

    def read(self, piece: Piece):
        with open(piece.path, "rb") as f:
            f.seek(piece.start)
            name, at = piece.path.rsplit("/", 1)[-1], piece.start
            while at < piece.end:
                (length,) = struct.unpack(">I", f.read(4))
                yield name, at, at + 4 + length, f.read(length)
                at += 4 + length

    def commit(self, end: dict) -> None:
        pass


__all__ = ["CommitLogSource", "encode", "frames", "order_of", "parse", "parse_plain", "read_events", "read_frames", "write_segments"]

"""Token ids in ORC files, in ascending order of document.

Documents are dealt out by ranges of doc_id, and of a hash of the text within one, encoded and written in that order:
stripes with run-length encoded integer columns, row indexes, and Bloom filters on doc_id, so that readers take stripes in
parallel and skip those without the documents they want. A row has its place in its file; a file's place follows from the files' totals, a row for each.
"""

from __future__ import annotations

import json
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidelog.llm._shared import bounded, chunks, if_small, map_batches, new_path, stage
from tidelog.llm.bpe import _byte_chars

#: Bytes of text in a file, about; and of a stripe, of which a file has several.
FILE_BYTES, STRIPE_BYTES = 32 << 20, 4 << 20
#: Rows between two entries of a row index.
STRIDE = 1000
#: Files whose places are summed together; their sums, one for each group, come to the driver.
TOGETHER = 1000
#: The split pattern that the library's byte-level pre-tokenizer has, as files of this kind don't hold it (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """A byte-level file of the `tokenizers` library, run by `tiktoken`, which gives the same ids several times as fast.

    Texts with characters that Python's Unicode tables lack go to the library itself, as the two may class those apart.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level file: {path}")
        byte = {c: i for i, c in enumerate(_byte_chars())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.odd = regex.compile(r"[^\x00-ɏ]").findall

    def __call__(self, text: str) -> np.ndarray:
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(self.odd(text))):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
                self.slow.no_truncation()
                self.slow.no_padding()
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")


_loaded: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def write(documents: DataFrame, out: str, path: str, end_id: int = 2, file_bytes: int = FILE_BYTES, stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE) -> None:
    """Write doc_id, part, place (ids of the file before this row), n_tokens and ids of every row.

    end_id follows each document's ids. Null and empty texts have it alone. Null doc_ids come first; rows of equal doc_id
    are in order of a hash of their texts. An empty table gives an empty file. Texts of any length are a row each. Other columns,
    of whatever names, aren't written.
    """
    spark = bounded(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        encode, part, place = load(path), TaskContext.get().partitionId(), 0
        for batch, column in chunks(batches):
            ids = [np.append(encode(t), np.uint32(end_id)) for t in column.to_pylist()]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            stop = np.cumsum(n)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "part": pa.array(np.full(len(n), part, np.int32)), "place": pa.array(place + stop - n), "n_tokens": pa.array(n),
                "ids": pa.ListArray.from_arrays(pa.array(np.append(0, stop).astype(np.int32)), pa.array(np.concatenate(ids).view(np.int32))),
            })
            place += int(stop[-1])

    source = documents.select("doc_id", "text")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes), spark.sparkContext.defaultParallelism)
    # By a hash of the text too, so that rows of one doc_id, such as null, may be dealt out over files.
    ordered = source.withColumn("h", F.xxhash64("text")).repartitionByRange(int(files), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    options = {"orc.create.index": "true", "orc.row.index.stride": str(stride), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(stripe_bytes), "orc.rows.between.memory.checks": "200"}
    map_batches(ordered, run, f"doc_id {kind}, part int, place bigint, n_tokens bigint, ids array<int>").write.options(**options).orc(out)


def _schema(kind: T.DataType | None) -> T.StructType:
    return T.StructType([T.StructField("doc_id", kind or T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def read_documents(spark: SparkSession, path: str, doc_ids: list, kind: T.DataType | None = None) -> DataFrame:
    """doc_id, n_tokens and ids of some documents. Files, stripes and index strides without them are skipped by their statistics and Bloom filters."""
    return spark.read.schema(_schema(kind)).orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def read_tokens(spark: SparkSession, path: str, kind: T.DataType | None = None) -> DataFrame:
    """The files' rows, with `start`: the ids of all documents before this one."""
    rows = spark.read.schema(_schema(kind)).orc(path)
    totals = stage(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("group", F.floor(F.col("part") / TOGETHER)), "totals")
    groups, base = [], 0
    for group, n in totals.groupBy("group").agg(F.sum("n")).orderBy("group").collect():  # a row for TOGETHER files
        groups.append((group, base))
        base += n
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = totals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bases = stage(within.join(F.broadcast(spark.createDataFrame(groups, "group bigint, first bigint")), "group").select("part", (F.col("first") + F.col("before")).alias("base")), "bases")
    return rows.join(if_small(bases, 32), "part").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, from what read_tokens() gives."""

    def run(batches):
        for b in batches:
            ids = b.column("ids")
            at = np.asarray(ids.offsets)
            values = np.asarray(ids.values).astype("<u4", copy=False)
            crc = [zlib.crc32(values[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "start": b.column("start"), "n_tokens": b.column("n_tokens"), "ids_crc32": pa.array(crc, pa.int64())})

    return map_batches(tokens, run, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_check(documents: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    spark = documents.sparkSession
    out = new_path(spark, "tokens")
    write(documents, out, path, end_id)
    return checksums(read_tokens(spark, out, documents.schema["doc_id"].dataType))

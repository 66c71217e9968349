"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are integers. The index, built once and staged, has blocks of rows; a block's postings (row, dimension, value)
stand in segments by quantised impact, the number of bits of the value's magnitude, highest first. For a query, segments
are added to the scores in that order, posting by posting. After each one, what a row can still get is bounded by the
query's length times that of the row's unprocessed part, and by the query's sum of magnitudes times the next impact. A
query stops with the proof that all but a few rows stay below its k-th best score, in this block or an earlier one of the
task; its later segments are never touched, and the few possible members are scored exactly, in integers. Without a
proof all segments are processed.

Queries are taken one block of bounded size after another: each is sent to the executors, answered by one pass over the
index, and given up. A task returns its k best of each query, so what moves is small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm._shared import Stages, bounded, map_batches, new_path, record

#: Bytes of queries that are on the driver and the executors at once, as 8-byte numbers.
QUERY_BYTES = 32 << 20
#: Rows of an index block, and queries scored together on it.
BLOCK, TOGETHER = 2048, 32
#: Possible members that are scored exactly rather than by further segments, as a part of the block.
REST = 1 / 64
#: More than the relative error of sums of doubles in scores and bounds.
ERROR = 1e-9


class Block:
    """The postings of some rows, in segments of falling impact and within one in order of row."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, row: np.ndarray, dim: np.ndarray, value: np.ndarray):
        self.rows, self.ids, self.row, self.dim, self.value = rows, ids, row, dim, value
        bits = np.frexp(np.abs(value).astype(np.float64))[1]
        self.bounds = np.concatenate(([0], np.flatnonzero(bits[1:] != bits[:-1]) + 1, [len(bits)])) if len(bits) else np.zeros(1, np.int64)
        self.touched = 0  #: postings that queries have processed
        n, square = len(rows), value.astype(np.float64) ** 2
        #: Of what is unprocessed after each segment: each row's length, and the greatest impact.
        self.left = [np.sqrt(np.bincount(row[end:], square[end:], minlength=n)) for end in self.bounds[1:]]
        self.next = [2.0 ** bits[end] if end < len(bits) else 0.0 for end in self.bounds[1:].tolist()]

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> Block:
        row, dim = np.nonzero(values)
        value = values[row, dim]
        order = np.argsort(-np.frexp(np.abs(value).astype(np.float64))[1], kind="stable")
        return cls(rows, ids, row[order], dim[order], value[order])

    def packed(self) -> dict:
        def least(x):
            kind = next((k for k in (np.int16, np.int32) if len(x) == 0 or (x.min() >= np.iinfo(k).min and x.max() <= np.iinfo(k).max)), np.int64)
            return np.array([np.dtype(kind).itemsize], np.uint8).tobytes() + x.astype(kind).tobytes()

        return {"rows": self.rows.astype(np.int64).tobytes(), "ids": self.ids.astype(np.int64).tobytes()} | {k: least(getattr(self, k)) for k in ("row", "dim", "value")}

    @classmethod
    def unpacked(cls, packed: dict) -> Block:
        kinds = {2: np.int16, 4: np.int32, 8: np.int64}
        return cls(np.frombuffer(packed["rows"], np.int64), np.frombuffer(packed["ids"], np.int64), *(np.frombuffer(x[1:], kinds[x[0]]).astype(np.int64) for x in (packed[k] for k in ("row", "dim", "value"))))

    def best(self, asked: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        """Of queries (rows `asked`, of their own tables' numbers): query index, row index and exact score of all rows that may be among the k best and reach `floor`."""
        n, m = len(self.rows), len(queries)
        width = max(queries.shape[1], int(self.dim.max(initial=-1)) + 1)
        if width > queries.shape[1]:
            queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
        q = queries.astype(np.float64)
        length, total = np.sqrt((q**2).sum(axis=1)), np.abs(q).sum(axis=1)
        scores = np.zeros((m, n))
        own = self.rows[None, :] == asked[:, None]
        open_, members = np.arange(m), []
        for nth, (begin, end) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            row, dim, value = self.row[begin:end], self.dim[begin:end], self.value[begin:end]
            self.touched += len(open_) * len(row)
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            scores[np.ix_(open_, row[first])] += np.add.reduceat(q[open_][:, dim] * value, first, axis=1)
            rest = np.minimum(length[open_, None] * self.left[nth], total[open_, None] * self.next[nth])
            rest = rest * (1 + ERROR) + ERROR * length[open_, None] * self.left[0] + ERROR * np.abs(scores[open_])
            low = np.where(own[open_], -np.inf, scores[open_] - rest)
            least = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), -np.inf)
            possible = (scores[open_] + rest >= np.maximum(least, floor[open_])[:, None]) & ~own[open_]
            done = (possible.sum(axis=1) <= max(k, n * REST)) | (end == len(self.row))
            which, row = np.nonzero(possible[done])
            members.append((open_[done][which], row))
            open_ = open_[~done]
            if not len(open_):
                break
        if not len(self.row):  # only zeros
            which, row = np.nonzero(~own)
            members.append((which, row))
        query, row = (np.concatenate(x) for x in zip(*members, strict=True))
        return query, row, self._exact(queries, query, row)

    def _exact(self, queries: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
        whole = np.zeros((len(self.rows), queries.shape[1]), np.int64)
        whole[self.row, self.dim] = self.value
        return np.einsum("ij,ij->i", queries[query], whole[row])


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id and v: floor(256 * x) of each component as double; vectors that are null or hold null or non-finite components are left out."""
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & fine).select(F.col(vec_id).cast("bigint").alias("id"), F.transform(x, lambda c: F.floor(c * 256).cast("bigint")).alias("v"))


def _matrix(column: pa.Array, width: int = 1) -> np.ndarray:
    """Vectors as rows; missing components are 0."""
    at = np.asarray(column.offsets)
    size = np.diff(at)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = np.asarray(column.values)[at[0] : at[-1]]
    return out


def _index(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            b = batch.slice(at, BLOCK)
            packed = Block.build(b.column("row").to_numpy(), b.column("id").to_numpy(), _matrix(b.column("v"))).packed()
            yield record(**{k: pa.array([x], pa.binary()) for k, x in packed.items()})


def _leading(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The k best of each query, in order of query, then score, then id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[keep], ids[keep], score[keep]


def _search(sent, k: int):
    def run(batches):
        asked, queries = sent.value
        held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        floor = np.full(len(asked), -np.inf)
        for batch in batches:
            for packed in batch.to_pylist():
                block, found = Block.unpacked(packed), [held]
                for q in range(0, len(asked), TOGETHER):
                    part = slice(q, q + TOGETHER)
                    query, row, score = block.best(asked[part], queries[part], k, floor[part])
                    found.append((query + q, block.ids[row], score))
                held = _leading(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
                # The k-th best so far is what later blocks have to reach.
                query, _, score = held
                full = np.flatnonzero(np.arange(len(query)) - np.searchsorted(query, query) == k - 1)
                floor[query[full]] = score[full]
        if len(held[0]):
            yield record(row=pa.array(asked[held[0]]), vec_id=pa.array(held[1]), score=pa.array(held[2]))

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller vec_id.

    Queries: rows whose vec_id is divisible by `every`; candidates: every row but the query's own. Rows are told apart by
    place, so repeated rows, or other vectors of the same vec_id, are candidates, and queries, each for itself. Vectors of
    different lengths are compared as if the shorter one ended in zeros, of any length. Rows of null vec_id take no part;
    other columns, of whatever names, don't matter. An empty table gives no rows. Components must stay within 2 ** 52 and
    scores within 2 ** 63.
    """
    spark = bounded(vectors.sparkSession)
    out = new_path(spark, "top")
    with Stages(spark, "topk") as stage:
        rows = stage(integers(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
        index = stage(map_batches(rows, _index, "rows binary, ids binary, row binary, dim binary, value binary"), "index")
        queries = rows.filter(F.col("id") % every == 0)
        count, width = queries.agg(F.count("*"), F.max(F.size("v"))).first()
        blocks = max(1, -(-(count * (width or 1) * 8) // QUERY_BYTES))
        for nth in range(blocks):
            block = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == nth)
            asked = block.toArrow().sort_by("row").combine_chunks()  # QUERY_BYTES, about
            values = _matrix(asked.column("v").combine_chunks(), width or 1) if len(asked) else np.zeros((0, 1), np.int64)
            sent = spark.sparkContext.broadcast((asked.column("row").to_numpy(), values))
            found = map_batches(index, _search(sent, k), "row bigint, vec_id bigint, score bigint")
            order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
            ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            named = ranked.join(block.select("row", F.col("id").alias("query_id")), "row")
            named.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score").write.mode("append").parquet(out)
            sent.destroy()
    return spark.read.schema("query_id bigint, rank int, vec_id bigint, score bigint").parquet(out)

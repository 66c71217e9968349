"""Benchmark decontamination by Wu-Manber multi-pattern search over word sequences.

Patterns are the benchmark's windows of `window` words; an item of fewer words is one pattern. Patterns of one length
share a shift table: for each block of two words that ends d words before a pattern's end, the smallest d. A search
position moves on by the shift of the block that ends there, so most words are never looked at. At a shift of zero the
pattern's last and first blocks choose a bucket, whose patterns are compared word by word, then byte by byte.

The benchmark is taken in blocks of bounded size, of which one at a time is on the driver and the executors. One block is
searched in a single pass over the documents, without join or shuffle. With more, each pass writes the places that it has
hit, and these are joined to the documents by id and a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import Stages, as_text, bounded, carried, carried_schema, drop_path, kept, map_chunks, new_path, record
from tidelog.llm._words import NOT_ALNUM, Words, mix, words

#: Bytes of benchmark text in one search table, which has about ten times as many; a longer item is a block of its own.
BLOCK_BYTES = 4 << 20
#: Words of a text that one search lane covers; lanes advance together.
LANE = 512
_U = np.uint64


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _U(0xD6E8FEB86659FD93) + b)


@dataclass
class Patterns:
    """All patterns of one length."""

    length: int
    shift: np.ndarray
    keys: np.ndarray  #: of the buckets, sorted
    bounds: np.ndarray  #: of each bucket in `first`
    first: np.ndarray  #: of each pattern, its first word in the table
    owned: np.ndarray  #: of each pattern, its items' bounds in `owners`
    owners: np.ndarray


@dataclass
class Table:
    ids: list[str]
    words: Words
    lengths: list[Patterns] = field(default_factory=list)


def compile_table(ids: list, texts: list[str | None], window: int) -> Table:
    w = words(as_text(pa.array(texts, pa.large_string())), NOT_ALNUM)
    out = Table(["" if x is None else str(x) for x in ids], w)
    sizes = np.minimum(w.count, window)
    for size in np.unique(sizes[sizes > 0]).tolist():
        mine = np.flatnonzero(sizes == size)
        n = w.count[mine] - size + 1
        first = np.repeat(w.first[:-1][mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
        rows = w.hash[first[:, None] + np.arange(size)]
        rows, at, which = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        pair = np.unique(np.stack((which.reshape(-1), np.repeat(mine, n)), 1), axis=0)  # a pattern, an item that holds it
        block = min(2, size)
        bits = max(12, int(len(rows) * size * 8 - 1).bit_length())
        shift = np.full(1 << bits, size - block + 1, np.uint32)
        for j in range(size - block + 1):
            h = _pair(rows[:, j], rows[:, j + 1]) if block == 2 else rows[:, j]
            np.minimum.at(shift, h & _U((1 << bits) - 1), np.uint32(size - block - j))
        key = _bucket(rows)
        order = np.argsort(key, kind="stable")
        keys, begin = np.unique(key[order], return_index=True)
        count = np.bincount(pair[:, 0], minlength=len(rows))
        begins = np.cumsum(count) - count
        owned = np.concatenate(([0], np.cumsum(count[order])))
        take = np.repeat(begins[order] - owned[:-1], count[order]) + np.arange(len(pair))
        out.lengths.append(Patterns(size, shift, keys, np.append(begin, len(rows)), first[at][order], owned, pair[take, 1]))
    return out


def _bucket(rows: np.ndarray) -> np.ndarray:
    """Of each pattern or window: its last block with its first one."""
    if rows.shape[1] == 1:
        return rows[:, 0].copy()
    return _pair(_pair(rows[:, -2], rows[:, -1]), _pair(rows[:, 0], rows[:, 1]))


def _candidates(w: Words, p: Patterns) -> np.ndarray:
    """Last words of the windows where the shift is zero."""
    n = np.maximum(0, w.count - p.length + 1)  # windows of each text
    lanes = -(-n // LANE)
    text = np.repeat(np.arange(len(n)), lanes)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = w.first[:-1][text] + p.length - 1 + nth * LANE
    stop = np.minimum(at + LANE, w.first[1:][text])
    mask, out = _U(len(p.shift) - 1), []
    while len(at):
        h = _pair(w.hash[at - 1], w.hash[at]) if p.length > 1 else w.hash[at]
        step = p.shift[h & mask].astype(np.int64)
        out.append(at[step == 0])
        at = at + np.maximum(step, 1)
        on = at < stop
        at, stop = at[on], stop[on]
    return np.concatenate(out) if out else np.zeros(0, np.int64)



def _same_bytes(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words i of a and j of b are equal in all bytes."""
    size = a.end[i] - a.start[i]
    out = size == b.end[j] - b.start[j]
    i, j, size = i[out], j[out], size[out]
    span = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    differ = a.data[np.repeat(a.start[i], size) + span] != b.data[np.repeat(b.start[j], size) + span]
    wrong = np.bincount(np.repeat(np.arange(len(i)), size)[differ], minlength=len(i)) > 0
    out[np.flatnonzero(out)[wrong]] = False
    return out


def occurrences(w: Words, t: Table, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """First words of windows that are patterns, and the patterns."""
    first = _candidates(w, p) - (p.length - 1)
    if not len(first):
        return first, first
    span = np.arange(p.length)
    windows = w.hash[first[:, None] + span]
    at = np.searchsorted(p.keys, key := _bucket(windows))
    at[at == len(p.keys)] = 0
    known = np.flatnonzero(p.keys[at] == key)
    sizes = (p.bounds[1:] - p.bounds[:-1])[at[known]]
    which = np.repeat(known, sizes)
    pattern = np.repeat(p.bounds[at[known]], sizes) + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    equal = (windows[which] == t.words.hash[p.first[pattern][:, None] + span]).all(axis=1)
    first, pattern = first[which[equal]], pattern[equal]
    # Each pair of words that equal windows put together is compared once.
    pair, place = np.unique(np.stack(((first[:, None] + span).reshape(-1), (p.first[pattern][:, None] + span).reshape(-1)), 1), axis=0, return_inverse=True)
    same = _same_bytes(w, pair[:, 0], t.words, pair[:, 1])[place.reshape(-1)].reshape(-1, p.length)
    ok = same.all(axis=1)
    return first[ok], pattern[ok]


def search(w: Words, t: Table) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether it is hit; pairs of a text and the index of an item, each once."""
    hit, found = np.zeros(len(w.hash) + 1, np.int64), [np.zeros((0, 2), np.int64)]
    for p in t.lengths:
        first, pattern = occurrences(w, t, p)
        np.add.at(hit, first, 1)
        np.add.at(hit, first + p.length, -1)
        each = np.unique(np.stack((w.doc[first], pattern), 1), axis=0)
        n = p.owned[each[:, 1] + 1] - p.owned[each[:, 1]]
        at = np.repeat(p.owned[each[:, 1]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        found.append(np.stack((np.repeat(each[:, 0], n), p.owners[at]), 1))
    return np.cumsum(hit)[:-1] > 0, np.unique(np.concatenate(found), axis=0)


def tables(benchmark: DataFrame, window: int, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Table]:
    """Search tables over all items, one after another, each of at most block_bytes of text or one item."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        n = len((row.t or "").encode())
        if ids and size + n > block_bytes:
            yield compile_table(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += n
    if ids:
        yield compile_table(ids, texts, window)


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


FOUND = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _found(n_words: np.ndarray, n_hit: np.ndarray, items: list, share: int) -> dict:
    return {"n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array([_digest(x) for x in items], pa.string()), "contaminated": pa.array((n_hit > 0) & (share * n_hit >= n_words))}


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, then the columns named in `keep`.

    Contaminated: n_hit > 0 and share * n_hit >= n_words. Null and empty texts have no words and are clean; texts of any
    length are searched whole. An item that occurs twice in the benchmark counts by its id once. Items of null id count as
    the empty string. Empty tables give no rows or no hits; repeated rows stay; other columns, of whatever names, are ignored.
    """
    spark = bounded(documents.sparkSession)
    blocks = tables(benchmark, window)
    first, second = next(blocks, None), next(blocks, None)
    if second is not None:
        return _in_turn(documents, chain((first, second), blocks), share, keep, doc_id, text)
    source, home = kept(documents, keep, doc_id, text)
    sent = spark.sparkContext.broadcast(first or Table([], words(as_text(pa.array([], pa.large_string())), NOT_ALNUM)))

    def per_chunk(batch, column):
        w = words(column, NOT_ALNUM)
        hit, pairs = search(w, sent.value)
        inside = np.concatenate(([0], np.cumsum(hit)))
        items: list[set[str]] = [set() for _ in range(len(column))]
        for d, i in pairs.tolist():
            items[d].add(sent.value.ids[i])
        return record(doc_id=batch.column("__id"), **_found(w.count, inside[w.first[1:]] - inside[w.first[:-1]], items, share), **carried(batch, home))

    return map_chunks(source, per_chunk, f"doc_id {source.schema['__id'].dataType.simpleString()}, {FOUND}{carried_schema(source, home)}", "__text")


def _in_turn(documents: DataFrame, blocks: Iterator[Table], share: int, keep: list[str] | None, doc_id: str, text: str) -> DataFrame:
    """contamination() with a pass over the documents for each block."""
    spark = documents.sparkSession
    source, home = kept(documents, keep, doc_id, text)
    key = F.xxhash64(F.coalesce(F.col("__id").cast("string"), F.lit("null")), F.coalesce("__text", F.lit("")))
    source = source.withColumn("__key", key)
    with Stages(spark, "hits") as stage:
        path = new_path(spark, "hits")
        for block in blocks:
            sent = spark.sparkContext.broadcast(block)

            def per_chunk(batch, column, sent=sent):
                w = words(column, NOT_ALNUM)
                hit, pairs = search(w, sent.value)
                out = {"__key": [], "places": [], "items": []}
                for d in np.unique(pairs[:, 0]).tolist():
                    lo, hi = w.first[d], w.first[d + 1]
                    out["__key"].append(batch.column("__key")[d].as_py())
                    out["places"].append(np.packbits(hit[lo:hi]).tobytes())
                    out["items"].append([sent.value.ids[i] for i in pairs[pairs[:, 0] == d, 1].tolist()])
                return record(__key=pa.array(out["__key"], pa.int64()), places=pa.array(out["places"], pa.binary()), items=pa.array(out["items"], pa.list_(pa.string())))

            map_chunks(source.select("__key", "__text"), per_chunk, "__key bigint, places binary, items array<string>", "__text").write.mode("append").parquet(path)
            sent.destroy()
        # A document's rows: one for each block at most.
        hits = spark.read.schema("__key bigint, places binary, items array<string>").parquet(path).groupBy("__key").agg(F.collect_set("places").alias("__places"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("__items"))
        hits = stage.result(hits)
        drop_path(spark, path)

    def per_chunk(batch, column):
        w = words(column, NOT_ALNUM)
        n_hit = np.zeros(len(column), np.int64)
        for d, places in enumerate(batch.column("__places").to_pylist()):
            if places:
                n_hit[d] = int(np.unpackbits(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in places])).sum())
        items = [x or [] for x in batch.column("__items").to_pylist()]
        return record(doc_id=batch.column("__id"), **_found(w.count, n_hit, items, share), **carried(batch, home))

    return map_chunks(source.join(hits, "__key", "left"), per_chunk, f"doc_id {source.schema['__id'].dataType.simpleString()}, {FOUND}{carried_schema(source, home)}", "__text")


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that aren't contaminated, with their own columns; for a benchmark of one block in one pass and without a join."""
    columns = documents.columns
    named = documents.toDF(*[f"c{i}" for i in range(len(columns))])
    ids = {"doc_id": f"c{columns.index('doc_id')}", "text": f"c{columns.index('text')}"}
    found = contamination(named, benchmark, keep=named.columns, **ids, **options)
    return found.filter(~F.col("contaminated")).select(*[F.col(f"kept_c{i}").alias(c) for i, c in enumerate(columns)])

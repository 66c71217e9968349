"""Removal of line runs that repeat across a corpus, by ranks of distributed prefix doubling.

A text is its sequence of line ids. Level 0 ranks the lines that occur twice; level k + 1 ranks pairs of level-k ranks at
a distance of 2 ** k lines, in sorted order, so equal ranks are equal runs of 2 ** k lines and the ranks sort suffixes as
a suffix array of that depth does. Positions whose rank is unique leave, as nothing agrees with them that far.

A run of l lines is named by its two overlapping runs of the largest power of two, so the suffixes that agree in l lines,
an interval of the suffix array with that common prefix, are a group of equal names. For each position the shortest run
of at least `min_words` words that begins there, and that ends there, is looked up: any longer repeated run is the union
of such ones, each with its earlier copy, so a document's overlapping ones are joined to its maximal repeated runs. The
interval's first position stays; the others' lines are deleted.

Only repeated lines take part, as numbers; texts are read twice and never sorted. All names, counts and first positions
come from sums and minima with partial aggregation and joins that Spark may split, so a very common line is no hot task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import BROADCAST_BYTES, Stages, bounded, map_batches, map_chunks, offsets, record, text_bytes
from tidelog.llm._words import SPACES, mix, powers, words

_U = np.uint64


def _key():
    """A document, told by its id and text; rows equal in both are one."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")


def lines(documents: DataFrame) -> DataFrame:
    """doc_id, key, i, h (hash) and w (words) of every line."""

    def per_chunk(batch, column):
        off = offsets(column) - offsets(column)[0]
        raw = text_bytes(column)
        broken = np.flatnonzero(raw == 10)
        size = np.bincount(np.searchsorted(off[:-1], broken, "right") - 1, minlength=len(column)) + 1
        doc = np.repeat(np.arange(len(column)), size)
        first = np.cumsum(size) - size
        i = np.arange(len(doc)) - np.repeat(first, size)
        end = np.empty(len(doc), np.int64)
        last = first + size - 1
        start = np.empty(len(doc), np.int64)
        inner = np.ones(len(doc), bool)
        inner[last] = False
        end[inner], end[last] = broken, off[1:]
        opened = np.ones(len(doc), bool)
        opened[first] = False
        start[opened], start[first] = broken + 1, off[:-1]
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], out=total[1:])
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0x9E3779B97F4A7C15))
        w = words(column, SPACES, fold=False)
        at = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        take = pa.array(doc)
        return record(doc_id=batch.column("doc_id").take(take), key=batch.column("key").take(take), i=pa.array(i.astype(np.int32)), h=pa.array(h.view(np.int64)), w=pa.array((at[1] - at[0]).astype(np.int32)))

    source = documents.select("doc_id", _key().alias("key"), "text").filter("text IS NOT NULL")
    return map_chunks(source, per_chunk, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, key bigint, i int, h bigint, w int")


def _ranks(keys: DataFrame, by: list[str], stage: Stages) -> DataFrame:
    """`by` and r, ascending in their order; only what occurs twice."""
    twice = keys.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1").select(*by)
    return stage(twice.orderBy(*by).withColumn("r", F.monotonically_increasing_id()), "ranks")


def _shortest(min_words: int):
    """For each document's repeated lines: runs of neighbours with just enough words from their first line on, or back from their last."""

    def run(batches):
        for b in batches:
            out = [[], [], []]
            at = np.asarray(b.column("x").offsets)
            rows = b.column("x").values
            i_all, w_all = np.asarray(rows.field("i")), np.asarray(rows.field("w"))
            for d, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                i, w = i_all[lo:hi].astype(np.int64), w_all[lo:hi].astype(np.int64)
                apart = np.flatnonzero(np.diff(i) != 1) + 1
                edge = np.concatenate(([0], apart, [len(i)]))
                run_of = np.searchsorted(edge, np.arange(len(i)), "right") - 1
                total = np.concatenate(([0], np.cumsum(w)))
                n = np.arange(len(i))
                stop = np.searchsorted(total, total[n] + min_words, "left")  # the first end with enough words
                ok = stop <= edge[run_of + 1]
                begin = np.searchsorted(total, total[n + 1] - min_words, "right") - 1  # the last start with enough
                back = (total[n + 1] - min_words >= 0) & (begin >= edge[run_of])
                s = np.concatenate((n[ok], begin[back]))
                e = np.concatenate((stop[ok], n[back] + 1))
                pair = np.unique(np.stack((s, e), 1), axis=0) if len(s) else np.zeros((0, 2), np.int64)
                out[0].append(np.full(len(pair), d))
                out[1].append(i[pair[:, 0]])
                out[2].append(pair[:, 1] - pair[:, 0])
            doc, s, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            take = pa.array(doc.astype(np.int64))
            yield record(doc_id=b.column("doc_id").take(take), key=b.column("key").take(take), s=pa.array(s.astype(np.int32)), l=pa.array(size.astype(np.int32)))

    return run


def _joined(batches):
    """Each document's overlapping or touching runs as one: its maximal runs, as s and the first line after it."""
    for b in batches:
        at, flat = np.asarray(b.column("x").offsets), b.column("x").values
        s, e = np.asarray(flat.field("s")).astype(np.int64), np.asarray(flat.field("e")).astype(np.int64)
        doc = np.repeat(np.arange(b.num_rows), np.diff(at))
        s, e = s[at[0] : at[-1]], e[at[0] : at[-1]]
        wide = (int(e.max(initial=0)) + 1) * doc  # documents lie apart on one line
        order = np.argsort(s + wide, kind="stable")
        s, e, doc, wide = s[order], e[order], doc[order], wide[order]
        reach = np.maximum.accumulate(e + wide) if len(e) else e
        new = np.concatenate(([True], (s + wide)[1:] > reach[:-1])) if len(s) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(s)) - 1 if len(first) else first
        count = np.bincount(doc[first], minlength=b.num_rows)
        cuts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(s[first].astype(np.int32)), pa.array((reach[last] - wide[last]).astype(np.int32) if len(first) else np.zeros(0, np.int32))], names=["s", "e"]))
        yield record(doc_id=b.column("doc_id"), key=b.column("key"), cut=cuts)


def repeated_runs(documents: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, key, cut: a row for each document with later copies, and in `cut` its maximal runs of lines s up to before e that consist of runs of at least min_words words with an earlier copy, in order of doc_id, then line.

    A row holds numbers of one document's lines; no list spans documents.
    """
    with Stages(bounded(documents.sparkSession), "lines") as stage:
        return stage.result(_repeated(documents, min_words, stage))


def _repeated(documents: DataFrame, min_words: int, stage: Stages) -> DataFrame:
    every = stage(lines(documents), "lines")
    ranks = _ranks(every, ["h"], stage)
    level = stage(every.join(ranks, "h").select("doc_id", "key", "i", "w", "r").dropDuplicates(["key", "i"]), "level")
    kind = every.schema["doc_id"].dataType.simpleString()
    grouped = level.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("i", "w"))).alias("x")).select("doc_id", "key", "x")
    windows = stage(map_batches(grouped, _shortest(min_words), f"doc_id {kind}, key bigint, s int, l int"), "windows")
    longest = windows.agg(F.max("l")).first()[0] or 0
    found, k = [windows.select("doc_id", "key", "s", "l", F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).limit(0)], 0
    level = level.select("key", "i", "r")
    while (1 << k) <= longest:
        mine = windows.filter((F.col("l") >= 1 << k) & (F.col("l") < 2 << k))
        named = mine.join(level.select("key", F.col("i").alias("s"), F.col("r").alias("a")), ["key", "s"])
        named = named.withColumn("t", F.col("s") + F.col("l") - (1 << k)).join(level.select("key", F.col("i").alias("t"), F.col("r").alias("b")), ["key", "t"]) if k else named.withColumn("b", F.lit(0).cast("bigint"))
        found.append(named.select("doc_id", "key", "s", "l", "a", "b"))
        if (2 << k) <= longest:
            pairs = stage(level.withColumnRenamed("r", "a").join(level.select("key", (F.col("i") - (1 << k)).alias("i"), F.col("r").alias("b")), ["key", "i"]), "pairs")
            level = stage(pairs.join(_ranks(pairs, ["a", "b"], stage), ["a", "b"]).select("key", "i", "r"), "level")
        k += 1
    all_ = found[0]
    for x in found[1:]:
        all_ = all_.union(x)
    all_ = stage(all_, "named")
    at = F.struct("doc_id", "key", "s")
    # Staged, so that both sides of the join below are shuffled for it alone and Spark may split a common run's rows.
    first = stage(all_.groupBy("l", "a", "b").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "first")
    later = all_.join(first.hint("shuffle_merge"), ["l", "a", "b"]).filter(at > F.col("first")).select("doc_id", "key", "s", (F.col("s") + F.col("l")).alias("e"))
    by_doc = later.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("s", "e")).alias("x")).select("doc_id", "key", "x")
    return map_batches(by_doc, _joined, f"doc_id {kind}, key bigint, cut array<struct<s:int,e:int>>")


def deduplicate_lines(documents: DataFrame, min_words: int = 50) -> DataFrame:
    """All documents with their own columns, the text without later copies, and n_lines and n_deleted.

    Lines end at a line break; equal lines are equal in all characters. A run is deleted with at least min_words words
    (of other than ASCII white space), wherever its earlier copy is, in another document or the same one; blank lines
    belong to runs like others. Null texts stay null with no lines; an empty text has one line. Rows equal in doc_id and
    text are one document and stay equal. Texts of any length take part whole. An empty table gives an empty one. Columns
    named n_lines or n_deleted already are replaced; others of whatever names stay.
    """
    columns = documents.columns
    runs = repeated_runs(documents, min_words).select(F.col("key").alias("__key"), F.col("cut").alias("__cut"))
    size = runs.agg(F.sum(F.size("__cut") * 8 + 64)).first()[0] or 0
    keyed = documents.withColumn("__key", _key()).join(F.broadcast(runs) if size <= BROADCAST_BYTES else runs.hint("shuffle_merge"), "__key", "left")

    def per_batch(batches):
        for b in batches:
            texts, cuts = b.column("text").to_pylist(), b.column("__cut").to_pylist()
            out, total, gone = [], [], []
            for t, cut in zip(texts, cuts, strict=True):
                n = 0 if t is None else t.count("\n") + 1
                dead = 0
                if cut:
                    rows, at, left = t.split("\n"), 0, []
                    for c in cut:
                        left += rows[at : c["s"]]
                        at, dead = c["e"], dead + c["e"] - c["s"]
                    t = "\n".join(left + rows[at:])
                out.append(t)
                total.append(n)
                gone.append(dead)
            kept = {c: b.column(c) for c in b.schema.names if c not in ("__cut", "__key", "text", "n_lines", "n_deleted")}
            yield pa.RecordBatch.from_pydict({c: (pa.array(out, pa.string()) if c == "text" else kept[c]) for c in names} | {"n_lines": pa.array(total, pa.int64()), "n_deleted": pa.array(gone, pa.int64())})

    names = [c for c in columns if c not in ("n_lines", "n_deleted")]
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in names)
    return map_batches(keyed, per_batch, f"{kinds}, n_lines bigint, n_deleted bigint")

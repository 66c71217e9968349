"""An interpolated modified Kneser-Ney model of word triples, counted in Spark and mapped into memory by the workers.

1. Words: tasks hand on their distinct words' hashes and counts, packed, a row for each shard of words; a shard ranks its
   words by count, which gives them numbers, small ones to frequent words, and writes them as sorted hash arrays.
2. Triples: tasks hand on their distinct (u, v, w) as packed numbers, a row for each shard. A triple's shard follows from
   v, so what a shard needs of (u, v) and of (v, w) meets there; a v of more than two shards' share is dealt out by u
   too, and its (v, w) are summed once more. A shard writes sorted hash arrays of its triples, contexts and pairs.
3. What shards know of single words is summed in the shards of words.

A hash array holds 32 bits of each 64-bit hash, in order, below an index of the bits before them; so two keys of a shard
of n entries are taken for one another with a chance below 2 ** -32 * 64, whatever n, and words with one of 2 ** -64.

    p(w | u v) = max(0, c(u v w) - D3(c)) / c(u v) + (D3 . N(u v)) / c(u v) * p(w | v)
    p(w | v)   = max(0, k(v w) - D2(k)) / K(v) + (D2 . N(v)) / K(v) * p(w)
    p(w)       = max(0, k(w) - D1(k)) / K + (D1 . M) / K / (V + 1)

c: counts; k(v w): distinct words before v w, or the count where v is a text's begin; k(w): distinct words before w; K:
their sums; N and M: how many of a context's counts are 1, 2 and more; D: discounts from the numbers of counts 1 to 4. Those
numbers take tokens for drawn one by one, and whole copies of texts, which fill the counts of triples in twos, would raise
D3(2) until a triple seen twice were less likely than one seen once. Copies don't count in k, so D3(2) and D3(3) are at
most as many times D3(1) as D2(2) and D2(3) are times D2(1). A context that training hasn't seen leaves all to the shorter one. Shard files are written by name and replaced whole, so a
task that runs twice leaves one file.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import Stages, bounded, carried, carried_schema, chunks, kept, local_path, map_batches, map_groups, new_path, record
from tidelog.llm._words import SPACES, mix, words
from tidelog.llm.language import remainder

#: Bytes of text for each shard of triples, about; their least number; and shards of words.
SHARD_BYTES, SHARDS, WORD_SHARDS = 24 << 20, 64, 16
#: Words that a task gathers before it hands on their distinct triples.
GATHERED = 1 << 21
#: Bytes of text in a chunk: more words of one chunk are looked up together.
CHUNK = 1 << 20
#: Of words in the middle of triples, those of more than so many shards' share are dealt out over shards.
SPREAD = 2
#: A number of this or more stands in a list of its own.
WIDE = 255
_U = np.uint64
#: Stands for a text's end: no hash of a word.
END = _U(0x1D3A5C7E9F2B4D60)
#: Numbers of what stands before a text's begin, and of that; words begin after them.
NONE, BEGIN, FIRST = 0, 1, 2


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place in it of every token: each text's words, then its end."""
    w = words(column, SPACES)
    n = len(column)
    token = np.full(len(w.hash) + n, END, _U)
    token[np.arange(len(w.hash)) + w.doc] = w.hash
    doc = np.repeat(np.arange(n), w.count + 1)
    return token, doc, np.arange(len(token)) - np.repeat(w.first[:-1] + np.arange(n), w.count + 1)


def _before(token: np.ndarray, place: np.ndarray, none, begin) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the one two before it and the one before it."""
    v, u = np.empty_like(token), np.empty_like(token)
    v[1:], u[2:] = token[:-1], token[:-2]
    v[place == 0], u[place == 0], u[place == 1] = begin, none, begin
    return u, v


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _summed(keys: list[np.ndarray], count: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the keys, in order, and their numbers, or the sums of their counts."""
    if not len(keys[0]):
        return keys, np.zeros(0, np.int64)
    bits = [max(1, int(k.max()).bit_length()) for k in keys]
    if sum(bits) > 64:
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        first = _runs(*keys)
        return [k[first] for k in keys], np.diff(np.append(first, len(order))) if count is None else np.add.reduceat(count[order], first)
    one = np.zeros(len(keys[0]), _U)
    for k, b in zip(keys, bits, strict=True):
        one = (one << _U(b)) | k.astype(_U)
    if count is None:
        one.sort()
    else:
        order = np.argsort(one)
        one, count = one[order], count[order]
    first = _runs(one)
    total = np.diff(np.append(first, len(one))) if count is None else np.add.reduceat(count, first)
    one, out = one[first], []
    for b in reversed(bits):
        out.append((one & _U((1 << b) - 1)).astype(np.int64))
        one = one >> _U(b) if b < 64 else one
    return out[::-1], total


def _varint(x: np.ndarray) -> bytes:
    """Numbers of seven bits a byte, least first; a byte's top bit says that another follows."""
    x = x.astype(_U)
    size = np.ones(len(x), np.int64)
    for k in range(1, 10):
        more = x >= _U(1 << (7 * k))
        if not more.any():
            break
        size += more
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[at[has] + k] = ((x[has] >> _U(7 * k)) & _U(127)).astype(np.uint8) | ((size[has] > k + 1).astype(np.uint8) << 7)
    return np.array([len(out)], np.int64).tobytes() + out.tobytes()


def _varints(blob: bytes, n: int) -> list[np.ndarray]:
    """n lists that _varint() has written one after another."""
    out, at = [], 0
    for _ in range(n):
        size = int(np.frombuffer(blob, np.int64, 1, at)[0])
        raw = np.frombuffer(blob, np.uint8, size, at + 8)
        at += 8 + size
        end = np.flatnonzero(raw < 128)
        start = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
        if size == len(end):
            out.append(raw.astype(np.int64))
            continue
        place = np.arange(size) - np.repeat(start, end - start + 1)
        out.append(np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), start))
    return out


def _restart(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at `first`."""
    total = np.cumsum(x)
    return total - np.repeat(total[first] - x[first], np.diff(np.append(first, len(x))))


def _pack(v: np.ndarray, u: np.ndarray, w: np.ndarray, c: np.ndarray) -> bytes:
    """Triples in order of v, u, w, as differences; counts of one as a bit."""
    first = _runs(v)
    du, dw = np.diff(u, prepend=0), np.diff(w, prepend=0)
    du[first] = u[first] + 1
    fresh = du != 0
    dw[fresh] = w[fresh]
    return b"".join(_varint(x) for x in (np.diff(v[first], prepend=0), np.diff(np.append(first, len(v))), du, dw << 1 | (c > 1), c[c > 1]))


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    dv, runs, du, dw, more = _varints(blob, 5)
    v = np.repeat(np.cumsum(dv), runs)
    u = _restart(du, np.cumsum(runs) - runs) - 1
    w = _restart(dw >> 1, np.flatnonzero(du))
    c = np.ones(len(v), np.int64)
    c[(dw & 1) == 1] = more
    return v, u, w, c


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _save(path: str, **arrays: np.ndarray) -> None:
    for name, x in arrays.items():
        own = f"{path}.{uuid.uuid4().hex}.tmp.npy"
        np.save(own, x)
        os.replace(own, f"{path}.{name}.npy")


def _narrow(x: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Numbers in a byte each, and a list of those that need more."""
    wide = np.flatnonzero(x >= WIDE)
    return {name: np.minimum(x, WIDE).astype(np.uint8), f"{name}-at": wide, f"{name}-wide": x[wide]}


def _index(sorted_hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted 64-bit hashes as 32 bits each below an index of the bits before them."""
    bits = max(1, min(32, int(len(sorted_hashes) // 32).bit_length()))
    top = (sorted_hashes >> _U(64 - bits)).astype(np.int64)
    return {"index": np.searchsorted(top, np.arange((1 << bits) + 1)).astype(np.int64), "low": ((sorted_hashes << _U(bits)) >> _U(32)).astype(np.uint32)}


def _find(index: np.ndarray, low: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of hashes in arrays of _index(), or -1."""
    bits = int(len(index) - 1).bit_length() - 1
    top, rest = (hashes >> _U(64 - bits)).astype(np.int64), ((hashes << _U(bits)) >> _U(32)).astype(np.uint32)
    lo, hi = index[top], index[top + 1]
    end = hi
    for _ in range(int((hi - lo).max(initial=0)).bit_length()):
        mid = (lo + hi) >> 1
        less = (mid < hi) & (low[np.minimum(mid, len(low) - 1)] < rest)
        lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
    at = np.minimum(lo, max(0, len(low) - 1))
    return np.where((lo < end) & (low[at] == rest), at, -1) if len(low) else np.full(len(hashes), -1)


def _hash(*numbers: np.ndarray) -> np.ndarray:
    h = np.full(len(numbers[0]), 0x243F6A8885A308D3, _U)
    for x in numbers:
        h = mix(h * _U(0xD6E8FEB86659FD93) + x.astype(_U))
    return h


def _write_table(path: str, hashes: np.ndarray, **columns: np.ndarray) -> None:
    order = np.argsort(hashes)
    arrays = _index(hashes[order])
    for name, x in columns.items():
        arrays |= _narrow(x[order], name)
    _save(path, **arrays)


def _shard(v: np.ndarray, other: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """Of triples by v and u: those of a hot v are dealt out by u too. Of pairs by v and w: likewise."""
    at = np.searchsorted(hot, v)
    at[at == len(hot)] = 0
    spread = hot[at] == v if len(hot) else np.zeros(len(v), bool)
    return (_hash(v, np.where(spread, other, 0)) % _U(shards)).astype(np.int64)


def _deal(to: np.ndarray, n: int):
    """Each shard with the rows that go there, in their order; none without rows."""
    order = np.argsort(to.astype(np.uint16) if n <= 1 << 16 else to, kind="stable")
    edge = np.searchsorted(to[order], np.arange(n + 1))
    for s in np.flatnonzero(np.diff(edge)).tolist():
        yield s, order[edge[s] : edge[s + 1]]


def _classes(x: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4, and more than 2."""
    return [int((x == i).sum()) for i in range(1, 5)] + [int((x > 2).sum())]


PARTS = "kind string, shard int, blob binary, classes array<bigint>"


def train(documents: DataFrame) -> dict:
    """Count and write a model of all rows' texts; what the workers need to use it. Null texts count as empty ones, texts of any length whole, repeated rows each time; no rows give a model that knows nothing."""
    spark = bounded(documents.sparkSession)
    texts = documents.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(max(SHARDS, -(-size // SHARD_BYTES)))
    home = local_path(new_path(spark, "lm"))
    os.makedirs(home, exist_ok=True)
    model = {"home": home, "shards": shards, "word_shards": max(WORD_SHARDS, shards // 16)}
    with Stages(spark, "lm-counts") as stage:
        model |= _count_words(texts, model, stage)
        model |= _count_triples(texts, model, stage)
    return model


def _count_words(texts: DataFrame, m: dict, stage: Stages) -> dict:
    home, shards, most, spread = m["home"], m["word_shards"], GATHERED, SPREAD

    def gather(batches):
        held, n = [], 0
        for _, column in chunks(batches, most=CHUNK):
            token, _, _ = _tokens(column)
            held.append(np.unique(token, return_counts=True))
            n += len(held[-1][0])
            if n > most:
                held = [merged(held)]
                n = len(held[0][0])
                if n > most / 2:
                    yield from deal(held.pop())
                    n = 0
        if held:
            yield from deal(merged(held))

    def merged(held):
        (h,), c = _summed([np.concatenate([x[0] for x in held])], np.concatenate([x[1] for x in held]))
        return h.view(_U), c

    def deal(found):
        h, c = found
        for s, part in _deal((mix(h) % _U(shards)).astype(np.int64), shards):
            yield record(shard=pa.array([s], pa.int32()), hashes=pa.array([h[part].tobytes()], pa.binary()), counts=pa.array([_varint(c[part])], pa.binary()))

    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        h, c = merged([(np.frombuffer(a.as_py(), _U), _varints(b.as_py(), 1)[0]) for a, b in zip(table.column("hashes"), table.column("counts"), strict=True)])
        order = np.lexsort((h, -c))
        rank = np.empty(len(h), np.uint32 if len(h) < 1 << 32 else np.int64)
        rank[order] = np.arange(len(h))
        _save(f"{home}/words-{shard}", name=h, rank=rank, **_narrow(c[order], "count"))
        return pa.table({"tokens": pa.array([int(c.sum())], pa.int64()), "types": pa.array([len(h)], pa.int64())})

    counted = map_batches(texts, gather, "shard int, hashes binary, counts binary")
    rows = stage(map_groups(counted.groupBy("shard"), texts.sparkSession, write, "tokens bigint, types bigint"), "words")
    tokens, types = rows.agg(F.sum("tokens"), F.sum("types")).first()
    tokens = tokens or 0

    def frequent(batches):
        reader = Reader(m)
        for b in batches:
            for s in b.column("id").to_pylist():
                if (count := reader.narrow(f"words-{s}", "count")) is not None:
                    often = np.flatnonzero(count(np.arange(min(len(count.low), int(m["shards"] / spread) + 1))) * m["shards"] > spread * tokens)
                    yield record(id=pa.array(FIRST + often * shards + s, pa.int64()))

    hot = map_batches(texts.sparkSession.range(shards), frequent, "id bigint").toArrow().column("id").to_numpy()  # half a row for each shard of triples at most
    return {"N": tokens, "V": types or 0, "hot": np.sort(hot)}


def _count_triples(texts: DataFrame, m: dict, stage: Stages) -> dict:
    home, shards, word_shards, hot, most = m["home"], m["shards"], m["word_shards"], m["hot"], GATHERED

    def gather(batches):
        reader, held, n = Reader(m), [], 0
        for _, column in chunks(batches, most=CHUNK):
            token, _, place = _tokens(column)
            names, at = np.unique(token, return_inverse=True)
            held.append((reader.numbers(names)[0][at], np.minimum(place, 2).astype(np.uint8)))
            n += len(token)
            if n > most:
                yield from deal(held)
                held, n = [], 0
        if held:
            yield from deal(held)

    def deal(held):
        token, place = _joined(held)
        names, local = np.unique(np.concatenate(([NONE, BEGIN], token)), return_inverse=True)
        local = local[2:]  # small numbers in the same order, so that a triple fits a word
        u, v = _before(local, place, NONE, BEGIN)
        (v, u, w), c = _summed([v, u, local], None)
        v, u, w = names[v], names[u], names[w]
        for s, part in _deal(_shard(v, u, shards, hot), shards):
            yield record(shard=pa.array([s], pa.int32()), blob=pa.array([_pack(v[part], u[part], w[part], c[part])], pa.binary()))

    def pairs(shard: int, name: str, v: np.ndarray, w: np.ndarray, k: np.ndarray) -> list[dict]:
        """Write whole (v, w), in order; what they say of single words, and their classes."""
        _write_table(f"{home}/{name}-{shard}", _hash(v, w), k=k)
        out = [{"kind": "classes", "shard": 0, "blob": b"", "classes": _classes(k)}]
        if len(v):
            first = _runs(v)
            of = [np.add.reduceat(x, first) for x in (k, (k == 1).astype(np.int64), (k == 2).astype(np.int64), (k > 2).astype(np.int64))]
            for s, part in _deal((v[first] - FIRST) % word_shards, word_shards):
                out.append({"kind": "context", "shard": s, "blob": b"".join(_varint(x[part]) for x in (v[first] - NONE, *of)), "classes": []})
            after, n = np.unique(w, return_counts=True)
            for s, part in _deal((after - FIRST) % word_shards, word_shards):
                out.append({"kind": "after", "shard": s, "blob": _varint(np.diff(after[part], prepend=0)) + _varint(n[part]), "classes": []})
        return out

    def table_of(rows: list[dict]) -> pa.Table:
        return pa.table({"kind": pa.array([r["kind"] for r in rows], pa.string()), "shard": pa.array([r["shard"] for r in rows], pa.int32()), "blob": pa.array([r["blob"] for r in rows], pa.binary()), "classes": pa.array([r["classes"] for r in rows], pa.list_(pa.int64()))})

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        v, u, w, c = _joined([_unpack(x.as_py()) for x in table.column("blob")])
        (v, u, w), c = _locally([v, u, w], c)
        real = u != NONE
        _write_table(f"{home}/triples-{shard}", _hash(u[real], v[real], w[real]), c=c[real])
        first = _runs(v[real], u[real])
        of = [np.add.reduceat(x, first) if len(first) else x for x in (c[real], *((y).astype(np.int64) for y in (c[real] == 1, c[real] == 2, c[real] > 2)))]
        h, once = _hash(u[real][first], v[real][first]), of[0] == 1
        _write_table(f"{home}/once-{shard}", h[once])
        _write_table(f"{home}/contexts-{shard}", h[~once], **{k: x[~once] for k, x in zip(("c", "n1", "n2", "n3"), of, strict=True)})
        (pv, pw), k = _locally([v, w], np.where(real, 1, c))
        spread = np.isin(pv, hot)
        out = [{"kind": "triples", "shard": 0, "blob": b"", "classes": _classes(c[real])}, *pairs(shard, "pairs", pv[~spread], pw[~spread], k[~spread])]
        pv, pw, k = pv[spread], pw[spread], k[spread]
        for s, part in _deal(_shard(pv, pw, shards, hot), shards):
            out.append({"kind": "hot", "shard": s, "blob": _pack(pv[part], pw[part], np.zeros(len(part), np.int64), k[part]), "classes": []})
        return table_of(out)

    def merge_hot(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        v, w, _, k = _joined([_unpack(x.as_py()) for x in table.column("blob")])
        (v, w), k = _locally([v, w], k)
        return table_of(pairs(shard, "hot", v, w, k))

    def write_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own = Reader(m).file(f"words-{shard}", "rank")
        sums = np.zeros((5, 0 if own is None else len(own)), np.int64)  # a shard without words may have what follows a begin
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True):
            if kind == "after":
                at, k = _varints(blob, 2)
                np.add.at(sums[4], (np.cumsum(at) - FIRST) // word_shards, k)
            else:
                at, *of = _varints(blob, 5)
                begin = at == BEGIN
                if begin.any():
                    _save(f"{home}/begin", sums=np.array([x[begin][0] for x in of]))
                for i, x in enumerate(of):
                    np.add.at(sums[i], (at[~begin] - FIRST) // word_shards, x[~begin])
        _save(f"{home}/stats-{shard}", **{k: x for name, s in zip(("c", "n1", "n2", "n3", "k"), sums, strict=True) for k, x in _narrow(s, name).items()})
        return pa.table({"k": pa.array([int(sums[4].sum())], pa.int64()), "classes": pa.array([_classes(sums[4])], pa.list_(pa.int64()))})

    spark = texts.sparkSession
    counted = map_batches(texts, gather, "shard int, blob binary")
    merged = stage(map_groups(counted.groupBy("shard"), spark, merge, PARTS), "triples")
    again = stage(map_groups(merged.filter("kind = 'hot'").groupBy("shard"), spark, merge_hot, PARTS), "hot")
    both = merged.union(again)
    said = both.filter("kind IN ('context', 'after')")
    totals = stage(map_groups(said.groupBy("shard"), spark, write_words, "k bigint, classes array<bigint>"), "totals")
    sums = [F.sum(F.col("classes")[i]).alias(f"n{i}") for i in range(5)]
    of = {r.kind: [r[f"n{i}"] or 0 for i in range(5)] for r in both.filter("kind IN ('triples', 'classes')").groupBy("kind").agg(*sums).collect()}
    of |= {"words": [x or 0 for x in totals.agg(*sums).first()]}
    d1, d2, d3 = (discounts(of.get(x, [0] * 4)[:4]) for x in ("words", "classes", "triples"))
    return {"K": totals.agg(F.sum("k")).first()[0] or 0, "M": [of["words"][0], of["words"][1], of["words"][4]], "D": [d1, d2, bounded_by(d3, d2)]}


def _locally(keys: list[np.ndarray], count: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """_summed() by numbers within the shard, which are smaller and in the same order."""
    names = np.unique(np.concatenate(keys))
    found, count = _summed([np.searchsorted(names, k) for k in keys], count)
    return [names[k] for k in found], count


def discounts(n: list[int]) -> list[float]:
    """Of counts 1, 2 and more, from the numbers of counts 1 to 4; where those are too few, what keeps discounts within the counts."""
    if min(n[:2]) == 0:
        return [0.5, 0.75, 1.0]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return [min(max(d, 0.05), top) for d, top in zip(raw, (0.95, 1.9, 2.8), strict=True)]


def bounded_by(d: list[float], below: list[float]) -> list[float]:
    """Discounts that don't grow more with the count than those of the order below."""
    return [d[0], *(min(x, d[0] * y / below[0]) for x, y in zip(d[1:], below[1:], strict=True))]


class Narrow:
    """Numbers that _narrow() has written."""

    def __init__(self, low: np.ndarray, at: np.ndarray, wide: np.ndarray):
        self.low, self.at, self.wide = low, at, wide

    def __call__(self, which: np.ndarray) -> np.ndarray:
        out = self.low[which].astype(np.int64)
        big = np.flatnonzero(out == WIDE)
        if len(big):
            out[big] = self.wide[np.searchsorted(self.at, which[big])]
        return out


class Reader:
    """A model's arrays, mapped as they are needed."""

    def __init__(self, model: dict):
        self.m, self.files = model, {}

    def file(self, table: str, name: str) -> np.ndarray | None:
        key = f"{table}.{name}"
        if key not in self.files:
            path = f"{self.m['home']}/{key}.npy"
            self.files[key] = (np.load(path, mmap_mode="r").view(np.ndarray) if os.path.getsize(path) > 4096 else np.load(path)) if os.path.exists(path) else None
        return self.files[key]

    def narrow(self, table: str, name: str) -> Narrow | None:
        low = self.file(table, name)
        return None if low is None else Narrow(low, self.file(table, f"{name}-at"), self.file(table, f"{name}-wide"))

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each distinct word's number, or -1, and its count."""
        out, count, n = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), self.m["word_shards"]
        for s, part in _deal((mix(hashes) % _U(n)).astype(np.int64), n):
            known = self.file(f"words-{s}", "name")
            if known is None or not len(known):
                continue
            at = np.searchsorted(known, hashes[part])
            at[at == len(known)] = 0
            hit = known[at] == hashes[part]
            rank = self.file(f"words-{s}", "rank")[at[hit]].astype(np.int64)
            out[part[hit]] = FIRST + rank * n + s
            count[part[hit]] = self.narrow(f"words-{s}", "count")(rank)
        return out, count

    def stats(self, number: np.ndarray) -> np.ndarray:
        """K, the classes of a context, and k of each word."""
        out, n = np.zeros((5, len(number)), np.int64), self.m["word_shards"]
        known = np.flatnonzero(number >= FIRST)
        for s, part in _deal((number[known] - FIRST) % n, n):
            rank = (number[known][part] - FIRST) // n
            for i, name in enumerate(("c", "n1", "n2", "n3", "k")):
                if (x := self.narrow(f"stats-{s}", name)) is not None:
                    out[i, known[part]] = x(rank)
        begin = number == BEGIN
        if begin.any() and (x := self.file("begin", "sums")) is not None:
            out[:4, begin] = x[:, None]
        return out

    def look_up(self, table: str, shard: np.ndarray, hashes: np.ndarray, columns: tuple[str, ...] = ()) -> np.ndarray:
        """Whether each hash is there, and its columns."""
        found = np.zeros((1 + len(columns), len(hashes)), np.int64)
        bits = _U(max(1, int(self.m["shards"] - 1).bit_length()))
        order = np.argsort((shard.astype(_U) << (_U(64) - bits)) | (hashes >> bits))  # by shard, then hash, in one sort
        hashes = hashes[order]
        edge = np.searchsorted(shard[order], np.arange(self.m["shards"] + 1))
        for s in np.flatnonzero(np.diff(edge)).tolist():
            part, index = slice(edge[s], edge[s + 1]), self.file(f"{table}-{s}", "index")
            if index is None:
                continue
            at = _find(index, self.file(f"{table}-{s}", "low"), hashes[part])
            hit = np.flatnonzero(at >= 0)
            found[0, part][hit] = 1
            for i, name in enumerate(columns):
                found[1 + i, part][hit] = self.narrow(f"{table}-{s}", name)(at[hit])
        out = np.empty_like(found)
        out[:, order] = found
        return out

    def probabilities(self, token: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """p of each token after those before it, and its count in training."""
        m, n = self.m, self.m["shards"]
        names, at = np.unique(token, return_inverse=True)
        number, count = self.numbers(names)
        w = number[at]
        u, v = _before(w, place, NONE, BEGIN)
        d1, d2, d3 = (np.array([0, *d]) for d in m["D"])
        own = self.stats(number)
        k = own[4][at]
        total = max(1, m["K"])
        rest = float(np.dot(d1[1:], m["M"])) / total if m["K"] else 1.0
        p = np.maximum(0, k - d1[np.minimum(k, 3)]) / total + rest / (m["V"] + 1)

        def blend(p, c, context, d):
            seen = np.maximum(1, context[0])
            upper = np.maximum(0, c - d[np.minimum(c, 3)]) / seen + (d[1] * context[1] + d[2] * context[2] + d[3] * context[3]) / seen * p
            return np.where(context[0] > 0, upper, p)

        before = own[:, np.concatenate(([0], at[:-1]))] if len(at) else own[:, at]
        before = np.where((place == 0)[None, :], self.stats(np.array([BEGIN])), before)
        known = np.flatnonzero((v >= 0) & (w >= 0))
        c = np.zeros(len(w), np.int64)
        spread = np.isin(v[known], m["hot"])
        for table, which in (("pairs", known[~spread]), ("hot", known[spread])):
            if len(which):
                c[which] = self.look_up(table, _shard(v[which], w[which], n, m["hot"]), _hash(v[which], w[which]), ("k",))[1]
        p = blend(p, c, before, d2)
        known = np.flatnonzero((place > 0) & (u >= 0) & (v >= 0))
        shard, h = _shard(v[known], u[known], n, m["hot"]), _hash(u[known], v[known])
        context = np.zeros((4, len(w)), np.int64)
        context[:2, known] = self.look_up("once", shard, h)[0]
        more = np.flatnonzero(context[0, known] == 0)
        context[:, known[more]] += self.look_up("contexts", shard[more], h[more], ("c", "n1", "n2", "n3"))[1:]
        # A triple is known only after a known context.
        there = (context[0, known] > 0) & (w[known] >= 0)
        c, which = np.zeros(len(w), np.int64), known[there]
        c[which] = self.look_up("triples", shard[there], _hash(u[which], v[which], w[which]), ("c",))[1]
        return blend(p, c, context, d3), count[at]


def score(documents: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every document, then the columns named in `keep`.

    base_score: log10 under single words with one added to each count; score: the model's. Null and empty texts are an
    end alone; texts of any length are scored whole. Rows are independent: repeated rows and other columns, of whatever
    names, play no part. A model of no texts gives equal chances to all.
    """
    source, home = kept(documents, keep)

    def run(batches):
        reader = Reader(model)
        for batch, column in chunks(batches, "__text", CHUNK):
            token, doc, place = _tokens(column)
            p, count = reader.probabilities(token, place)
            n = len(column)
            base = np.log10((count + 1) / (model["N"] + model["V"] + 1))
            yield record(
                doc_id=batch.column("__id"), n_tokens=pa.array(np.bincount(doc, minlength=n).astype(np.int64)), n_known=pa.array(np.bincount(doc[count > 0], minlength=n).astype(np.int64)),
                base_score=pa.array(np.bincount(doc, base, minlength=n)), score=pa.array(np.bincount(doc, np.log10(p), minlength=n)), **carried(batch, home),
            )

    return map_batches(source, run, f"doc_id {source.schema['__id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double{carried_schema(source, home)}")


def score_held_out(documents: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score; learned from the documents that aren't held out."""
    held = remainder("doc_id", folds) == fold
    model = train(documents.filter(~held).select("text"))
    found = score(documents.select("doc_id", "text", held.alias("held")), model, keep=["held"])
    return found.select("doc_id", F.col("kept_held").alias("held_out"), "n_tokens", "n_known", F.lit(model["N"]).cast("bigint").alias("train_tokens"), "base_score", "score")

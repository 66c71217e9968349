"""Near-duplicate documents by MinHash with tensored banding, each link confirmed on the full sets.

Two collections of `groups` groups of `rows` minhashes each: a table is named by a group of the first and a group of the
second, so groups ** 2 tables come from 2 * groups * rows minhashes. Two sets of similarity s share a table unless all
groups of a collection differ: with probability 1 - about 2 * (1 - s ** rows) ** groups, of 0.99998 at s = 0.8 with 3
rows and 16 groups; a link below a table's chance is still found through any chain of other links.

1. Equal sets become one node, named by a fingerprint.
2. In each table key the node that agrees most with the others is the pivot; each node is compared with
   one pivot, of its pivots the one that most nodes have.
3. The nodes near a pivot that are no link of it are compared with the others near it by their differences from it,
   within a task; enough links to join what they join come out, so a group of copies gives rows by its size.
4. Links make components; then, in each key, nodes outside its main component meet the pivots of those of others, and
   in the same way all nodes near those pivots.

First-collection keys that many nodes share are dealt out by the second collection too, by joins that Spark may split.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._components import components
from tidelog.llm._shared import Stages, bounded, if_small, map_batches, map_chunks, map_groups, record, stage
from tidelog.llm._words import SPACES, mix, shingles, words

ROWS, GROUPS = 3, 16
#: Chance that a pair at the threshold is passed over for too few equal hashes.
AMISS = 1e-5
#: A first-collection key of more nodes is dealt out by the second collection's keys.
HOT = 20_000
#: Members compared with one pivot in one task.
SALT = 128
#: Nodes of at least this similarity with their pivot, in percent, are compared among themselves by their differences from it.
NEAR = 50
#: Nodes of each side in one task of that.
AROUND = 256
_U = np.uint64


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def signatures(documents: DataFrame, shingle: int, rows: int, groups: int) -> DataFrame:
    """doc_id, n (size of the set), fp (its fingerprint), a and b (a hash for each group of the two collections; b's in 16 bits each), s (a's in 32 bits each)."""

    def per_chunk(batch, column):
        found, first = shingles(words(column, SPACES), shingle)
        n, full = np.diff(first), np.flatnonzero(np.diff(first))
        both = np.zeros((2 * groups, len(n)), _U)
        if len(full):
            at = first[:-1][full]
            for i, seed in enumerate(_seeds(2 * groups * rows)):
                x = found * seed
                x ^= x >> _U(29)
                x *= _U(0xBF58476D1CE4E5B9)
                least = np.minimum.reduceat(x, at)
                both[i // rows][full] = mix(both[i // rows][full] + least + _U(i))
        return record(doc_id=batch.column("doc_id"), n=pa.array(n), fp=pa.array(_fingerprints(found, first)), a=_lists(both[:groups].T.view(np.int64)), s=_packed(both[:groups].T.astype(np.uint32)), b=_packed(both[groups:].T.astype(np.uint16)))

    source = documents.select(F.col("doc_id"), F.col("text"))
    return map_chunks(source, per_chunk, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n bigint, fp bigint, a array<bigint>, s binary, b binary")


def _fingerprints(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each set, the same for equal sets; 0 for the empty one."""
    n, full = np.diff(first), np.flatnonzero(np.diff(first))
    fp = np.zeros(len(n), _U)
    if len(full):
        fp[full] = mix(np.add.reduceat(mix(found ^ _U(0xA5A5A5A5A5A5A5A5)), first[:-1][full]) ^ (n[full].astype(_U) << _U(40)))
    return fp.view(np.int64)


def _lists(matrix: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(matrix).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, max(1, matrix.shape[1]), dtype=np.int32)), pa.array(flat))


def _packed(matrix: np.ndarray) -> pa.Array:
    """A matrix, row by row, as binary."""
    width = matrix.shape[1] * matrix.dtype.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(np.arange(0, len(matrix) * width + 1, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(matrix))])


def _unpacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _small(x: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values, in sorted order."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def agreeing(groups: int, rows: int, percent: int) -> int:
    """Hashes of both collections in which two sets at the threshold agree but for a chance of AMISS; sets of half that similarity rarely do."""
    p, n, total = (percent / 100) ** rows, 2 * groups, 0.0
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > AMISS:
            return max(2, k)
    return n


def _whole_keys(batches, key: str):
    """Tables of whole keys, from batches in order of the key: each batch's keys that have ended, with what came before of the first."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy()
        last = int(np.searchsorted(k, k[-1], "left"))
        if last or held and held[0].column(key)[0].as_py() != k[-1]:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _in_task(cross: bool, percent: int, least: int):
    """Candidate pairs of the keys of one partition, in order of key. Stars: each node with the middle one of each key; cross: nodes outside the key's main component with the pivots of the key's other nodes."""

    def run(batches):
        for t in _whole_keys(batches, "k"):
            key, fp, n, b = *(t.column(x).to_numpy() for x in ("k", "fp", "n")), _unpacked(t.column("b"), np.uint16)
            if cross:
                comp, pivot, nth, a = *(t.column(x).to_numpy() for x in ("c", "p", "i")), _unpacked(t.column("s"), np.uint32)
            start = _small(key)
            stop = np.append(start[1:], len(key))
            out_u, out_v = [], []
            for lo, hi in zip(start[stop - start > 1].tolist(), stop[stop - start > 1].tolist(), strict=True):
                m = np.arange(lo, hi)
                if not cross:
                    # The node that agrees most with each table's commonest hash is nearest to all.
                    common = np.zeros(len(m), np.int64)
                    for j in range(b.shape[1]):
                        _, inverse, count = np.unique(b[m, j], return_inverse=True, return_counts=True)
                        common += inverse == count.argmax()
                    x = m[np.lexsort((fp[m], -common))[0]]
                    y = m[(b[m] == b[x]).any(axis=1) & (fp[m] != fp[x]) & _alike(n[m], n[x], percent)]
                    out_u.append(fp[y])
                    out_v.append(np.full(len(y), fp[x]))
                    continue
                names, inverse, count = np.unique(comp[m], return_inverse=True, return_counts=True)
                if len(names) < 2:
                    continue
                earlier = slice(0, int(nth[m[0]]))
                for x in m[inverse != count.argmax()]:
                    y = m[(comp[m] != comp[x]) & _alike(n[m], n[x], percent)]
                    share, same = b[y] == b[x], a[y] == a[x]
                    y = y[share.any(axis=1) & ~same[:, earlier].any(axis=1) & (share.sum(axis=1) + same.sum(axis=1) >= least)]
                    y = y[(pivot[y] != pivot[x]) & (pivot[x] != fp[y]) & (pivot[y] != fp[x])]  # those around one pivot have been compared
                    around = np.unique(pivot[y])  # a node meets the pivots of others, which stand for all around them
                    out_u.append(np.full(len(around), fp[x]))
                    out_v.append(around)
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_u, out_v))
            o = np.lexsort((v, u))
            u, v = u[o], v[o]
            first = np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1]))) if len(u) else np.zeros(0, bool)
            if first.any():
                yield record(u=pa.array(u[first]), v=pa.array(v[first]))

    return run


def _alike(a: np.ndarray, b, percent: int) -> np.ndarray:
    """Sizes of sets that can be similar enough."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _pairs(nodes: DataFrame, hot: DataFrame, cross: bool, percent: int, groups: int, rows: int, stage: Stages) -> DataFrame:
    """Candidate pairs u, v. nodes: fp, n, a, s, b, and for `cross` c (component) and p (pivot that it has been compared around, or itself). hot: keys dealt out by the second collection."""
    own = ["fp", "n", *(["c", "p", "s"] if cross else []), "b"]
    keyed = nodes.select(*own, F.posexplode("a").alias("i", "h")).select(*own, *(["i"] if cross else []), F.xxhash64("i", "h").alias("k"))
    marked = keyed.join(hot, "k", "left")
    dealt_out = marked.filter("hot IS NULL").drop("hot").repartition("k").sortWithinPartitions("k")
    even = map_batches(dealt_out, _in_task(cross, percent, agreeing(groups, rows, percent)), "u bigint, v bigint")
    second = F.posexplode(F.array(*[F.substring("b", 2 * j + 1, 2) for j in range(groups)])).alias("j", "g")
    dealt = marked.filter("hot IS NOT NULL").select("k", "fp", "n", *(["c", "p"] if cross else []), second).withColumn("k", F.xxhash64("k", "j", "g"))
    if not cross:
        least = dealt.groupBy("k").agg(F.min("fp").alias("v"))
        pairs = even.union(dealt.join(least, "k").select(F.col("fp").alias("u"), "v").filter("u <> v")).distinct()
        # Of a node's pivots the one that most nodes have, so a group of copies gathers around few: a pair for each node at most.
        pairs = stage(pairs, "pivots")
        liked = if_small(stage(pairs.groupBy("v").agg(F.count("*").alias("m")), "liked"), 32)
        return pairs.join(liked, "v").groupBy("u").agg(F.max(F.struct("m", "v")).alias("x")).select("u", F.col("x.v").alias("v"))
    sizes = dealt.groupBy("k", "c").agg(F.count("*").alias("m"))
    main = sizes.groupBy("k").agg(F.max(F.struct("m", "c")).alias("x"), F.count("*").alias("d")).filter("d > 1").select("k", F.col("x.c").alias("main"))
    mixed = dealt.join(main, "k")
    few = mixed.filter("c <> main").select("k", F.col("fp").alias("u"), F.col("c").alias("c2"), F.col("p").alias("p2"))
    pairs = mixed.select("k", "c", F.col("p").alias("v")).distinct().join(few, "k").filter("c <> c2 AND v <> p2").select("u", "v")
    return even.union(pairs).distinct()


def _jaccard(percent: int, near: int):
    """Rows in the order of (v, part): a pivot's set, then its members'. Gives the links; also other pairs of at least `near` percent, and all their sets' differences from the pivot's."""

    def run(batches):
        pivot = np.zeros(0, _U)
        for batch in batches:
            u, v, own, sets = (batch.column(c) for c in ("u", "v", "own", "s"))
            out: tuple = [], [], [], [], []
            for x, y, mine, s in zip(u.to_pylist(), v.to_pylist(), own.to_pylist(), sets, strict=True):
                values = np.frombuffer(s.as_buffer(), _U)
                if mine:
                    pivot = values
                    continue
                at = np.searchsorted(pivot, values)
                at[at == len(pivot)] = 0
                same = pivot[at] == values if len(pivot) else np.zeros(len(values), bool)
                common = int(same.sum())
                union = len(pivot) + len(values) - common
                link = 100 * common >= percent * union
                if not link and 100 * common < near * union:
                    continue
                differ = np.concatenate((values[~same], np.delete(pivot, at[same]))).tobytes()
                for column, value in zip(out, (x, y, len(values), link, differ), strict=True):
                    column.append(value)
            if out[0]:
                yield record(u=pa.array(out[0], pa.int64()), v=pa.array(out[1], pa.int64()), n=pa.array(out[2], pa.int64()), link=pa.array(out[3], pa.bool_()), x=pa.array(out[4], pa.binary()))

    return run


def _around(percent: int):
    """Of a pivot's near nodes, some that are no link of it (o) and others (m): links between them, enough to join what they join.

    The symmetric difference of two sets is that of their differences from the pivot, so only those are compared.
    """

    def run(table: pa.Table) -> pa.Table:
        fp, n, link, probe = (table.column(c).to_numpy() for c in ("u", "n", "link", "o"))
        sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("x")]
        o, m = np.flatnonzero(probe), np.flatnonzero(~probe)
        size = np.array([len(x) for x in sets], np.int64)
        element = np.concatenate([sets[i] for i in m]) if len(m) else np.zeros(0, _U)
        owner = np.repeat(np.arange(len(m)), size[m])
        order = np.argsort(element, kind="stable")
        element, owner = element[order], owner[order]
        root: dict[int, int] = {}

        def find(i: int) -> int:
            while root.setdefault(i, i) != i:
                root[i] = i = root[root[i]]
            return i

        u, v = [], []
        for i in o.tolist():
            lo, hi = np.searchsorted(element, sets[i], "left"), np.searchsorted(element, sets[i], "right")
            count = hi - lo
            at = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            both = np.bincount(owner[at], minlength=len(m))
            apart = size[i] + size[m] - 2 * both
            for j in np.flatnonzero((apart * (100 + percent) <= (n[i] + n[m]) * (100 - percent)) & (fp[m] != fp[i])).tolist():
                # All links of the pivot are one component already.
                a, b = (find(0 if link[k] else int(fp[k])) for k in (i, m[j]))
                if a != b:
                    root[max(a, b, key=lambda x: (x != 0, x))] = min(a, b, key=lambda x: (x != 0, x))
                    u.append(int(fp[i]))
                    v.append(int(fp[m[j]]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _compare_around(tried: DataFrame, percent: int, stage: Stages) -> DataFrame:
    """Links between the near nodes of each pivot, one of them marked `probe`. Blocks of AROUND nodes meet in a task, so a pivot of any number of nodes fits."""
    size = stage(tried.groupBy("v").agg(F.count("*").alias("all"), F.sum(F.col("probe").cast("int")).alias("out")).filter("out > 0 AND all > 1"), "sizes")
    blocks = lambda c: F.ceil(F.col(c) / AROUND).cast("int")
    rows = tried.join(if_small(size.select("v", blocks("all").alias("m"), blocks("out").alias("k")), 32), "v")
    block = lambda salt, n: F.pmod(F.xxhash64("u", F.lit(salt)), F.col(n)).cast("int")
    members = rows.select("u", "v", "n", "link", "x", F.lit(False).alias("o"), block(1, "m").alias("j"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    probes = rows.filter("probe").select("u", "v", "n", "link", "x", F.lit(True).alias("o"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"), block(2, "k").alias("i"))
    # Dealt out by block, not by pivot alone, as the join may have left them; in ranges of equal rows, so that no task gets several full blocks.
    met = members.union(probes).repartitionByRange("v", "i", "j").groupBy("v", "i", "j")
    return map_groups(met, tried.sparkSession, _around(percent), "u bigint, v bigint")


def _compare(documents: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, percent: int, near: int, stage: Stages) -> DataFrame:
    """u, v, n, link, x of pairs, by their full sets, as _jaccard() gives them. A set moves once to its node and once for each pair."""
    ids = pairs.select(F.col("u").alias("fp")).union(pairs.select(F.col("v").alias("fp"))).distinct()
    wanted = stage(nodes.join(ids, "fp").select("fp", F.col("doc").alias("doc_id")), "wanted")
    asked = wanted.select("doc_id").distinct()
    source = documents.select("doc_id", "text").join(if_small(asked, 16), "doc_id", "left_semi")

    def per_chunk(batch, column):
        found, first = shingles(words(column, SPACES), shingle)
        return record(fp=pa.array(_fingerprints(found, first)), s=pa.array([found[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()))

    sets = map_chunks(source, per_chunk, "fp bigint, s binary").join(if_small(wanted.select("fp"), 16), "fp", "left_semi")
    sets = stage(sets.dropDuplicates(["fp"]), "sets")
    size = stage(pairs.groupBy("v").agg(F.ceil(F.count("*") / SALT).cast("int").alias("parts")), "sizes")
    star = pairs.join(if_small(size, 24), "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int").alias("part"))
    members = star.join(sets.withColumnRenamed("fp", "u"), "u").select("u", "v", "part", F.lit(0).alias("own"), "s")
    pivots = star.select("v", "part").distinct().join(sets.withColumnRenamed("fp", "v"), "v").select(F.col("v").alias("u"), "v", "part", F.lit(1).alias("own"), "s")
    dealt = members.union(pivots).repartition("v", "part").sortWithinPartitions("v", "part", F.desc("own"))
    return map_batches(dealt, _jaccard(percent, near), "u bigint, v bigint, n bigint, link boolean, x binary")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, groups: int = GROUPS) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    A document's set: its distinct runs of `shingle` words; of fewer words, the whole sequence. Linked: 100 * size of the
    intersection >= percent * size of the union. component_id: the smallest doc_id reachable; kept: that one itself.
    Null, empty and wordless texts have the empty set and are linked with nothing. A document of null doc_id gets
    component_id null and is kept. Rows of equal doc_id share their links, and stay as they are. Other columns play no part.
    Very long texts are a set like others: hashed whole, in pieces of memory by their own length.
    """
    with Stages(bounded(documents.sparkSession), "neardup") as stage:
        return stage.result(_found(documents, shingle, percent, rows, groups, stage))


def _found(documents: DataFrame, shingle: int, percent: int, rows: int, groups: int, stage: Stages) -> DataFrame:
    # The input's partitions may be few and large: nothing below depends on them.
    found = stage(signatures(documents, shingle, rows, groups), "signatures")
    nodes = stage(found.filter("n > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("a").alias("a"), F.first("s").alias("s"), F.first("b").alias("b")), "nodes")
    counts = nodes.select(F.posexplode("a").alias("i", "h")).groupBy(F.xxhash64("i", "h").alias("k")).count()
    hot = stage(counts.filter(F.col("count") > HOT).select("k", F.lit(True).alias("hot")), "hot")
    stars = stage(_pairs(nodes, hot, False, percent, groups, rows, stage), "pairs")
    tried = stage(_compare(documents, nodes, stars, shingle, percent, NEAR, stage), "tried")
    links = stage(tried.filter("link").select("u", "v").union(_compare_around(tried.withColumn("probe", ~F.col("link")), percent, stage)), "links")
    # The joins keep one strategy at every size, so what moves grows with the input.
    labels = components(links, stage).withColumnRenamed("u", "fp").hint("shuffle_merge")
    around = tried.select(F.col("u").alias("fp"), F.col("v").alias("p")).hint("shuffle_merge")
    named = nodes.select("fp", "n", "a", "s", "b").join(labels, "fp", "left").join(around, "fp", "left").withColumns({"c": F.coalesce("c", "fp"), "p": F.coalesce("p", "fp")})
    across = stage(_pairs(named, hot, True, percent, groups, rows, stage), "pairs")
    # First each node meets one more pivot, of those offered the one with most nodes near it. A node with a link to one
    # of at least NEAR with that pivot is itself at least `far` like the pivot, as 1 - similarity is a distance.
    far = max(0, NEAR - (100 - percent))
    near = stage(tried.groupBy(F.col("v").alias("q")).agg(F.count("*").alias("m")), "near")
    offered = across.withColumnRenamed("v", "q").join(if_small(near, 32), "q", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    second = stage(offered.groupBy("u").agg(F.max(F.struct("m", "q")).alias("x")).select("u", F.col("x.q").alias("v")), "pairs")
    again = stage(_compare(documents, nodes, second, shingle, percent, far, stage), "tried")
    both = stage(tried.withColumn("probe", F.lit(False)).union(again.withColumn("probe", F.lit(True))), "near")
    more = stage(again.filter("link").select("u", "v").union(_compare_around(both, percent, stage)), "links")
    # Then the other pivots, and nodes without any, unless those were near the same one.
    home = both.select(F.col("u").alias("q"), F.col("v").alias("b"), F.lit(True).alias("met")).distinct()
    met = second.withColumnRenamed("v", "b").join(again.select("u", F.lit(True).alias("there")), "u", "left")
    left = offered.join(met, "u").join(home, ["q", "b"], "left").filter("q <> b AND NOT (m = 0 AND met IS NOT NULL AND there IS NOT NULL)").select("u", F.col("q").alias("v"))
    last = stage(_compare(documents, nodes, stage(left, "pairs"), shingle, percent, far, stage), "tried")
    reached = both.drop("probe").withColumn("probe", F.lit(False)).join(near.select(F.col("q").alias("v")), "v", "left_semi").select(*both.columns)
    more = more.union(last.filter("link").select("u", "v")).union(_compare_around(reached.union(last.withColumn("probe", F.lit(True))), percent, stage))
    labels = components(links.union(more), stage).withColumnRenamed("u", "fp")
    labels = labels.select("fp", "c").union(labels.select(F.col("c").alias("fp"), "c").distinct())  # a component's smallest node is in it, too
    linked = stage(nodes.select("fp", "doc").join(labels, "fp"), "linked")
    least = stage(linked.groupBy("c").agg(F.min("doc").alias("component_id")), "least")
    named = linked.join(if_small(least, 24), "c").select("fp", "component_id")
    member = stage(nodes.select("fp", "doc").join(named, "fp", "left").select("fp", F.coalesce("component_id", "doc").alias("component_id")), "member")
    # Both sides are shuffled for this join alone, so Spark may split the copies of one text.
    out = found.select("doc_id", "n", "fp").join(member.hint("shuffle_merge"), "fp", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """The documents that near_duplicates() keeps, with their own columns; rows of null doc_id stay.

    A doc_id goes if none of its rows is kept. What is looked up is the doc_ids that go, by a broadcast behind a check of
    its size, so texts aren't shuffled for it before that bound.
    """
    gone = near_duplicates(documents, **options).groupBy("doc_id").agg(F.max("kept").alias("k")).filter("NOT k AND doc_id IS NOT NULL")
    gone = stage(gone.select(F.col("doc_id").alias("__gone")), "gone")
    return documents.join(if_small(gone, 16), F.col("doc_id") == F.col("__gone"), "left_anti")

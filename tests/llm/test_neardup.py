import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tidelog.llm import neardup

TABLE = Path("/root/testdata/sf0.01/documents.parquet")

def brute(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, **options).collect()}


def copies(n, seed=3):
    """Copies of one text at very different distances, some of copies, and others."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    texts = [base]
    for i in range(n):
        t = list(r.choice(texts) if i % 3 else base)
        for _ in range(r.choice((0, 1, 2, 4, 6, 9, 14))):
            t[r.randrange(len(t))] = word()
        texts.append(t)
    texts += [[word() for _ in range(r.randrange(3, 60))] for _ in range(20)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot", [10**6, 20])
def test_equals_brute_force_on_copies_of_copies(spark, monkeypatch, hot):
    monkeypatch.setattr(neardup, "HOT", hot)
    monkeypatch.setattr(neardup, "AROUND", 16)
    monkeypatch.setattr(neardup, "SALT", 8)
    rows = copies(160)
    assert found(spark, rows, shingle=2) == brute(rows, 2)


def test_nulls_empty_short_and_repeated(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (8, "a b c"), (8, "a b c"), (9, "one two")]
    got = found(spark, rows, shingle=2)
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 6), 8: (2, 8), 9: (1, 6)}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, n bigint, fp string")
    assert neardup.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y"), (None, "a b c d e f", 7, "z")], "doc_id bigint, text string, n bigint, fp string")
    assert sorted((r.doc_id or 0, r.fp) for r in neardup.drop_near_duplicates(df).collect()) == [(0, "z"), (1, "x")]


def exact_components(rows, k):
    """Components by an exact join: sets of at least four fifths in common share one of their rarest fifth of shingles."""
    nodes = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if w:
            nodes.setdefault(frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) or frozenset([tuple(w)]), []).append(i)
    sets = sorted(nodes, key=len)
    often, index, parent = Counter(x for s in sets for x in s), defaultdict(list), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, s in enumerate(sets):
        rare = sorted(s, key=lambda x: (often[x], x))[: len(s) - (4 * len(s) + 4) // 5 + 1]
        for j in {j for x in rare for j in index[x]}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                parent[find(i)] = find(j)
        for x in rare:
            index[x].append(i)
    members = defaultdict(list)
    for i, s in enumerate(sets):
        members[find(i)] += nodes[s]
    return {d: min(m) for m in members.values() for d in m}


@pytest.mark.skipif(not TABLE.exists(), reason="no table")
@pytest.mark.parametrize("shingle", [2, 5])
def test_given_documents_equal_an_exact_join(spark, shingle):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(TABLE, columns=["doc_id", "text"]).to_pylist()]
    want = exact_components(rows, shingle)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.read.parquet(str(TABLE)), shingle=shingle).collect()}
    assert {i: got[i] for i in want} == want and all(got[i] == i for i in got.keys() - want.keys())

"""Queries that SQL doesn't express, held against plain Python on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tidelog.llm import bpe, decontaminate, html, language, linedup, lm, neardup, tokencount, tokenfile, topk
from tidelog.llm.queries import vocabulary

SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONG = [" ".join(f"w{i % 977}" for i in range(60_000)), "abc" * 20_000]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remainder(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


def best_pieces(word, score):
    """The best segmentation, found from the word's end on: pieces, or single characters that are none."""
    unknown = min(score.values()) - 10
    best = {0: (0.0, [])}
    for end in range(1, len(word) + 1):
        options = []
        for begin in range(max(0, end - 40), end):
            piece = word[begin:end]
            if piece in score or end - begin == 1:
                options.append((best[begin][0] + score.get(piece, unknown), end - begin, begin, piece))
        found = max(options)
        best[end] = found[0], [*best[found[2]][1], found[3]]
    return best[len(word)][1]


def test_token_counts_under_a_model_fitted_to_all_words(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    r = random.Random(5)
    texts = [" ".join("".join(r.choice("abehinorst日é🙂") for _ in range(r.randrange(1, 14))) for _ in range(80)) for _ in range(6)] + [None, "", "a" * 300, "abc" * 700, " \n", "the same words and the same text"]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "a the")]
    got = sorted((x.doc_id is None, x.doc_id or 0, x.n_words, x.n_tokens) for x in tokencount.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), vocabulary("piece_bpe_32k.model"), rounds=2).collect())
    each = Counter(x for _, t in rows for x in re.findall(SPACE_WORD, t or ""))
    harmonic = math.fsum(1 / (i + 1) for i in range(len(pieces)))
    score = {p: math.log(1 / (i + 1)) - math.log(harmonic) for i, p in enumerate(pieces)}
    for _ in range(2):
        used = Counter()
        for word, n in each.items():
            for p in best_pieces("▁" + word, score):
                used[p] += n * (p in score)
        total = sum(used.values()) + len(pieces)
        score = {p: math.log(used[p] + 1) - math.log(total) for p in pieces}
    tokens = {x: sum(1 if p in score else len(p.encode()) for p in best_pieces("▁" + x, score)) for x in each}
    assert got == sorted((i is None, i or 0, len(w), sum(tokens[x] for x in w)) for i, t in rows for w in [re.findall(SPACE_WORD, t or "")])


def test_token_files_in_order_of_id(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = ["b c", None, "", "Hello  world\n\n12 é🙂", "x" * 500, "one two " * 300]
    rows = [(7 * i % 11 - 2, x, "n") for i, x in enumerate(texts)]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.write_and_check(spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(3), vocabulary("byte_bpe_50k.json"), 2).collect()}
    want, start = {}, 0
    for i, x, _ in sorted(rows):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        want[i] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert got == want


def speech(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randrange(3, 8))) for _ in range(n))


ALPHABETS = {"aa": "abcdef", "bb": "efghij", "cc": "klmnoé"}


def test_language_of_held_out_documents(spark):
    r = random.Random(9)
    rows = [(i, speech(r, ALPHABETS[x], 40), x) for i in range(200) for x in [r.choice(sorted(ALPHABETS))]]
    truth = {i: x for i, _, x in rows}
    # A label of a held-out document is no input.
    rows = [(i, t, "zz" if remainder(i, 4) == 2 else x) for i, t, x in rows] + [(500, None, "aa"), (501, "12 + 3!", "bb"), (502, "", None), (503, speech(r, "abcdef", 30), None)]
    got = {x.doc_id: x for x in language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == len(rows) and all(x.held_out == (remainder(i, 4) == 2) and 0 <= x.score <= 1 for i, x in got.items())
    assert all(got[i].lang_pred == x for i, x in truth.items())
    assert [got[i].lang_pred for i in (500, 501, 502, 503)] == ["und", "und", "und", "aa"]


def contamination(docs, items, window, share):
    found = {i: re.findall(ALNUM_WORD, lower(t)) for i, t in items}
    out = {}
    for i, t in docs:
        w = re.findall(ALNUM_WORD, lower(t))
        hit, who = set(), set()
        for item, p in found.items():
            n = min(window, len(p))
            patterns = {tuple(p[a : a + n]) for a in range(len(p) - n + 1)} if n else set()
            for a in range(len(w) - n + 1) if n else ():
                if tuple(w[a : a + n]) in patterns:
                    hit |= set(range(a, a + n))
                    who.add(str(item))
        out[i] = len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit) and share * len(hit) >= len(w)
    return out


@pytest.mark.parametrize("block_bytes", [30, 1 << 20])
def test_contamination(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate.tables, "__defaults__", (*decontaminate.tables.__defaults__[:-1], block_bytes))
    r = random.Random(2)
    say = lambda n: [r.choice("ab") for _ in range(n)]
    items = [(i, " ".join(say(r.choice((1, 3, 5, 9, 14))))) for i in range(2, 12)] + [(20, None), (21, ""), (22, "Zürich, 9"), (23, "?!")]
    docs = [(i, r.choice((" ", ", ")).join(say(r.randrange(700)) + ["x"] * r.choice((0, 60)))) for i in range(25)] + [(30, None), (31, ""), (32, "zÜrich ZüRICH-9"), (33, "?")]
    items = [(i, t) for i, t in items if len((t or "").split()) != 1 or i == 23]
    got = {x.doc_id: tuple(x)[1:] for x in decontaminate.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), window=5, share=20).collect()}
    assert got == contamination(docs, items, 5, 20)


def by_hand(counts):
    """Discounts for counts of 1, 2 and more."""
    n1, n2, n3, n4 = (sum(c == i for c in counts) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    third = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return max(0.05, min(0.95, 1 - 2 * y * n2 / n1)), max(0.05, min(1.9, 2 - 3 * y * n3 / n2)), max(0.05, min(2.8, third))


def kneser_ney(rows):
    begin, end = object(), object()
    tokens = {i: [*re.findall(SPACE_WORD, lower(t)), end] for i, t in rows}
    held = {i: remainder(i, 7) == 2 for i in tokens}
    count, triples, pairs = Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if not held[i]:
            count.update(w)
            pairs[begin, w[0]] += 1
            triples.update(zip([begin, *w], w, w[1:], strict=False))
    pairs.update((b, c) for _, b, c in triples)
    single = Counter(b for _, b in pairs)

    def level(counts, d):
        """Discounted share of each, and of its context left over."""
        of = defaultdict(list)
        for key, c in counts.items():
            of[key[:-1]].append(c)
        less = lambda c: d[min(c, 3) - 1]
        return (lambda key: max(0, counts[key] - less(counts[key])) / sum(of[key[:-1]]) if counts[key] else 0.0), (lambda context: sum(map(less, of[context])) / sum(of[context]) if context in of else None)

    singles = Counter({(k,): c for k, c in single.items()})
    d1, d2, d3 = (by_hand(x.values()) for x in (singles, pairs, triples))
    d3 = d3[0], min(d3[1], d3[0] * d2[1] / d2[0]), min(d3[2], d3[0] * d2[2] / d2[0])
    levels = [level(singles, d1), level(pairs, d2), level(triples, d3)]

    def p(key):
        share, left = levels[len(key) - 1]
        lower_p = p(key[1:]) if len(key) > 1 else 1 / (len(single) + 1)
        rest = left(key[:-1])
        return lower_p if rest is None else share(key) + rest * lower_p

    n, out = sum(count.values()), {}
    for i, w in tokens.items():
        base = sum(math.log10((count[x] + 1) / (n + len(count) + 1)) for x in w)
        history = [begin, *w]
        out[i] = held[i], len(w), sum(count[x] > 0 for x in w), n, base, sum(math.log10(p(tuple(history[max(0, a - 1) : a + 2]))) for a in range(len(w)))
    return out


@pytest.mark.parametrize(("shards", "gathered", "spread"), [(64, 1 << 21, 2), (3, 200, 0.03)])
def test_kneser_ney(spark, monkeypatch, shards, gathered, spread):
    monkeypatch.setattr(lm, "SPREAD", spread)
    monkeypatch.setattr(lm, "SHARDS", shards)
    monkeypatch.setattr(lm, "GATHERED", gathered)
    r = random.Random(4)
    rows = [(i, " ".join(f"W{int(r.paretovariate(0.7)) % 90}" for _ in range(r.randrange(40)))) for i in range(60)] + [(60, None), (61, ""), (62, "never seen words"), (63, "w1 w2 " * 400), (64, "w1 w2 " * 400)]
    got = {x.doc_id: x for x in lm.score_held_out(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    want = kneser_ney(rows)
    assert got.keys() == want.keys()
    for i, x in want.items():
        assert tuple(got[i])[1:5] == x[:4]
        assert got[i].base_score == pytest.approx(x[4], rel=1e-9) and got[i].score == pytest.approx(x[5], rel=1e-9)


def test_very_long_texts(spark):
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, LONG[0][:400])], "item_id bigint, text string")
    word, byte, piece = map(vocabulary, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
    for f in (lambda d: bpe.encode(d, word), lambda d: tokencount.token_counts(d, piece), neardup.near_duplicates, linedup.deduplicate_lines, lambda d: tokenfile.write_and_check(d, byte), lambda d: decontaminate.contamination(d, bench), lm.score_held_out):
        assert sorted(r.doc_id for r in f(docs).collect()) == [0, 1]


def test_vectors_and_pages_empty_null_and_repeated(spark):
    v = "vec_id bigint, embedding array<float>, score string"
    assert topk.top_k(spark.createDataFrame([], v)).count() == 0
    rows = [(0, [1.0, 0.0], "a"), (50, [1.0, 0.0], "b"), (1, [1.0, 0.0], None), (1, [1.0, 0.0], "c"), (None, [9.0, 9.0], "d"), (2, [], "e")]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, v), every=50, k=2).collect()))
    assert got == [(0, 1, 1, 65536), (0, 2, 1, 65536), (50, 1, 0, 65536), (50, 2, 1, 65536)]
    p = "page_id bigint, url string, html string, text string, n_chars string"
    assert html.extract(spark.createDataFrame([], p)).count() == 0
    pages = [(1, None, None, "x", "y"), (None, "u", "", "x", "y"), (2, "u", "<nav><a href=x>Menu</a></nav>", "x", "y")]
    assert sorted(((r.page_id or 0, r.text, r.n_chars) for r in html.extract(spark.createDataFrame(pages, p)).collect())) == [(0, "", 0), (1, "", 0), (2, "", 0)]


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def write(tables, folder):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def exact_top(rows, every, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None]
    out = []
    for a, (q, v) in enumerate(whole):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i) for b, (i, w) in enumerate(whole) if b != a)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("query_bytes", [300_000, 1 << 20])
def test_top_k_of_repeated_ids_ties_and_long_vectors(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    r = random.Random(6)
    vector = lambda n: [r.choice((0.0, r.uniform(-1, 1), r.gauss(0, 40))) for _ in range(n)]
    rows = [(r.randrange(300), vector(r.choice((0, 3, 8, 40)))) for _ in range(400)]
    rows += [rows[3], rows[3], (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.0]), (50, []), (7, None), (None, [1.0]), (100, vector(3000)), (101, vector(3000))]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, row string").repartition(3)
    assert sorted(map(tuple, topk.top_k(df, every=50, k=5).collect())) == exact_top(rows, 50, 5)


def test_top_k_stops_with_a_proof():
    r = np.random.default_rng(3)
    values = r.integers(-30, 30, (2000, 64))
    values[:5] = 90
    values[5:] //= 2
    block = topk.Block.build(np.arange(2000), np.arange(2000), values)
    query, row, score = block.best(np.array([0]), values[:1], 4, np.full(1, -np.inf))
    assert set(row[np.argsort(-score)][:4]) == {1, 2, 3, 4} and len(row) <= 2000 / 64
    assert 0 < block.touched < len(block.row) / 10


def test_pipeline_on_planted_documents(spark, tmp_path):
    from tokenizers import Tokenizer

    r = random.Random(8)
    line = lambda: speech(r, ALPHABETS["aa"], 30)
    clean = [(i, "\n".join(line() for _ in range(4))) for i in range(20)] + [(20, speech(r, ALPHABETS["aa"], 200))]
    # One line with a changed word: no line run repeats, nearly all runs of five words do.
    near = " ".join("changed" if i == 70 else x for i, x in enumerate(clean[20][1].split()))
    shared = f"{line()}\n{line()}"
    item = speech(r, ALPHABETS["aa"], 40)
    planted = [
        (100, f"{line()}\n{shared}\n{line()}"), (101, f"{line()}\n{line()}\n{line()}\n{shared}"), (102, shared),
        (110, near), (111, clean[4][1]),
        (120, f"{line()}\n{item}"), (130, None), (131, ""), (132, "12 34 !"), (133, "§§ 99 \t"),
    ]
    rows = [(i, t, None if i % 7 == 1 else "aa", "s", len(t or "")) for i, t in clean + planted]
    folder = write({"documents": spark.createDataFrame(rows, DOCUMENTS), "benchmark": spark.createDataFrame([(1, item)], "item_id bigint, text string")}, tmp_path)
    got = {x.doc_id: list(x.ids) for x in corpus_pipeline.run(spark, folder).collect()}
    want = dict(clean) | {100: planted[0][1], 101: "\n".join(planted[1][1].split("\n")[:3])}
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    assert got == {i: t.encode(x, add_special_tokens=False).ids for i, x in want.items()}


def test_pipeline_stages_on_empty_tables(spark, tmp_path):
    folder = write({"documents": spark.createDataFrame([], DOCUMENTS), "benchmark": spark.createDataFrame([], "item_id bigint, text string")}, tmp_path)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    clash = f"{DOCUMENTS}, n_lines int, n_deleted string, lang_pred string, score int, kept string, hit int, n bigint, key string"
    rows = [(i, speech(random.Random(i), ALPHABETS["aa"], 30), "aa", None, None, 1, "a", "b", 2, "c", 3, 4, "d") for i in range(6)]
    folder = write({"benchmark": spark.createDataFrame([(None, None)], "item_id bigint, text string")}, tmp_path)
    docs = spark.createDataFrame(rows, clash)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in clash.split(", ")]
        assert sorted(map(tuple, docs.collect())) == sorted(rows)

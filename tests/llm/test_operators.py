"""Edge cases and brute force of the other operators on small tables."""

import random

import pytest

from tidelog.llm import bpe, decontaminate, html, language, linedup, lm, tokencount, tokenfile, topk
from tidelog.llm.queries import vocabulary

ODD = [None, "", " \n\t", "a", "A b c", "x" * 3000, "ΑΣ İ 日本 🙂 don't", "one two " * 500, "<|endoftext|> é"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, 1) for i, t in enumerate(ODD)] + [(None, "a b", "en", 2), (3, "a", "en", 3)], "doc_id bigint, text string, lang string, n bigint")


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    word, byte, piece = map(vocabulary, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
    bench = spark.createDataFrame([(1, "a b c"), (None, None), (2, "")], "item_id bigint, text string")
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        for f in (lambda d: bpe.encode(d, word, ids=True), lambda d: tokencount.token_counts(d, piece), lambda d: tokenfile.write_and_check(d, byte), language.identify, lambda d: decontaminate.contamination(d, bench), linedup.deduplicate_lines, lm.score_held_out):
            assert f(docs).count() == n


def test_bpe_and_token_files_equal_the_library(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    b = bpe.load(vocabulary("word_bpe_49k.json"))
    u = tokenfile.load(vocabulary("byte_bpe_50k.json"))
    v = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for x in [o for o in ODD if o]:
        ids = t.encode(x, add_special_tokens=False).ids
        assert b.encode(x) == ids and b.decode(ids) == t.decode(ids, skip_special_tokens=False)
        assert u(x).tolist() == v.encode(x, add_special_tokens=False).ids


def test_line_runs(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(1, f"{a}\n{b}\nx"), (2, f"y\n{a}\n{b}"), (3, f"{a}\nz\n{b}"), (4, f"{c}\n{c}\n{c}"), (5, None), (6, f"{a}\n{b}\nx")]
    got = {r.doc_id: (r.text, r.n_deleted) for r in linedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("y", 2), 3: (rows[2][1], 0), 4: (c, 2), 5: (None, 0), 6: ("", 3)}


def test_top_k_equals_brute_force(spark):
    r = random.Random(1)
    vectors = [(i, [r.uniform(-1, 1) for _ in range(8)]) for i in range(120)] + [(200, None), (250, [1.0, None]), (300, [float("nan")] * 8), (110, [0.5] * 8)]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), every=50, k=5).collect()))
    whole = [(i, [int(x * 256 // 1) for x in v]) for i, v in vectors if v and None not in v and v[0] == v[0]]
    want = []
    for q, v in whole:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_pages():
    tree = html.train()
    page = "<header><h2>Site</h2></header><nav><a href=x>Menu</a></nav><main><article><h1>T &amp; U</h1><p>One\n two<br>three <a href=y>four</a></p><div class='comments'><p>I like it, it is a very good text</p></div><form>Name <input></form><p>Five</article></main><aside>Also read this one</aside><footer>&copy; me</footer><script>var p='<p>no</p>'</script>"
    assert html.main_text(page, tree) == "T & U\nOne two three four\nFive"
    assert html.main_text(None, tree) == html.main_text("", tree) == html.main_text("<nav><a>x</a></nav>", tree) == ""

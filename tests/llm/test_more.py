"""Line dedup against brute force over all line runs, and page extraction over layouts with known main text."""

import random
from html import escape

import pytest

from tidelog.llm import html, linedup


def brute_runs(rows, min_words):
    """Lines within any run of at least `min_words` words of which an earlier copy exists, in order of doc_id and position."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        found = text.split("\n")
        gone = set()
        for i in range(len(found)):
            n = 0
            for j in range(i, len(found)):
                n += len(found[j].split())
                if n >= min_words:
                    run = tuple(found[i : j + 1])
                    if run in seen:
                        gone.update(range(i, j + 1))
                    seen.add(run)
        out[doc] = ("\n".join(x for i, x in enumerate(found) if i not in gone), len(gone))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    r = random.Random(seed)
    pool = [" ".join(f"w{r.randrange(500)}" for _ in range(r.choice((1, 3, 9, 20, 33, 70)))) for _ in range(12)] + ["", "x"]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 14)))) for i in range(70)]
    rows += [(100, rows[0][1]), (101, "\n".join([pool[0]] * 300)), (102, pool[1] + "\n" + rows[5][1])]
    got = {x.doc_id: (x.text, x.n_deleted) for x in linedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words=50).collect()}
    assert got == brute_runs(rows, 50)


def say(r, n):
    return " ".join(r.choice(("tide", "log", "é", "a&b", "<x>", "water", "is", "low")) for _ in range(n))


def page(r, layout):
    """A page and its main text."""
    body = [say(r, r.randrange(15, 120)) for _ in range(r.randrange(2, 9))]
    head = say(r, r.randrange(3, 9))
    inner = f"<h1>{escape(head)}</h1>" + "".join(f"<p>{escape(b)}" + r.choice(("</p>", "")) for b in body)
    menu = "<nav><ul>" + "".join(f'<li><a href="/{i}">{escape(say(r, 1))}</a>' for i in range(r.randrange(3, 9))) + "</ul></nav>"
    junk = f'<div class="{r.choice(("ad", "cookie-notice", "sidebar", "comments", "related-posts"))}"><p>{escape(say(r, r.randrange(3, 60)))}</p></div>'
    close = f"<footer><p>&copy; {escape(say(r, 8))}</p></footer>"
    around = {"article": ("<article>", "</article>"), "main": ('<main class="page">', "</main>"), "divs": ('<div id="content">', "</div>")}[layout]
    return f"<!DOCTYPE html><html><head><title>{escape(head)}</title><style>p{{}}</style></head><body><header><p>{escape(say(r, 4))}</p></header>{menu}{junk}{around[0]}{inner}{around[1]}{junk}<form>{escape(say(r, 3))}<input></form>{close}<script>x='</p>'</script></body></html>", "\n".join([head, *body])


@pytest.mark.parametrize("layout", ["article", "main", "divs"])
def test_pages_of_three_layouts(layout):
    r, tree = random.Random(3), html.train()
    for _ in range(300):
        source, want = page(r, layout)
        assert html.main_text(source, tree) == want

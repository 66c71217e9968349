"""Main text of web pages: flat blocks, classified by a decision tree over words, link density and neighbours.

A page is cut at block-level tags into blocks of text. A block is described by its words and link density and those of
the blocks before and after it, by whether it is a heading, whether it stands in an article or main element or in a menu,
header, footer, sidebar or form, and by whether a container around it has a class, id or role that names an advert, notice
or comment. A decision tree, trained here on the small labelled table LABELLED, says which blocks are main text.

Tags are read as the HTML standard reads them, each character a bounded number of times. Names count on containers alone:
elements of running text (headings, list items, cells, quotes, all inline elements) never cut or drop text by their names.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import map_chunks, record

# Elements by kind, and words in class, id and role that name other than main text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: it ends at their own end tag alone.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSHOWN = RAW | frozenset("noscript template svg math select button object canvas audio video datalist".split())
MAIN = frozenset(("article", "main"))
ASIDE = frozenset("nav footer aside header form menu dialog fieldset search".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Containers, whose names count.
NAMED = frozenset("article aside center details dialog div dl figure footer header ol section table td ul".split())
#: Open elements that a start tag ends, as authors leave out their end tags; every block also ends a paragraph.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",), "optgroup": ("option", "optgroup")}
ENDS |= dict.fromkeys(("thead", "tbody", "tfoot"), ("td", "th", "tr", "thead", "tbody", "tfoot"))
#: An inline end tag is looked for among so many open elements.
INLINE_DEPTH = 64
#: In a class, as a word of it.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs toolbar comment comments commentlist disqus replies respond sharing share social related recommended recommendations newsletter subscribe subscription signup popup modal overlay footer header masthead login paywall pagination pager copyright".split())
#: In a class, words that parts of an article may have as well.
WEAK = frozenset("alert warning disclaimer side discussion reply search widget tags legal skip".split())
#: Words of an id: ids are anchors as well, so plain words aren't among them.
IDS = frozenset("ad ads advert adverts advertisement cookie cookies gdpr sidebar navbar breadcrumb breadcrumbs toolbar comments commentlist disqus respond newsletter popup modal masthead paywall pagination".split())
#: Whole ids.
WHOLE_IDS = frozenset("header footer menu nav navigation banner login search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
#: A paragraph's whole class that says it is none of the article's.
PARAGRAPHS = frozenset("ad ads advert advertisement sponsored promo cookie cookie-notice notice copyright comment paywall breadcrumb breadcrumbs newsletter share".split())
#: Labels of containers.
LABELS = frozenset(("advertisement", "advertisements", "sponsored", "breadcrumb", "breadcrumbs", "comments", "cookie notice", "cookie consent", "newsletter"))
#: First words of classes that say something about a part and don't name it.
ABOUT = frozenset("no not has have with without hide show tag category cat topic term".split())
#: First words of classes whose header is an article's own.
OWN = frozenset("page post entry article section content card".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
WORD_ENDS = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z0-9]+")
SPACE = re.compile(r"\s+")
ZEROS = re.compile(r"&#([xX]?)0++(?=[0-9a-fA-F])")
TOO_GREAT = re.compile(r"&#(?:[0-9]{8,}+|[xX][0-9a-fA-F]{7,}+);?")

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "page_has_main", "in_main", "in_aside", "named", "heading")
#: Blocks labelled by hand: FEATURES (named: 1, or 0.5 by a weak name), then 1 for main text.
LABELLED = (
    # an article in an article element: paragraphs of any length, headings, lists, quotes
    (62, 0.0, 8, 0.0, 40, 0.0, 1, 1, 0, 0, 0, 1), (2, 0.0, 62, 0.0, 45, 0.0, 1, 1, 0, 0, 0, 1), (9, 0.0, 7, 0.0, 62, 0.0, 1, 1, 0, 0, 0, 1),
    (1, 0.0, 12, 0.0, 9, 0.0, 1, 1, 0, 0, 0, 1), (120, 0.05, 2, 0.0, 8, 0.1, 1, 1, 0, 0, 0, 1), (15, 0.2, 80, 0.0, 0, 0.0, 1, 1, 0, 0, 0, 1),
    (4, 0.0, 6, 1.0, 9, 0.0, 1, 1, 0, 0, 0, 1), (33, 0.0, 9, 0.0, 11, 0.0, 1, 1, 0, 0, 0, 1), (6, 0.4, 70, 0.0, 55, 0.0, 1, 1, 0, 0, 0, 1),
    (3, 0.0, 0, 0.0, 14, 0.0, 1, 1, 0, 0, 0, 1), (260, 0.0, 1, 0.0, 1, 0.0, 1, 1, 0, 0, 0, 1), (18, 0.9, 40, 0.0, 52, 0.0, 1, 1, 0, 0, 0, 1),
    (40, 0.0, 30, 0.0, 2, 1.0, 1, 1, 0, 0, 0, 1), (5, 0.0, 60, 0.0, 1, 1.0, 1, 1, 0, 0, 0, 1), (11, 0.0, 1, 1.0, 1, 1.0, 1, 1, 0, 0, 0, 1),
    (2, 0.0, 1, 1.0, 2, 1.0, 1, 1, 0, 0, 0, 1), (75, 0.1, 2, 1.0, 90, 0.0, 1, 1, 0, 0, 0, 1), (20, 0.0, 0, 0.0, 0, 0.0, 1, 1, 0, 0, 0, 1),
    # beside it
    (30, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0, 0, 0, 0), (90, 0.0, 12, 0.0, 60, 0.0, 1, 0, 0, 0, 0, 0), (6, 0.0, 55, 0.0, 70, 0.0, 1, 0, 0, 0, 0, 0),
    (3, 0.0, 20, 0.0, 66, 0.0, 1, 0, 0, 0, 0, 0), (150, 0.0, 25, 0.0, 14, 0.0, 1, 0, 0, 0, 0, 0), (12, 0.0, 90, 0.0, 3, 1.0, 1, 0, 0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 1, 0, 0, 0), (9, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0, 1, 0, 0),
    (14, 0.1, 60, 0.0, 0, 0.0, 1, 0, 1, 0, 0, 0), (25, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0, 0, 0), (40, 0.0, 9, 0.0, 30, 0.0, 1, 0, 0, 1, 0, 0),
    (55, 0.0, 3, 0.0, 50, 0.0, 1, 0, 0, 0, 0, 0), (8, 0.0, 50, 0.0, 3, 1.0, 1, 0, 1, 0, 0, 0), (70, 0.0, 9, 0.0, 20, 0.0, 1, 0, 1, 1, 0, 0),
    # within it: comments, adverts, menus, forms
    (45, 0.0, 30, 0.0, 38, 0.0, 1, 1, 0, 1, 0, 0), (8, 0.0, 70, 0.0, 65, 0.0, 1, 1, 0, 1, 0, 0), (3, 1.0, 60, 0.0, 2, 1.0, 1, 1, 1, 0, 0, 0),
    (12, 0.0, 44, 0.0, 0, 0.0, 1, 1, 1, 0, 0, 0), (30, 0.1, 50, 0.0, 42, 0.0, 1, 1, 1, 1, 0, 0), (5, 1.0, 20, 0.0, 6, 1.0, 1, 1, 0, 1, 0, 0),
    (90, 0.0, 12, 0.0, 70, 0.0, 1, 1, 0, 1, 0, 0), (60, 0.0, 55, 0.0, 4, 0.0, 1, 1, 1, 0, 0, 0),
    # pages without such an element: long blocks of few links, and short ones among them
    (60, 0.0, 9, 0.0, 40, 0.0, 0, 0, 0, 0, 0, 1), (35, 0.1, 60, 0.0, 22, 0.0, 0, 0, 0, 0, 0, 1), (7, 0.0, 45, 0.0, 60, 0.0, 0, 0, 0, 0, 0, 1),
    (2, 0.0, 38, 0.0, 71, 0.0, 0, 0, 0, 0, 0, 1), (18, 0.0, 30, 0.0, 25, 0.1, 0, 0, 0, 0, 0, 1), (9, 0.0, 1, 1.0, 64, 0.0, 0, 0, 0, 0, 0, 1),
    (24, 0.2, 12, 0.0, 33, 0.0, 0, 0, 0, 0, 0, 1), (150, 0.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0, 0, 1), (12, 0.0, 80, 0.0, 15, 0.0, 0, 0, 0, 0, 0, 1),
    (50, 0.0, 20, 0.0, 3, 1.0, 0, 0, 0, 0, 0, 1), (28, 0.0, 70, 0.0, 1, 1.0, 0, 0, 0, 0, 0, 1), (22, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0, 0, 1),
    # a short heading after a short line, before a paragraph
    (4, 0.0, 9, 0.0, 50, 0.0, 0, 0, 0, 0, 0, 1), (2, 0.0, 3, 0.0, 30, 0.0, 0, 0, 0, 0, 0, 1), (5, 0.0, 14, 0.0, 100, 0.0, 0, 0, 0, 0, 0, 1), (1, 0.0, 5, 0.6, 40, 0.0, 0, 0, 0, 0, 0, 1),
    # points of a list among paragraphs
    (4, 0.0, 18, 0.0, 4, 0.0, 0, 0, 0, 0, 0, 1), (4, 0.0, 4, 0.0, 17, 0.0, 0, 0, 0, 0, 0, 1), (3, 0.0, 4, 0.0, 5, 0.0, 0, 0, 0, 0, 0, 1), (2, 0.0, 30, 0.0, 2, 0.0, 0, 0, 0, 0, 0, 1), (6, 0.0, 60, 0.0, 7, 0.0, 0, 0, 0, 0, 0, 1),
    # menus, notes and adverts there
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0, 0, 0), (3, 1.0, 60, 0.0, 2, 1.0, 0, 0, 0, 0, 0, 0), (6, 0.8, 2, 1.0, 40, 0.0, 0, 0, 0, 0, 0, 0),
    (2, 0.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0, 0, 0), (25, 0.9, 4, 1.0, 9, 0.9, 0, 0, 0, 0, 0, 0), (4, 0.0, 2, 0.0, 1, 1.0, 0, 0, 0, 0, 0, 0),
    (55, 0.0, 30, 0.0, 20, 0.0, 0, 0, 1, 0, 0, 0), (40, 0.0, 45, 0.0, 30, 0.0, 0, 0, 0, 1, 0, 0), (10, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0, 0, 0),
    (12, 0.0, 50, 0.0, 44, 0.0, 0, 0, 0, 1, 0, 0), (80, 0.0, 70, 0.0, 66, 0.0, 0, 0, 1, 1, 0, 0), (8, 0.0, 1, 1.0, 50, 0.0, 0, 0, 1, 0, 0, 0),
    # names that an article's parts may have, in one and beside it
    (30, 0.0, 60, 0.0, 45, 0.0, 1, 1, 0, 0.5, 0, 1), (8, 0.0, 50, 0.0, 70, 0.0, 1, 1, 0, 0.5, 0, 1), (65, 0.1, 9, 0.0, 20, 0.0, 1, 1, 0, 0.5, 0, 1), (4, 0.0, 3, 0.0, 40, 0.0, 1, 1, 0, 0.5, 1, 1),
    (30, 0.0, 60, 0.0, 45, 0.0, 1, 0, 0, 0.5, 0, 0), (60, 0.0, 40, 0.0, 8, 0.0, 0, 0, 0, 0.5, 0, 0), (12, 0.0, 50, 0.0, 3, 1.0, 0, 0, 0, 0.5, 0, 0), (22, 0.0, 1, 1.0, 60, 0.0, 0, 0, 0, 0.5, 0, 0),
    # headings: an article's, without and with such an element; those of other parts
    (6, 0.0, 1, 1.0, 80, 0.0, 1, 1, 0, 0, 1, 1), (2, 0.0, 40, 0.0, 1, 1.0, 1, 1, 0, 0, 1, 1), (5, 0.0, 20, 0.0, 30, 0.0, 1, 0, 0, 0, 1, 0), (3, 0.0, 30, 0.0, 40, 0.0, 1, 1, 0, 1, 1, 0),
    (6, 0.0, 1, 1.0, 80, 0.0, 0, 0, 0, 0, 1, 1), (3, 0.0, 4, 0.0, 25, 0.0, 0, 0, 0, 0, 1, 1), (8, 0.0, 2, 1.0, 16, 0.0, 0, 0, 0, 0, 1, 1), (4, 0.0, 60, 0.0, 18, 0.1, 0, 0, 0, 0, 1, 1),
    (7, 0.0, 20, 0.0, 5, 0.0, 0, 0, 0, 0, 1, 1), (3, 0.0, 4, 0.0, 6, 0.0, 0, 0, 0, 0, 1, 1),
    (2, 0.0, 30, 0.0, 1, 1.0, 0, 0, 0, 0, 1, 0), (1, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0, 1, 0), (4, 1.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0, 1, 0), (5, 0.0, 4, 0.0, 40, 0.0, 0, 0, 0, 1, 1, 0), (4, 0.0, 9, 0.0, 30, 0.0, 0, 0, 1, 0, 1, 0),
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8):
    """A decision tree by Gini impurity: a label, or (feature, threshold, tree at or below it, tree above it). Of equally good cuts the first feature's lowest wins."""
    if depth == 0 or len(set(labels.tolist())) < 2:
        return int(2 * labels.sum() > len(labels))
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            below = rows[:, f] <= cut
            cost = sum(len(y) * 2 * y.mean() * (1 - y.mean()) for y in (labels[below], labels[~below]))
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, float(cut), below
    if best is None:
        return int(2 * labels.sum() > len(labels))
    _, f, cut, below = best
    return f, cut, grow(rows[below], labels[below], depth - 1), grow(rows[~below], labels[~below], depth - 1)


def train(table=LABELLED):
    t = np.array(table, float)
    return grow(t[:, :-1], t[:, -1])


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _name(tag: str, attributes: str) -> float:
    """1 if a container's class, id or role says that it isn't main text, 0.5 if a weak word does, else 0."""
    found = 0.0
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "class":
            for name in value.split():
                if tag in ("p", "article"):
                    if name.lower() in PARAGRAPHS:
                        return 1.0
                    continue
                words = [x.lower() for x in WORD_ENDS.split(name) if x]
                if not words or words[0] in ABOUT:
                    continue
                if not NAMES.isdisjoint(x for x in words if x != "header" or words[0] not in OWN and tag != "td"):
                    return 1.0
                found = max(found, 0.5 * (not WEAK.isdisjoint(words)))
        elif key == "id" and tag != "p":
            words = [x.lower() for x in WORD_ENDS.split(value) if x]
            if not IDS.isdisjoint(words) or value.strip().lower() in WHOLE_IDS and tag not in ("section", "article"):
                return 1.0
        elif key == "aria-label" and value.strip().lower() in LABELS:
            return 1.0
        elif key == "role" and value.strip().lower() in ROLES:
            return 1.0
    return found


def _hidden(attributes: str) -> bool:
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "hidden" or key == "style" and re.search(r"display:none|visibility:hidden", SPACE.sub("", a or b or c).lower()):
            return True
    return False


def decoded(text: str) -> str:
    """Character references replaced, of numbers of any length."""
    if "&" not in text:
        return text
    return unescape(TOO_GREAT.sub("�", ZEROS.sub(r"&#\1", text)) if "&#" in text else text)


def blocks(html: str) -> list[tuple]:
    """Text, words, linked words, in_main, in_aside, named and heading of each block that has text."""
    out: list = []
    parts: list[tuple[str, int]] = []
    # Open elements with what held outside them, and how many of each name; inline ones are there only if they hide text.
    stack: list[tuple[str, tuple]] = []
    opened: dict[str, int] = {}
    state = (False, False, 0.0, False, False)  # in_main, in_aside, named, heading, hidden
    links, at, size = 0, 0, len(html)

    def flush() -> None:
        if parts:
            pieces = [(decoded(p), a) for p, a in parts]
            text = SPACE.sub(" ", "".join([p for p, _ in pieces])).strip()
            if text:
                n = len(text.split(" "))
                out.append((text, n, min(n, sum(len(p.split()) for p, a in pieces if a)), *state[:4]))
            parts.clear()

    def push(tag: str, new: tuple) -> None:
        nonlocal state
        stack.append((tag, state))
        opened[tag] = opened.get(tag, 0) + 1
        state = new

    def pop() -> str:
        nonlocal state
        tag, state = stack.pop()
        opened[tag] -= 1
        return tag

    while at < size:
        to = html.find("<", at)
        to = size if to < 0 else to
        if to > at and not state[4]:
            parts.append((html[at:to], links))
        if to == size:
            break
        follows = html[to + 1 : to + 2]
        if follows in ("!", "?") or follows == "/" and not (html[to + 2 : to + 3].isascii() and html[to + 2 : to + 3].isalpha()):
            if html.startswith(("<!-->", "<!--->"), to):
                end = html.find(">", to)
            else:
                end = html.find("-->", to + 4) + 2 if html.startswith("<!--", to) else html.find(">", to)
            at = end + 1 if end > to else size
            continue
        if not (follows.isascii() and follows.isalpha() or follows == "/"):
            if not state[4]:
                parts.append(("<", links))
            at = to + 1
            continue
        m = TAG.match(html, to)
        if m is None:
            break  # an unclosed tag takes the rest
        at, closing, tag, attributes = m.end(), m.group(1), m.group(2).lower(), m.group(3)
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append((" ", links))
        elif tag in RAW and not closing:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            parts.append((" ", links))
        elif tag in BLOCKS:
            flush()
            links = 0
            if closing:
                while opened.get(tag) and pop() != tag:
                    pass
            elif tag not in VOID:
                while stack and (stack[-1][0] == "p" or stack[-1][0] in ENDS.get(tag, ())):
                    pop()
                main, aside, named, heading, hidden = state
                name = _name(tag, attributes) if attributes and (tag in NAMED or tag == "p") else 0.0
                if tag == "main":
                    aside, named = False, 0.0
                own = tag == "header" and main and name < 1  # an article's own header
                push(tag, (main or tag in MAIN, aside or tag in ASIDE and not own, max(named, name), heading or tag in HEADINGS, hidden or bool(attributes) and _hidden(attributes)))
        elif closing:
            if opened.get(tag):
                for i in range(len(stack) - 1, max(-1, len(stack) - 1 - INLINE_DEPTH), -1):
                    if stack[i][0] == tag:
                        while pop() != tag:
                            pass
                        break
                    if stack[i][0] in BLOCKS:
                        break
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in UNSHOWN:
                parts.append((" ", links))
            if tag in UNSHOWN or attributes and ("hidden" in attributes.lower() or "none" in attributes.lower()) and _hidden(attributes):
                push(tag, (*state[:4], True))
    flush()
    return out


def main_text(html: str | None, tree) -> str:
    found = blocks(html or "")
    has_main = any(b[3] for b in found)
    sizes = [(0, 0.0), *((b[1], b[2] / b[1]) for b in found), (0, 0.0)]
    kept = [b[0] for i, b in enumerate(found) if decide(tree, (*sizes[i + 1], *sizes[i], *sizes[i + 2], has_main, *b[3:]))]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, text and n_chars (code points).

    Blocks are joined in page order by line breaks; character references are decoded and white space inside a block is
    one space. Null and empty html, and pages without main text, give the empty text. Unclosed elements end with their
    parents; an unclosed tag, comment or script takes the page's rest, as in browsers. Pages of any length are read whole,
    in time by their length. Rows are independent: repeated rows, null page_ids and other columns don't matter.
    """
    tree = train()

    def per_chunk(batch, column):
        texts = [main_text(t, tree) for t in column.to_pylist()]
        return record(page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    source = pages.select("page_id", "url", F.col("html"))
    return map_chunks(source, per_chunk, f"page_id {source.schema['page_id'].dataType.simpleString()}, url {source.schema['url'].dataType.simpleString()}, text string, n_chars bigint", "html")

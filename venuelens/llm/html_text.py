"""Main text of HTML pages from flat text blocks, classified by a decision tree.

A page is read once, left to right, into text blocks (the text between block-level tags). Each
block has its word count and link density, those of the blocks before and after it, the longest plain
block among the three before and the three after, and marks: page furniture by element, class, id or
role; article body; heading; an end like a sentence's. A decision tree, grown here from the small
labelled tables below, says which blocks are main text. Most labelled blocks stand in no marked
element, so that there the neighbours decide: a short line between paragraphs stays, the same line
among links or at the edge of the page goes.

A mark that covers nearly all plain words of a page (a form or a widget around everything) says
nothing and is not counted, unless the page has an article body elsewhere.

Defined cases: a null or empty page, or one without main text, gives the empty string; character
references are decoded, white space inside a block becomes one space, blocks are joined by one
newline and nothing is cut; unclosed, stray and truncated tags and comments are tolerated; repeated
rows each give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names and the words in class, id and role that mark page furniture.
RAW = "script|style|noscript|template|iframe|textarea|svg|math|object|canvas|title|select"
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
WHOLE_PAGE = 0.9  # a marked element with this share of a page's plain words marks nothing
TRACKED = BLOCK - frozenset("p hr".split())  # a paragraph ends where the next block begins, closed or not
FURNITURE = frozenset("nav footer aside form button head menu dialog fieldset label legend".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menu|header|masthead|footer|side-?bar|aside|ads?|advert\w*|sponsor\w*|promo\w*|banner"
    r"|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|comments?|replies|disqus|respond|share|sharing|social|related"
    r"|recommend\w*|subscribe|subscription|newsletter|sign-?up|login|search|breadcrumbs?|pagination|pager|toolbar|widget|copyright"
    r"|complementary|contentinfo|form|dialog)(?=$|[\s_\d-])",
    re.I,
)
OF_ARTICLE = re.compile(r"(?:post|entry|article|story|content|section)[_-](?:header|title)", re.I)  # heads of articles, not of pages
HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[/!?a-z][^>]*(?:>|\Z)",
    re.I | re.S,
)
BODY = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    body: bool
    heading: bool


def text_blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements and, for furniture, the number of the mark
    marks_of: list[list[int]] = []  # the marks each block stands in
    n_marks = 0
    pieces: list[str] = []
    linked = 0
    in_link = False
    heading = False

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text.split())

    def end_block() -> None:
        nonlocal linked, in_link
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            words = len(text.split(" "))
            out.append(Block(
                text, words, min(linked, words), False, any(n in BODY for n, _ in stack), heading,
            ))
            marks_of.append([f for _, f in stack if f])
        pieces.clear()
        linked, in_link = 0, False

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[2]), m[4] or ""
        if name == "a":
            in_link = not closing
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCK:
            end_block()
            heading = name in HEADINGS and not closing
            if name not in TRACKED:
                continue
            if not closing:
                if attributes.rstrip().endswith("/"):
                    continue
                marked = name in FURNITURE or (name == "header" and not any(n in BODY for n, _ in stack))
                if attributes and not marked and name not in ("body", "html"):
                    names = OF_ARTICLE.sub("", " ".join(filter(None, (x for t in NAMES.findall(attributes) for x in t))))
                    marked = bool(MARKS.search(names)) and name not in BODY or bool(HIDDEN.search(attributes))
                n_marks += marked
                stack.append((name, n_marks if marked else 0))
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
    tail = page[at:]
    add(tail)
    end_block()
    plain = [b.words - b.linked for b in out]
    covered, bodies = [0] * (n_marks + 1), [0] * (n_marks + 1)
    for b, marks, n in zip(out, marks_of, plain, strict=True):
        for f in marks:
            covered[f] += n
            bodies[f] += b.body
    n_bodies = sum(b.body for b in out)
    says_nothing = {f for f in range(1, n_marks + 1) if covered[f] >= WHOLE_PAGE * max(sum(plain), 1) and bodies[f] == n_bodies}
    for b, marks in zip(out, marks_of, strict=True):
        b.furniture = any(f not in says_nothing for f in marks)
    return out


# Labelled pages: the tree's training table. Marks in order of the blocks: "+" main text, "-" not.
LABELLED = [
    ('<body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav><article><h1>The old bridge</h1>'
     "<p>The bridge was built of stone and stood for two hundred years before the flood.<p>It fell in one night.<p>Nobody was hurt."
     "</article><footer>Copyright 2020 by the owners. All rights are theirs.</footer>", "--++++-"),
    ('<div class="menu"><a href="/a">Shop</a> <a href="/b">Cart</a></div><div><h2>A new road</h2><p>The council has voted for a road that will '
     "join both towns, and work will begin in the spring of next year.</p><p>The cost is not known yet, but it will be shared between "
     "the two towns and the state.</p></div><div class=\"footer\">Terms and privacy of this service</div>", "-+++-"),
    ('<header><p>The daily paper for the whole valley, since the year of the great fire.</p></header><main><p>Rain.</p><p>The river rose '
     'slowly through the night and covered the lower fields by morning.</p><p>See <a href="/x">the map of the river</a> for details.</p></main>'
     '<aside><p>Other readers also liked the story of the miller and his three sons.</p></aside>', "-+++-"),
    ('<article><header><h1>Bread</h1></header><p>Flour, water and salt.</p><p><a href="/y">Read the recipe.</a></p><p>Bake it.</p>'
     '<div class="comments"><p>Anna: I tried this and it was very good, thank you for writing it down.</p><p>Ben: Mine burnt.</p></div></article>',
     "++++--"),
    ('<div class="cookie-notice">We use cookies to make this page better. By reading on you agree to their use.</div><article><p>One.</p>'
     "<p>The two sisters lived at the edge of the wood, where the road turns to the north.</p><p>Two.</p></article>", "-+++"),
    ('<div><a href="/1">First story</a></div><div><a href="/2">Second story</a></div><div><a href="/3">Third story</a></div><div>The museum opens '
     "again on Sunday after a year of repairs to the roof and the great hall.</div><div>Visitors may enter free of charge during the first "
     "week, and guides will be there each day.</div><div><a href=\"/4\">More stories</a></div>", "---++-"),
    ('<p>Login</p><p>Help</p><p>Share</p><p>The engine turns a shaft that drives both pumps, so that neither can run while the other '
     "stands still.</p><p>This was thought to be safer than two engines, and it was certainly cheaper.</p><p>Print</p><p>Top</p>", "---++--"),
    ('<article><h1>Sea</h1><p>Ships came.</p><div class="ad">Buy the best boats in town at the lowest price you will ever see.</div>'
     '<p>They brought cloth, wine and news from the south, and left with wool.</p><form><label>Mail</label> Subscribe to our letter and never '
     "miss a story again.</form><ul><li>cloth</li><li>wine</li></ul></article>", "++-+--++"),
    ('<div id="sidebar"><p>Popular stories of the week, chosen by our readers with great care.</p></div><div class="post"><p>The vote was held '
     'in the old school and lasted until the evening of the second day.</p><p>It was close, and the votes had to be counted twice.</p></div>'
     '<div class="related"><p>Read also how the school was built and who paid for it.</p></div>', "-++-"),
    ('<main><h2>Results</h2><table><tr><td>North</td><td>12</td></tr><tr><td>South</td><td>9</td></tr></table><p>The north won.</p></main>'
     '<footer><a href="/c">Contact</a> <a href="/p">Press</a></footer>', "++++++-"),
    ('<ul><li><a href="/a">Start</a></li><li><a href="/b">Blog</a></li><li><a href="/c">About</a></li></ul><h1>On slow cooking of beans</h1>'
     "<p>Beans need time, and salt should be added only when they are soft, or they will stay hard.</p><ul><li><a href=\"/d\">Next page</a></li></ul>",
     "---++-"),
    ('<div role="navigation">Sections of the paper in order of their names</div><article><p>It was late.</p></article><div class="newsletter">Get '
     "our letter each week by mail, free and without any duty to buy.</div>", "-+-"),
    ('<article><p>Sources:</p><p><a href="/1">The first report</a></p><p><a href="/2">The second report of the committee on the state of all '
     'bridges in the valley</a></p><ul><li><a href="/3">Map</a></li><li><a href="/4">Letters</a></li></ul></article><div><a href="/5">Top of '
     "the page</a></div>", "+++++-"),
    ('<main><p><a href="/x">A story told by a link alone.</a></p><p><a href="/y">Another one</a></p><p>End</p></main><div><a href="/5">A link to '
     "the list of all the stories that were ever told here</a></div><div><a href=\"/6\">Back</a></div>", "+++--"),
]


# Further labelled blocks, a page a line: verdict, kind (p plain, h heading, l all one link), number of
# words, "/" linked words of a plain block, "f" in page furniture, "b" in an article body, "." an end
# like a sentence's. Most stand in no marked element.
LAYOUTS = """
-l1 -l1 -l2 -l1 +h5 +p48. +p3. +p52. +p2. +p39. -l2 -l2 -l1
-l1 -l2 -l1 +h7 +p2. +p61. +p44. +p5. -p1 -l3 -l4 -l3 -l5
-p1 -p1 -p2 +h4 +p35. +p2 +p2 +p3 +p41. -p1 -p1 -p1
-p2 -p1 -p1 +p57. +p33. +p2 +p47. +p28. -p2 -p1
+h6 +p40. +p4. +p38/3. +p2. +p55. -l6 -l5 -l7 -l4
-l3 -l2 -l4 +h3 +p30. +h2 +p45. +h3 +p26. -l2 -l1
-l5 -l6 -l4 -l7 +p70. +p3. +p64. -p4/4 -l2 -l8 -l6
+p33. +p2. +p29. +p2. +p31.
+p3. +p45. +p2 +p50.
+h2 +p2. +p36. +p1. +p42.
-l1 -l1 -l1 -l1 -l1 +h8 +p90. +p75/6. +p5 +p6 +p4 +p5 +p66. -l2 -l3 -l2
-p1 -l2 -p1 -l1 +h5 +p22. +p18. +p25. -p2 -p2 -l1 -p3
-l2 -l2 +h4 +p19. +p4 +p4 +p17. +p21. -l3 -l2 -p2
-p3 -p2 -p2 +p48. +p52. +p3 +p44. -p3 -p2 -p4
-l4 -p2 -l3 +h9 +p28/4. +p35/2. +p6. +p31. -l9 -l8 -l10 -l7
+h4 +p15. +p18. +p2. +p16. -l2 -l2 -l2
-l10 -l12 -l9 -l11 +p80. +p62. -l11 -l10 -l12
-p1 -p1 +h6 +p53. +p2 +p2 +p2 +p2 +p47. +p40. -p2
-l2 -l1 -l3 +p41. +h3 +p2. +p38. +h2 +p1. +p44. -l1 -l2
-p2 -l1 -l1 -p2 -l1 +h5 +p60. +p7/2. +p58. -p5/5 -l3 -p2 -l2
+p24. +p3 +p22. +p3. +p27. -p1 -p1 -p2
-l1 -l2 -l1 -l2 +h7 +p34. +p5/1. +p3. +p29. +p33. -l1 -l1 -l2 -l1
-p4 -p1 -p3 +h4 +p46. +p2. +p3. +p50. -p2 -l4 -p1
-l6 -l5 +h3 +p12. +p14. +p3. +p13. -l5 -l6 -l5
-p1 -p2 -p1 -p1 +p66. +p2 +p71. -p1 -p2 -p1
+h4 +p25. +p2 +p2 +p23. +p3 +p2 +p1 +p28. -l2 -l1
-l2 -p1 +h6 +p37. +p2 +p1 +p2 +p34. +p1 +p3 +p31. -p1 -l2
-l1 -l1 +h5 +p27. +p1 +p2 +p22. -p2 -p1 -l1
-p1f -l2f -h3f -p20f. -p2f +h5b +p40b. +p2b +l4b +p3b. -h2f -p30f. -p45f. -p8f.
-h4f -l3f -l5f +p15b. +h3b +p1b +p6b/6 +p28b. -p22bf. -l4bf +p19b. -p60f. -p3f
-h2f -p12f. -p33f. +h6 +p44. +p3. +p39. -h3f -p27f. -p18f. -p9f.
-l1f -l1f -l2f +h4b +p2b +p2b. +l2b +p1b -h2f -l9f -p25f. -p70f.
-p40f. -h6f -p16f. +p50b. +p48b. +h2b +p4b. -p35bf. -h3bf -p3bf +p29b. -p11f. -l2f
-p9f. -p2f +p31. +p2. +p35. -p14f. -p38f. -h2f -l3f
+p11
+p14
+p9 +p12
+h3 +p13 +p10 -l2
-p1
-p2 -p3
-l2 -p2 -p1 +p16 +p21 -p2
-l1 -l3 +p34 +p18 +p40 -p1 -l2
-l2 -p1 +h1 +p24. +p30.
-p2 -p1 +h2 +p19. +p26.
+h1 +p28. +p33. -p1
-p1 -l1 +h1 +p21. +h2 +p25. -p2
-p1 -p2 +h1 +p55. +h1 +p47.
-l2f +p30b. -h2bf -l5bf -l6bf -l4bf +p25b. -l3bf +l2b +p2b -l7bf -l2bf +l5b +p18b.
"""
WORD = re.compile(r"([+-])([phl])(\d+)(b?)(f?)(?:/(\d+))?(\.?)")


def layout(line: str) -> tuple[list[Block], str]:
    """The blocks of a line of LAYOUTS and their verdicts."""
    out, marks = [], ""
    for verdict, kind, words, body, furniture, linked, stop in WORD.findall(line):
        n = int(words)
        out.append(Block("word" + stop, n, n if kind == "l" else int(linked or 0), bool(furniture), bool(body), kind == "h"))
        marks += verdict
    return out, marks


REACH = 3
FEATURES = (
    "words", "link density", "words before", "link density before", "words after", "link density after", "longest of three before",
    "longest of three after", "furniture", "body", "heading", "sentence end",
)


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES a block. A neighbour in page furniture, or beyond the page, counts as a block
    without words; linked words do not count towards the longest."""
    n = len(blocks)
    x = np.zeros((n, len(FEATURES)))
    if n:
        words = np.array([b.words for b in blocks], float)
        linked = np.array([b.linked for b in blocks], float)
        open_ = ~np.array([b.furniture for b in blocks])
        x[:, 0], x[:, 1] = words, linked / words
        near, density = words * open_, linked / words * open_
        x[1:, 2], x[1:, 3], x[:-1, 4], x[:-1, 5] = near[:-1], density[:-1], near[1:], density[1:]
        plain = (words - linked) * open_
        for step in range(1, min(REACH, n - 1) + 1):
            x[step:, 6] = np.maximum(x[step:, 6], plain[:-step])
            x[:-step, 7] = np.maximum(x[:-step, 7], plain[step:])
        x[:, 8] = ~open_
        x[:, 9] = [b.body for b in blocks]
        x[:, 10] = [b.heading for b in blocks]
        x[:, 11] = [b.text[-1] in ".?!:;…" for b in blocks]
    return x


Node = tuple  # (feature, threshold, at most, above) or (verdict,)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, min_rows: int = 3) -> Node:
    """CART by Gini impurity; of equal splits the first feature and the smallest threshold."""
    if depth == 0 or y.all() or not y.any():
        return (bool(2 * y.sum() >= len(y)),)
    best: tuple | None = None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for t in (values[:-1] + values[1:]) / 2:
            left = x[:, j] <= t
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < min_rows:
                continue
            cost = sum(len(p) * p.mean() * (1 - p.mean()) for p in (a, b))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, j, t)
    if best is None:
        return (bool(2 * y.sum() >= len(y)),)
    _, j, t = best
    left = x[:, j] <= t
    return (j, float(t), grow(x[left], y[left], depth - 1, min_rows), grow(x[~left], y[~left], depth - 1, min_rows))


@lru_cache(maxsize=1)
def fitted() -> Node:
    pages = [(text_blocks(page), marks) for page, marks in LABELLED] + [layout(line) for line in LAYOUTS.split("\n") if line]
    for blocks, marks in pages:
        if len(blocks) != len(marks):
            raise ValueError(f"{len(marks)} marks for the blocks {[b.text for b in blocks]}")
    x = np.concatenate([features(blocks) for blocks, _ in pages])
    y = np.array([m == "+" for _, marks in pages for m in marks])
    return grow(x, y)


def verdicts(tree: Node, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    j, t, low, high = tree
    left = x[:, j] <= t
    out = np.empty(len(x), bool)
    out[left] = verdicts(low, x[left])
    out[~left] = verdicts(high, x[~left])
    return out


def main_text(page: str | None) -> str:
    blocks = text_blocks(page or "")
    keep = verdicts(fitted(), features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")

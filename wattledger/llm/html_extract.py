"""Main text of web pages: flat text blocks, judged by a decision tree over them and their neighbours."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm._shared import table

# Elements by what they are for.
DROPPED = frozenset("script style noscript template svg math iframe object select option textarea button head title canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements a head may hold (those read as one token aside), and those in foreign ones that hold html.
HEAD_ONLY = frozenset("html head base basefont bgsound link meta noframes".split())
FOREIGN = frozenset("svg math".split())
INTEGRATION = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
SPACING = frozenset("br td th img".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = frozenset("nav footer aside form menu dialog search fieldset".split())
ARTICLES = frozenset("article main".split())
# Words in class, id and role that name what a container holds.
BESIDE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead footer foot sidebar aside rail widget widgets complementary "
    "contentinfo related recommended recommendations trending popular share sharing social subscribe subscription newsletter signup "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog comment comments commentlist reply "
    "replies disqus discussion respond pagination pager toolbar login search copyright legal disclaimer teaser teasers skip form".split()
)
ARTICLE_WORDS = frozenset("article content main post entry story articlebody maincontent".split())
HEADER_WORDS = frozenset("header topbar top".split())
# Names that begin so say what a container holds or lacks, not what it is.
HOLDS = frozenset("has with no without".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(?P<raw>script|style|noscript|template|textarea|title|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?>[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    beside: bool
    article: bool
    heading: bool


def _kind(tag: str, rest: str, in_element: bool) -> tuple[bool, bool]:
    """Whether an element stands beside the article, and whether it is one.

    A header belongs to the article only inside an article element: containers named content often hold
    the whole page. The body is neither, whatever its name. Where one name is of article words alone, or the
    element is an article, side words count only in names of side words alone: "content sidebar-left" is a
    wrapper, "content sidebar" and "related-content" stand beside.
    """
    if tag in ("body", "html"):
        return False, False
    names = [[p.lower() for p in PARTS.findall(n)] for _, *v in NAMES.findall(rest) for n in "".join(v).split()] if rest else []
    named = {p for parts in names for p in parts}
    wrapper = tag in ARTICLES or any(parts and ARTICLE_WORDS.issuperset(parts) for parts in names)
    side = any(
        BESIDE_WORDS.issuperset(parts) if wrapper else not BESIDE_WORDS.isdisjoint(parts)
        for parts in names
        if parts and parts[0] not in HOLDS
    )
    beside = tag in BESIDE or side or bool(rest and HIDDEN.search(rest))
    if not in_element:
        beside = beside or tag == "header" or bool(named & HEADER_WORDS and not named & ARTICLE_WORDS)
    return beside, tag in ARTICLES or bool(named & ARTICLE_WORDS)


def _left_open(tokens: list[re.Match]) -> set[int]:
    """The places of dropped elements, and of parts for html in them, that no end tag of their own ends."""
    stack: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    out: set[int] = set()
    for place, token in enumerate(tokens):
        tag = (token["tag"] or "").lower()
        if not tag or tag in VOID or (not token["close"] and token["rest"].endswith("/")):
            continue
        if not token["close"]:
            stack.append((tag, place))
            count[tag] += 1
        elif count[tag]:
            while True:
                name, opened = stack.pop()
                count[name] -= 1
                if name == tag:
                    break
                if name in DROPPED or name in INTEGRATION:
                    out.add(opened)
    return out | {opened for name, opened in stack if name in DROPPED or name in INTEGRATION}


def blocks(page: str) -> list[Block]:
    """The page's texts between block elements, in order. Elements left open end with their parents.

    A head ends where something stands that it cannot hold. Of the other dropped elements, those without an
    end tag end with the next block element, svg and math with any block element that is not in a part of
    theirs for html.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []
    opened: Counter[str] = Counter()
    # Places in the stack of what a block element ends or ends at.
    marks: list[int] = []
    pieces: list[tuple[str, bool]] = []
    beside = article = element = dropped = links = heading = 0

    def flush() -> None:
        text = " ".join("".join(p for p, _ in pieces).split())
        if text:
            linked = sum(len(p.split()) for p, is_link in pieces if is_link)
            out.append(Block(text, len(text.split()), linked, beside > 0, article > 0, heading > 0))
        pieces.clear()

    def pop() -> None:
        nonlocal beside, article, element, dropped, links, heading
        tag, is_beside, is_article, _ = stack.pop()
        opened[tag] -= 1
        if marks and marks[-1] == len(stack):
            marks.pop()
        beside -= is_beside
        article -= is_article
        element -= tag in ARTICLES
        dropped -= tag in DROPPED
        links -= tag == "a"
        heading -= tag in HEADINGS

    def end_dropped() -> None:
        """Before a block element: ends the dropped elements it cannot stand in, and what they hold."""
        low = len(stack)
        for k in reversed(marks):
            name, is_open = stack[k][0], stack[k][3]
            if not (is_open or name in FOREIGN):
                break
            low = k
        while len(stack) > low:
            pop()

    at = 0
    tokens = list(TOKEN.finditer(page))
    left_open = _left_open(tokens)
    for place, token in enumerate(tokens):
        if token.start() > at:
            text = page[at : token.start()]
            if stack and stack[-1][0] == "head" and "<" not in text and text.strip():
                pop()
            if not dropped:
                pieces.append((html.unescape(text), links > 0))
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag not in HEAD_ONLY and not token["close"] and stack and stack[-1][0] == "head":
            pop()
        if tag in BLOCKS and not token["close"] and dropped:
            end_dropped()
        if tag in SPACING:
            pieces.append((" ", False))
        if tag in BLOCKS:
            flush()
            while stack and stack[-1][0] == "a":
                pop()
        if token["close"]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID or token["rest"].endswith("/"):
            continue
        if tag in CLOSED_BY_SAME and any(s[0] == tag for s in stack[-6:]):
            # Only where nothing but inline elements was opened since.
            k = max(i for i in range(max(0, len(stack) - 6), len(stack)) if stack[i][0] == tag)
            if not any(s[0] in BLOCKS for s in stack[k + 1 :]):
                while len(stack) > k:
                    pop()
        is_beside, is_article = _kind(tag, token["rest"], element > 0)
        if tag in DROPPED or tag in FOREIGN or (tag in INTEGRATION and place not in left_open):
            marks.append(len(stack))
        stack.append((tag, is_beside, is_article, place in left_open))
        opened[tag] += 1
        beside += is_beside
        article += is_article
        element += tag in ARTICLES
        dropped += tag in DROPPED
        links += tag == "a"
        heading += tag in HEADINGS
    if at < len(page):
        if stack and stack[-1][0] == "head" and "<" not in page[at:] and page[at:].strip():
            pop()
        if not dropped:
            pieces.append((html.unescape(page[at:]), links > 0))
    flush()
    return out


FEATURES = (
    "beside", "article", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after",
    "titled", "outside", "inside",
)

#: The share of a page's words from which names of what holds them are borne out.
ENOUGH = 0.02

# A small table of labelled pages. A block is its words, the linked share of them, whether it is a
# heading, whether it stands beside the article and in one, by the names of what holds it, and whether it is main text.
LABELLED = (
    # menu, advert, title, paragraphs long and short, footer
    ((1, 1.0, 0, 1, 0, 0), (1, 1.0, 0, 1, 0, 0), (8, 0.0, 0, 1, 0, 0), (10, 0.0, 1, 0, 1, 1), (80, 0.0, 0, 0, 1, 1),
     (120, 0.0, 0, 0, 1, 1), (1, 0.0, 0, 0, 1, 1), (9, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 0, 1, 1), (45, 0.2, 0, 0, 1, 1),
     (3, 0.0, 0, 0, 1, 1), (7, 0.0, 0, 1, 0, 0)),
    ((2, 1.0, 0, 1, 0, 0), (3, 1.0, 0, 1, 0, 0), (14, 0.0, 0, 1, 0, 0), (2, 0.0, 1, 0, 1, 1), (1, 0.0, 0, 0, 1, 1),
     (15, 0.6, 0, 0, 1, 1), (60, 0.0, 0, 0, 1, 1), (300, 0.02, 0, 0, 1, 1), (4, 1.0, 0, 0, 1, 1), (40, 0.1, 0, 0, 1, 1),
     (14, 0.0, 0, 1, 0, 0)),
    # a short article, a title that is a link, a subheading, a page without advert
    ((3, 1.0, 0, 1, 0, 0), (6, 0.0, 1, 0, 1, 1), (3, 0.0, 0, 0, 1, 1), (5, 0.0, 0, 1, 0, 0)),
    ((2, 1.0, 0, 1, 0, 0), (2, 1.0, 0, 1, 0, 0), (9, 1.0, 1, 0, 1, 1), (60, 0.0, 0, 0, 1, 1), (4, 0.0, 1, 0, 1, 1),
     (25, 0.0, 0, 0, 1, 1), (9, 0.9, 0, 1, 0, 0), (12, 0.0, 0, 1, 0, 0)),
    # text without a title
    ((1, 1.0, 0, 1, 0, 0), (2, 1.0, 0, 1, 0, 0), (55, 0.0, 0, 0, 1, 1), (60, 0.1, 0, 0, 1, 1), (22, 0.0, 0, 0, 1, 1),
     (70, 0.0, 0, 0, 1, 1), (6, 0.2, 0, 1, 0, 0)),
    # lists of links without a name of their own, after the text
    ((2, 1.0, 0, 1, 0, 0), (7, 0.0, 1, 0, 1, 1), (90, 0.0, 0, 0, 1, 1), (30, 0.3, 0, 0, 1, 1), (3, 1.0, 0, 0, 1, 0),
     (4, 1.0, 0, 0, 1, 0), (6, 1.0, 0, 0, 1, 0), (2, 1.0, 0, 0, 1, 0)),
    # a very long article with a short footer
    ((1, 1.0, 0, 1, 0, 0), (2, 1.0, 0, 1, 0, 0), (4, 0.0, 0, 1, 0, 0), (8, 0.0, 1, 0, 1, 1), (1900, 0.0, 0, 0, 1, 1),
     (2, 0.0, 0, 0, 1, 1), (2500, 0.01, 0, 0, 1, 1), (90, 0.0, 0, 0, 1, 1), (6, 0.0, 0, 0, 1, 1), (4, 0.0, 0, 1, 0, 0)),
    # no menu before, no footer after
    ((5, 0.0, 1, 0, 1, 1), (35, 0.0, 0, 0, 1, 1), (48, 0.0, 0, 0, 1, 1), (28, 0.0, 0, 0, 1, 1)),
)
# Pages on which names alone tell what words and links cannot, in the same form.
NAMED = (
    # site name, notice, sharing buttons, a form, side stories, an aside inside the article, readers' comments
    ((1, 0.0, 1, 1, 0, 0), (1, 1.0, 0, 1, 0, 0), (30, 0.0, 0, 1, 0, 0), (6, 0.0, 1, 0, 1, 1), (70, 0.0, 0, 0, 1, 1),
     (1, 0.0, 0, 1, 1, 0), (50, 0.05, 0, 0, 1, 1), (25, 0.0, 0, 1, 1, 0), (1, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 0, 1, 1),
     (4, 0.0, 0, 1, 1, 0), (5, 0.0, 0, 0, 1, 1), (3, 0.0, 1, 1, 0, 0), (90, 0.0, 0, 1, 0, 0), (140, 0.1, 0, 1, 1, 0),
     (60, 0.0, 0, 1, 1, 0), (2, 0.0, 0, 1, 0, 0)),
    # a short article under many comments
    ((3, 0.0, 1, 0, 1, 1), (16, 0.0, 0, 0, 1, 1), (120, 0.0, 0, 1, 1, 0), (200, 0.0, 0, 1, 0, 0), (150, 0.0, 0, 1, 1, 0)),
    # articles alone: one block, short ends
    ((1, 0.0, 0, 0, 1, 1),),
    ((4, 0.0, 0, 0, 1, 1),),
    ((5, 0.0, 1, 0, 1, 1), (4, 0.0, 0, 0, 1, 1)),
    ((30, 0.0, 0, 0, 1, 1), (8, 0.0, 0, 0, 1, 1), (3, 0.0, 0, 0, 1, 1)),
    # short last paragraphs without a footer, footers that are next to nothing of the page, side stories last
    ((1, 1.0, 0, 1, 0, 0), (8, 0.0, 0, 1, 0, 0), (6, 0.0, 1, 0, 1, 1), (40, 0.0, 0, 0, 1, 1), (5, 0.0, 0, 0, 1, 1)),
    ((4, 0.0, 0, 1, 0, 0), (9000, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 0, 1, 1)),
    ((1, 1.0, 0, 1, 0, 0), (7, 0.0, 1, 0, 1, 1), (90000, 0.0, 0, 0, 1, 1), (12, 0.0, 0, 0, 1, 1), (2, 0.0, 0, 1, 0, 0)),
    ((5, 0.0, 1, 0, 1, 1), (50, 0.0, 0, 0, 1, 1), (30, 0.0, 0, 1, 0, 0), (45, 0.0, 0, 1, 0, 0)),
    ((5, 0.0, 1, 0, 1, 1), (50, 0.0, 0, 0, 1, 1), (60, 0.0, 0, 1, 1, 0), (70, 0.0, 0, 1, 1, 0)),
    # text that names place outside the article, and what is left of a page without any
    ((12, 0.0, 0, 1, 0, 0), (8, 0.0, 1, 0, 1, 1), (20, 0.0, 0, 0, 1, 1), (4, 0.0, 0, 0, 0, 0), (6, 1.0, 0, 0, 0, 0)),
    ((4, 0.0, 0, 0, 0, 0), (5, 0.0, 0, 0, 0, 0)),
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 16) -> tuple | float:
    """A tree of (feature, threshold, at most, above), split where impurity falls most; leaves are shares."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= threshold
            parts = [labels[low], labels[~low]]
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in parts)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(threshold), low
    if best is None:
        return share
    _, feature, threshold, low = best
    return feature, threshold, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def decide(tree: tuple | float, row: tuple) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, below, above = tree
        tree = below if row[feature] <= threshold else above
    return tree >= 0.5


def features(found: list[tuple[int, float, bool, bool, bool]]) -> list[tuple]:
    """Of each block of a page: words, linked share, heading, beside and article, with those of its neighbours.

    Beside them stands how far names can be trusted: the shares of the page's unlinked words that are not
    beside an article and that are in one, up to ``ENOUGH``. A missing neighbour has neither words nor links.
    """
    plain = [words * (1 - links) for words, links, *_ in found]
    total = sum(plain) or 1.0
    outside = min(ENOUGH, sum(p for p, b in zip(plain, found, strict=True) if not b[3]) / total)
    inside = min(ENOUGH, sum(p for p, b in zip(plain, found, strict=True) if b[4] and not b[3]) / total)
    around = [(0, 0.0), *(b[:2] for b in found), (0, 0.0)]
    titled, out = False, []
    for k, (words, links, heading, beside, article) in enumerate(found):
        titled = titled or bool(heading)
        out.append((beside, article, heading, words, links, *around[k], *around[k + 2], titled, outside, inside))
    return out


def learned(labelled: tuple = LABELLED, named: tuple = NAMED) -> tuple | float:
    """The tree. All pages are learned as named, with blocks of one and of four times the words, whole and cut
    after each block once there is main text. Those of ``labelled`` are also learned without names, and inside
    wrappers whose names mislead: a side container around all of it, an article around it and its menus."""
    rows, labels = [], []

    def add(page: list[tuple] | tuple, form: tuple | None = None, size: int = 1) -> None:
        rows.extend(features([(b[0] * size, b[1], b[2], *(form or b[3:5])) for b in page]))
        labels.extend(b[5] for b in page)

    for page in labelled + named:
        for size in (1, 4):
            add(page, size=size)
            for end in range(1, len(page)):
                if any(b[5] for b in page[:end]):
                    add(page[:end], size=size)
    for page in labelled:
        for form in ((0, 0), (1, 0), (1, 1)):
            add(page, form)
        # What an article named so holds is main text, but for lists of links.
        add([b for b in page if b[5] or b[1] > 0.5], (0, 1))
    return grow(np.array(rows, float), np.array(labels, float))


def main_text(page: str, tree: tuple | float) -> str:
    found = blocks(page)
    rows = features([(b.words, b.linked / b.words, b.heading, b.beside, b.article) for b in found])
    return "\n".join(b.text for b, row in zip(found, rows, strict=True) if decide(tree, row))


def _extract(tree: tuple | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", tree) for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"]
            )

    return run


def extract(pages: DataFrame, html_col: str = "html", labelled: tuple = LABELLED, named: tuple = NAMED) -> DataFrame:
    """The rows without the html and with ``text`` (replacing a column of that name).

    A page becomes flat blocks of text between block elements; a decision tree keeps those of the
    article by their words and links, those of the blocks before and after, and the names of what they
    stand in, as far as the page's words bear these out. The tree is grown from ``labelled`` and ``named``,
    small tables of pages. Kept blocks are joined by line feeds. Time grows with a page's length alone,
    however deep its elements are nested.
    Null, empty and broken pages give what text they have, an empty one if none. Nothing is shuffled.
    """
    tree = learned(labelled, named)
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    base = pages.select(*kept, F.col(html_col).cast("string").alias("__html"))
    return base.mapInArrow(_extract(tree), base.drop("__html").schema.add("text", "string"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks at every block-level tag. A block has its number of words, the share of
them inside links, and the same two numbers of the block before and after; further what surrounds
it: whether an article or main element is open, whether an element is open that holds no main text
by its name or by a word of its class, id or role, and whether it is a heading. A decision tree,
trained by Spark on the small labelled table below, says which blocks are main text.

Text of a block: character references decoded, white space turned into one blank, trimmed. Blocks
join in page order by one blank; blocks without text are left out. Scripts, styles, comments,
templates and other raw elements are never text.

An element's class, id or role names what it is, word by word. Words of the layout (``no-sidebar``) and
words that also have another sense (``market-share``) do not count, nor does the header of an article.

Cases: null and empty html give an empty text and no block; unclosed and cut-off markup is read as
far as it goes. A page is parsed in one pass, in time and memory that follow its length. Repeated
rows stay; other columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.trees import decide, train_trees

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr"
    # Parts of formulas.
    " math mfrac mi mn mo mover mroot mrow mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|template|noscript|iframe|object|svg|annotation|canvas|textarea|select|title|noembed|noframes|audio|video"
ASIDE = frozenset("nav footer aside menu dialog button fieldset datalist search".split())
# These may also wrap a whole page; an article inside them is not aside.
WRAPPING = frozenset(("header", "form"))
MAIN = frozenset(("article", "main"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words in a class, id or role that mark what is no main text.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments"
    " complementary consent contentinfo cookie cookies copyright disqus footer header hidden login masthead menu modal"
    " nav navbar navigation newsletter notice notices pager pagination paywall popup promo promos promotion related"
    " replies reply search share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription teaser"
    " teasers toolbar widget widgets".split()
)

# These mark no main text only at the start of a name, or after words that tell of the page's parts.
UNSURE_WORDS = frozenset("promotion search share social subscription".split())
PARTS = frozenset("article blog box content entry icons js main page post site social story top bottom".split())
# A name that starts so tells of the layout, not of its element.
LAYOUT = frozenset("has no with without".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
SPLIT_WORDS = re.compile(r"[^a-z]+")
# An article below one of these is a comment or a teaser.
KEPT_ASIDE = frozenset("comment comments disqus related replies reply teaser teasers".split())
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Labelled blocks: words, link share, the same of the block before and after, inside an article,
# inside an element without main text, heading, and whether it is main text.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 12, 0.0, 0, 1, 0, 0),
    (12, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (60, 0.0, 2, 1.0, 8, 0.0, 0, 1, 0, 0), (25, 0.1, 40, 0.0, 0, 0.0, 0, 1, 0, 0),
    (9, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 0), (140, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0, 0), (4, 0.0, 3, 0.5, 20, 0.0, 0, 1, 1, 0),
    (30, 0.0, 50, 0.0, 60, 0.0, 1, 1, 0, 0), (6, 0.6, 50, 0.0, 40, 0.0, 1, 1, 0, 0), (3, 0.0, 70, 0.0, 25, 0.0, 1, 1, 1, 0),
    (2, 1.0, 90, 0.0, 2, 1.0, 1, 1, 0, 0), (18, 0.0, 5, 0.0, 22, 0.0, 1, 1, 0, 0), (200, 0.0, 30, 0.0, 30, 0.0, 1, 1, 0, 0),
    (8, 0.0, 12, 0.0, 90, 0.0, 1, 0, 1, 1), (11, 0.0, 6, 1.0, 120, 0.0, 1, 0, 1, 1), (1, 0.0, 12, 0.0, 30, 0.0, 1, 0, 1, 1),
    (90, 0.0, 8, 0.0, 60, 0.0, 1, 0, 0, 1), (60, 0.0, 90, 0.0, 14, 0.0, 1, 0, 0, 1), (1, 0.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1),
    (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 0, 1), (14, 0.2, 70, 0.0, 3, 0.0, 1, 0, 0, 1), (1, 1.0, 40, 0.0, 60, 0.0, 1, 0, 0, 1),
    (3, 0.0, 2, 1.0, 60, 0.0, 1, 0, 1, 1), (5, 0.0, 1, 1.0, 30, 0.0, 1, 0, 1, 1), (18, 0.0, 60, 0.0, 2, 1.0, 1, 0, 0, 1), (30, 0.0, 50, 0.0, 3, 1.0, 1, 0, 0, 1), (6, 0.0, 80, 0.0, 1, 1.0, 1, 0, 0, 1),
    (9, 0.0, 40, 0.0, 4, 1.0, 1, 0, 0, 1), (3, 0.0, 20, 0.0, 2, 1.0, 1, 0, 0, 1), (18, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1),
    (30, 0.0, 45, 0.0, 1, 1.0, 0, 0, 0, 1), (14, 0.0, 90, 0.0, 4, 1.0, 0, 0, 0, 1), (24, 0.0, 30, 0.1, 3, 1.0, 0, 0, 0, 1),
    (5, 1.0, 60, 0.0, 80, 0.0, 1, 0, 0, 1), (3, 0.7, 10, 0.0, 0, 0.0, 1, 0, 0, 1), (500, 0.02, 0, 0.0, 9, 0.0, 1, 0, 0, 1),
    (30, 0.0, 6, 1.0, 9, 0.0, 1, 0, 0, 1), (22, 0.5, 30, 0.1, 40, 0.0, 1, 0, 0, 1), (7, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0),
    (1, 1.0, 60, 0.0, 1, 1.0, 0, 0, 0, 0), (6, 0.8, 5, 0.9, 7, 0.8, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 4, 0.9, 0, 0.0, 0, 0, 0, 0), (12, 0.9, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (20, 0.7, 40, 0.0, 2, 1.0, 0, 0, 0, 0), (35, 0.8, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 1, 0.0, 0, 0, 0, 0),
    (2, 1.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0), (1, 1.0, 90, 0.0, 0, 0.0, 0, 0, 0, 0), (4, 1.0, 60, 0.0, 60, 0.0, 0, 0, 0, 0),
    (2, 0.0, 70, 0.0, 0, 0.0, 0, 0, 0, 0), (60, 0.0, 2, 1.0, 50, 0.0, 0, 0, 0, 1), (50, 0.0, 60, 0.0, 40, 0.0, 0, 0, 0, 1), (40, 0.05, 50, 0.0, 2, 1.0, 0, 0, 0, 1),
    (18, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 1), (30, 0.1, 10, 0.0, 45, 0.0, 0, 0, 0, 1), (120, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (25, 0.2, 35, 0.0, 30, 0.1, 0, 0, 0, 1), (15, 0.0, 40, 0.0, 25, 0.0, 0, 0, 0, 1), (300, 0.0, 1, 1.0, 5, 0.0, 0, 0, 0, 1),
    (7, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 1), (9, 0.0, 50, 0.0, 45, 0.0, 0, 0, 1, 1), (5, 0.0, 0, 0.0, 90, 0.0, 0, 0, 1, 1),
]
DEPTH = 6


def train(spark: SparkSession, labelled: list[tuple] = LABELLED) -> tuple:
    """The decision tree for blocks."""
    rows = [([float(x) for x in r[:-1]], int(r[-1])) for r in labelled]
    table = spark.createDataFrame(rows, "features array<double>, label int")
    return train_trees(table, "features", "label", trees=1, depth=DEPTH)[0]


def _aside_words(name: str) -> set[str]:
    """Words of one class name, id or role that mark what is no main text."""
    words = [w for w in SPLIT_WORDS.split(CAMEL.sub(" ", name).lower()) if w]
    if not words or words[0] in LAYOUT:
        return set()
    found = ASIDE_WORDS.intersection([*words, *SPLIT_WORDS.split(name.lower())])
    for word in found & UNSURE_WORDS:
        if word in words and not PARTS.issuperset(words[: words.index(word)]):
            found = found - {word}
    return found


def _is_aside(attributes: str, inside: bool = False) -> int:
    """0: no, 1: unless an article opens inside, 2: whatever opens inside. A header ``inside`` an
    article belongs to it."""
    found = set()
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        for name in (a or b or c).split():
            found |= _aside_words(name)
    if inside:
        found.discard("header")
    if not found:
        return 0
    return 1 if KEPT_ASIDE.isdisjoint(found) else 2


def blocks(html: str) -> list[tuple]:
    """(text, words, linked words, in article, in aside, heading) of every block with text."""
    found: list[tuple] = []
    # Open elements: name, article, aside, aside unless an article opens, heading, and how many of
    # the latter asides were open before an article; counts of each are kept beside.
    stack: list[tuple[str, int, int, int, int, int]] = []
    inside = aside = weak = heading = links = 0
    text: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        line = " ".join(htmllib.unescape("".join(text)).split())
        if line:
            found.append((line, line.count(" ") + 1, linked, inside > 0, aside + weak > 0, heading > 0))
        text.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal inside, aside, weak, heading, links
        while len(stack) > to:
            _, a, b, c, d, before = stack.pop()
            inside, aside, weak, heading = inside - a, aside - b, weak - c + before, heading - d
        if not stack:
            links = 0

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            part = html[at : m.start()]
            text.append(part)
            if links:
                linked += len(part.split())
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                links = 0 if m[2] else 1
            continue
        if name == "br":
            text.append(" ")
            continue
        close()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            pop(len(stack) - 1)
        main = name in MAIN
        if name in ASIDE:
            off = 2
        elif name in WRAPPING:
            off = 0 if name == "header" and inside else 1
        else:
            off = 0
        if m[4] and off < 2 and not main and name not in ("html", "body"):
            off = max(off, _is_aside(m[4], inside > 0))
        before = weak if main else 0
        stack.append((name, int(main), int(off == 2), int(off == 1), int(name in HEADING), before))
        inside, aside, heading = inside + main, aside + (off == 2), heading + (name in HEADING)
        weak += (off == 1) - before
    if at < len(html):
        part = html[at:]
        text.append(part)
        if links:
            linked += len(part.split())
    close()
    return found


def main_text(html: str | None, tree) -> str:
    """Main text of one page."""
    if not html:
        return ""
    parts = blocks(html)
    shape = [(0, 0.0)] + [(n, min(1.0, k / n)) for _, n, k, *_ in parts] + [(0, 0.0)]
    kept = []
    for i, (line, _, _, inside, aside, heading) in enumerate(parts):
        values = (*shape[i + 1], *shape[i], *shape[i + 2], inside, aside, heading)
        if decide(tree, values) > 0.5:
            kept.append(line)
    return " ".join(kept)


def extract(pages: DataFrame, tree, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of every page with its main ``text``."""
    source = pages.select(*keep, F.col(html).cast("string").alias("_html"))
    schema = source.drop("_html").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns - 1
            texts = pa.array([main_text(x.as_py(), tree) for x in batch.column(n)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], texts], [*batch.schema.names[:n], "text"])

    return source.mapInArrow(run, schema)

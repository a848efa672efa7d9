"""Main text of web pages: flat text blocks, classified by a decision tree with the help of their neighbours.

A page is cut into blocks of text at every tag that is not inline. A block has a word count, a link density (share of
its words inside links), those of the blocks before and after it, and its place: in an article, in a page that has one,
in a part that is named as not belonging to it (menus, footers, forms, adverts, comments...). A small decision tree
trained on the table below says which blocks are main text.

Nulls and edge cases: a null page counts as empty and has an empty text; unclosed and unknown tags, a page that breaks
off, stray angle brackets and unknown references are read as a browser would, as far as text goes; repeated rows give
repeated results; other columns of the input are not touched.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clientele.llm.common import map_slices, utf8

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?",
    re.DOTALL,
)
#: Elements whose content is no markup; it ends at the next end tag of the same name.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never belong to the main text.
APART = set(
    "nav footer aside form menu dialog select button template svg canvas video audio object head datalist fieldset".split()
)
#: Class names that say what a page has or has not, not what an element is.
STATE = re.compile(r"(?:has|have|no|not|with|without|hide|show)[-_]")
#: Words in class, id or role that name a part outside the main text.
NAMED = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|respond|disqus|side-?bar|widget|menu"
    r"|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookies?|consent|notices?|alert|pop-?up|modal|newsletter"
    r"|subscribe|sign-?up|login|shar(?:e|ing)|social|related|recommended|pagination|pager|copyright|legal|toolbar|search"
    r"|hidden|contentinfo|complementary)(?![a-z])"
)
#: Words that name a part outside the main text only where no article is open.
OUTSIDE = re.compile(r"(?<![a-z])(?:discussions?|feedback|reactions?|talkback|guestbook)(?![a-z])")
#: Elements of running text: inside an article a name sets them apart only if it is such a word, or of an advert.
RUNNING = set("p li dd td h1 h2 h3 h4 h5 h6".split())
QUOTED = set("blockquote pre".split())
SELLING = re.compile(r"(?<![a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|newsletter|subscribe|cookies?|comments?)(?![a-z])")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: The text of a copyright line, of at most so many words.
RIGHTS = re.compile(r"(?:©|\(c\)|copyright)[\s©(c),]*(?:19|20)\d\d|.*\ball rights reserved\b", re.IGNORECASE)
RIGHTS_WORDS = 25
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
HIDDEN = re.compile(r"\bdisplay\s*:\s*none|(?<![\w-])hidden(?![\w-])", re.IGNORECASE)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "has_article", "apart")
#: The labelled blocks: the features in this order, then 1 for main text.
LABELLED = (
    # In an article.
    (120, 0.0, 60, 0.0, 80, 0.0, 1, 1, 0, 1),
    (60, 0.0, 9, 0.0, 4, 0.0, 1, 1, 0, 1),
    (9, 0.0, 12, 1.0, 120, 0.0, 1, 1, 0, 1),
    (5, 0.0, 200, 0.0, 8, 0.2, 1, 1, 0, 1),
    (3, 0.0, 3, 0.0, 3, 0.0, 1, 1, 0, 1),
    (40, 0.3, 30, 0.0, 0, 0.0, 1, 1, 0, 1),
    (8, 0.9, 90, 0.0, 70, 0.0, 1, 1, 0, 1),
    (1, 0.0, 45, 0.0, 0, 0.0, 1, 1, 0, 1),
    (300, 0.05, 0, 0.0, 0, 0.0, 1, 1, 0, 1),
    # In a part of an article that does not belong to it.
    (25, 0.0, 80, 0.0, 5, 0.0, 1, 1, 1, 0),
    (6, 0.5, 140, 0.0, 7, 1.0, 1, 1, 1, 0),
    (70, 0.0, 20, 0.0, 60, 0.0, 1, 1, 1, 0),
    (2, 0.0, 30, 0.0, 30, 0.0, 1, 1, 1, 0),
    # Beside an article.
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 1, 0),
    (2, 1.0, 1, 1.0, 4, 0.0, 0, 1, 1, 0),
    (6, 0.0, 2, 1.0, 10, 0.0, 0, 1, 1, 0),
    (12, 0.1, 90, 0.0, 0, 0.0, 0, 1, 1, 0),
    (50, 0.0, 40, 0.0, 60, 0.0, 0, 1, 1, 0),
    (8, 0.0, 10, 0.0, 100, 0.0, 0, 1, 0, 0),
    (30, 0.0, 5, 1.0, 60, 0.0, 0, 1, 0, 0),
    (15, 0.4, 100, 0.0, 3, 1.0, 0, 1, 0, 0),
    (4, 1.0, 4, 1.0, 80, 0.0, 0, 1, 0, 0),
    (90, 0.0, 150, 0.0, 10, 0.0, 0, 1, 0, 0),
    # In a page without an article element.
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 1),
    (45, 0.1, 4, 0.0, 90, 0.0, 0, 0, 0, 1),
    (25, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 1),
    (18, 0.2, 30, 0.0, 2, 1.0, 0, 0, 0, 1),
    (200, 0.02, 0, 0.0, 1, 1.0, 0, 0, 0, 1),
    (7, 0.0, 40, 0.0, 60, 0.0, 0, 0, 0, 1),
    (5, 0.0, 70, 0.0, 35, 0.1, 0, 0, 0, 1),
    (8, 0.0, 3, 1.0, 80, 0.0, 0, 0, 0, 1),
    (2, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0, 1),
    (1, 0.0, 0, 0.0, 90, 0.0, 0, 0, 0, 1),
    (3, 0.0, 80, 0.0, 45, 0.0, 0, 0, 0, 1),
    (2, 0.0, 40, 0.0, 30, 0.0, 0, 0, 0, 1),
    (4, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1),
    (9, 0.0, 70, 0.0, 0, 0.0, 0, 0, 0, 1),
    (30, 0.5, 40, 0.0, 50, 0.0, 0, 0, 0, 1),
    (25, 0.45, 60, 0.0, 0, 0.0, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 20, 0.0, 0, 0, 0, 0),
    (6, 0.8, 50, 0.0, 5, 0.9, 0, 0, 0, 0),
    (30, 0.9, 20, 1.0, 25, 0.8, 0, 0, 0, 0),
    (60, 0.7, 5, 0.0, 40, 0.0, 0, 0, 0, 0),
    (4, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0),
    (6, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 3, 0.5, 0, 0, 0, 0),
    (90, 0.0, 10, 1.0, 60, 0.0, 0, 0, 1, 0),
    (20, 0.0, 60, 0.0, 10, 1.0, 0, 0, 1, 0),
    (3, 1.0, 4, 1.0, 4, 1.0, 0, 0, 1, 0),
    (7, 0.0, 40, 0.0, 0, 0.0, 0, 0, 1, 0),
    (12, 0.0, 70, 0.0, 60, 0.0, 0, 0, 1, 0),
)


def grown(x: np.ndarray, y: np.ndarray) -> tuple | int:
    """A decision tree by Gini impurity, grown until its leaves are pure: (feature, threshold, below, above) or a class."""
    if len(set(y.tolist())) == 1:
        return int(y[0])
    best: tuple[float, int, float] | None = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= threshold
            cost = sum(2 * part.sum() * (1 - part.mean()) for part in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, float(threshold))
    if best is None:
        return int(y.mean() >= 0.5)
    _, feature, threshold = best
    low = x[:, feature] <= threshold
    return feature, threshold, grown(x[low], y[low]), grown(x[~low], y[~low])


@lru_cache(maxsize=1)
def tree() -> tuple | int:
    rows = np.array(LABELLED, float)
    return grown(rows[:, :-1], rows[:, -1].astype(int))


def is_main(features: tuple) -> bool:
    node = tree()
    while isinstance(node, tuple):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return node == 1


def apart(name: str, attributes: str, in_article: bool) -> int:
    """Does an element stand outside the main text? 2 by its kind or as it is hidden, 1 by its names only."""
    if name in APART or name == "header" and not in_article:
        return 2
    if not attributes or name in ("html", "body", "article", "main"):
        return 0
    if HIDDEN.search(attributes):
        return 2
    if in_article and name in QUOTED:
        return 0
    marks = (y for x in MARKS.findall(attributes) for y in HUMP.sub("-", x.strip("\"'")).lower().replace("_", "-").split())
    return int(any(names_apart(x, in_article, name in RUNNING) for x in marks if not STATE.match(x)))


def names_apart(mark: str, in_article: bool, running: bool) -> bool:
    if in_article and running:
        return bool(NAMED.fullmatch(mark) or SELLING.search(mark))
    return bool(NAMED.search(mark) or not in_article and OUTSIDE.search(mark))


def blocks(page: str) -> list[list]:
    """``[text, words, linked words, in an article, apart]`` of every block with words, in page order.

    An element that only its names set apart is not apart if it holds an article that has most words of the page.
    """
    found: list[list] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: name, opens an article, stands apart
    articles: list[int] = []  # open ones, by number
    named: list[int] = []  # open elements that only their names set apart, by number
    around: list[tuple[int, ...]] = []  # by article: the named elements that it is in
    aside = link = position = names = 0

    def close_last() -> str:
        nonlocal aside
        last, opened, outside = stack.pop()
        if opened:
            articles.pop()
        if outside == 1:
            named.pop()
        aside -= outside == 2
        return last

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            inside = len(html.unescape(" ".join(linked)).split())
            words = text.count(" ") + 1
            rights = not articles and words <= RIGHTS_WORDS and bool(RIGHTS.match(text))
            found.append([text, words, inside, tuple(articles), aside > 0 or rights, tuple(named)])
        parts.clear()
        linked.clear()

    while position < len(page):
        tag = TAG.search(page, position)
        end = tag.start() if tag else len(page)
        if end > position:
            parts.append(page[position:end])
            if link:
                linked.append(parts[-1])
        if not tag:
            break
        position = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        closing, attributes = tag[1] or tag[4], tag[3] or tag[6] or ""
        if name == "a":
            link = 0 if closing else 1
        elif name in INLINE:
            if name in ("br", "img", "wbr") and name != "wbr":
                parts.append(" ")
        else:
            flush()
        if name in VOID or attributes.endswith("/") and name not in RAW and name in ("svg", "path"):
            continue
        if closing:
            if any(x[0] == name for x in stack):
                while True:
                    if close_last() == name:
                        break
        elif name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, position)
            position = close.start() if close else len(page)
        elif name not in INLINE or apart(name, attributes, bool(articles)):
            if name == "p" and stack and stack[-1][0] == "p":  # a paragraph ends at the next one
                close_last()
            opens, outside = name in ("article", "main"), apart(name, attributes, bool(articles))
            stack.append((name, opens, outside))
            if opens:
                articles.append(len(around))
                around.append(tuple(named))
            if outside == 1:
                named.append(names)
                names += 1
            aside += outside == 2
    flush()
    held = main_wrappers(found, around)
    return [[*x[:3], bool(x[3]), x[4] or any(k not in held for k in x[5])] for x in found]


def main_wrappers(found: list[list], around: list[tuple[int, ...]]) -> set[int]:
    """Named elements around the longest article, if it has most of the words that do not stand apart without their names."""
    words = [0] * len(around)
    for _, n, _, articles, hard, named in found:
        for k in articles:
            if not hard and named == around[k]:
                words[k] += n
    if not any(words):
        return set()
    longest = max(range(len(words)), key=words.__getitem__)
    held = set(around[longest])
    total = sum(n for _, n, _, _, hard, named in found if not hard and held.issuperset(named))
    return held if 2 * words[longest] > total else set()


def main_text(page: str) -> str:
    """The blocks that the tree takes for main text, joined by one space.

    Where it takes none, as on a page of a few words, the blocks that neither stand apart nor consist of links are taken.
    """
    found = blocks(page)
    shares = [linked / words for _, words, linked, _, _ in found]
    # Articles count if they have most of the words that do not stand apart.
    main = [(words, article) for _, words, _, article, outside in found if not outside]
    has_article = 2 * sum(words for words, article in main if article) > sum(words for words, _ in main)
    kept = []
    for i, (text, words, _, article, outside) in enumerate(found):
        before = (found[i - 1][1], shares[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], shares[i + 1]) if i + 1 < len(found) else (0, 0.0)
        if is_main((words, shares[i], *before, *after, article and has_article, has_article, outside)):
            kept.append(text)
    if not kept:
        kept = [block[0] for block, share in zip(found, shares, strict=True) if not block[4] and share < 0.5]
    return " ".join(kept)


def main_texts(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """Per row: its keys, ``text`` and ``n_chars`` (code points)."""
    schema = StructType(
        [
            *(StructField(f"key{i}", pages.schema[k].dataType) for i, k in enumerate(keys)),
            StructField("text", StringType()),
        ]
    )

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x.decode("utf-8", "replace")) for x in utf8(rows.column(len(keys)))]
        return pa.record_batch([*rows.columns[: len(keys)], pa.array(texts, pa.string())], names=schema.names)

    rows = pages.select(*(F.col(k).alias(f"key{i}") for i, k in enumerate(keys)), F.col(html_column).alias("html"))
    found = map_slices(rows, schema, work)
    return found.select(
        *(F.col(f"key{i}").alias(k) for i, k in enumerate(keys)), "text", F.length("text").cast("long").alias("n_chars")
    )

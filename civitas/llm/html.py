"""Main text of HTML pages from flat text blocks.

A page is cut into flat blocks of text at block-level tags. Each block has
its number of words and its link density, those of the blocks before and
after it, and where it stands (inside a main element, inside page furniture,
a heading). A decision tree trained on the small labelled table below decides
which blocks are article text.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, table

# markup whose content is never text
DROPPED = "script|style|noscript|template|svg|math|iframe|object|select|textarea|button|title|canvas|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{DROPPED})\b[^>]*(?:(?<=/)>|>(?:.*?)(?:</(?P=raw)\s*>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    # attributes: a quoted value may hold ">"; a quote that never closes or stands elsewhere is a character like others
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S | re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr img input picture source".split())
MAIN = frozenset(("article", "main"))
CONTAINERS = frozenset("article main section div nav header footer aside form menu dialog fieldset details ul ol dl table "
                       "tbody tr td th figure blockquote body center".split())
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
FURNITURE_WORD = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|footer|foot|"
    r"side(?:bar)?|aside|complementary|contentinfo|widget\w*|cookies?|consent|gdpr|notices?|alert|newsletter|subscri\w+|"
    r"signup|login|popup|modal|overlay|related|recommend\w*|share|sharing|social|breadcrumbs?|pag(?:er|ination)|"
    r"comments?|commentlist|replies|reply|respond|discussion|disqus|feedback|copyright|legal|tags?|toolbar|search)(?:$|[^a-z])", re.I)
HEADER_WORD = re.compile(r"(?:^|[^a-z])(?:header|masthead|topbar)(?:$|[^a-z])", re.I)
# tokens that tell of a page's state or filing, not of what the element is: "has-sidebar", "tag-news", "comments-open", "page-with-banner"
STATE_TOKEN = re.compile(r"(?:has|with|without|no|not|is|hide|hides|show|shows|tag|category|cat|format|type|status|js)[-_]+.*", re.I)
STATE_TAIL = re.compile(r"[-_]+(?:has|with|without|no)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|on|off|visible|hidden)$", re.I)
# names that no layout wrapper has; their elements stay furniture whatever they hold
NEVER_TEXT = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|"
    r"comments?|commentlist|replies|reply|respond|discussion|disqus)(?:$|[^a-z])", re.I)
# inside an article a name decides only as a whole token; other names need links to speak with them
ARTICLE_FURNITURE = re.compile(
    r"ads?|advert|advertisement|adsense|ad[-_](?:box|slot|unit|banner|break)|sponsor(?:ed)?|promo|banner|nav|navbar|navigation|sidebar|widget|"
    r"cookies?(?:[-_](?:notice|banner|consent|bar))?|consent|gdpr|notices?|newsletter(?:[-_](?:box|form|signup))?|subscribe|sign[-_]?up|login|popup|"
    r"modal|overlay|related(?:[-_](?:posts?|articles?|stories|links))?|recommend(?:ed|ations)|shar(?:e|ing)(?:[-_](?:bar|buttons?|links|icons))?|"
    r"social(?:[-_](?:bar|buttons?|links|icons|media))?|breadcrumbs?|pager|pagination|(?:\w+[-_])?comments?(?:[-_]\w+)?|commentlist|replies|reply|respond|"
    r"disqus(?:[-_]\w+)?|toolbar|footer|copyright", re.I)
LINKED = 0.5        # link share from which a name of furniture counts inside an article
COMMENT_WORD = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|replies|reply)(?:$|[^a-z])", re.I)
MAIN_WORD = re.compile(r"(?:^|[^a-z])(?:article|articlebody|story|main|(?:post|entry|article|story)[-_]?(?:body|content|text))(?:$|[^a-z])", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "main", "page_main", "furniture", "heading")

# The labelled table: pages as runs of blocks
# (words, share of words in links, inside main, in furniture, heading, label 1 = article text)
LABELLED = (
    # a page with a main element, menu, advert and footer
    ((6, 1.0, 0, 1, 0, 0), (8, 0.0, 0, 1, 0, 0), (7, 0.0, 1, 0, 1, 1), (60, 0.0, 1, 0, 0, 1), (45, 0.02, 1, 0, 0, 1), (9, 0.0, 0, 1, 0, 0)),
    # short paragraphs, a footer as long as they are
    ((1, 1.0, 0, 1, 0, 0), (1, 1.0, 0, 1, 0, 0), (5, 0.0, 1, 0, 1, 1), (3, 0.0, 1, 0, 0, 1), (1, 0.0, 1, 0, 0, 1), (20, 0.0, 0, 1, 0, 0)),
    # a long notice and a sidebar outside the main element
    ((40, 0.05, 0, 1, 0, 0), (8, 0.0, 1, 0, 1, 1), (80, 0.03, 1, 0, 0, 1), (35, 0.1, 0, 1, 0, 0), (25, 0.9, 0, 1, 0, 0)),
    # furniture inside the main element: shared links, related articles, comments
    ((9, 0.0, 1, 0, 1, 1), (70, 0.0, 1, 0, 0, 1), (12, 1.0, 1, 1, 0, 0), (30, 0.0, 1, 1, 0, 0), (4, 0.0, 1, 1, 1, 0), (55, 0.0, 1, 1, 0, 0)),
    # unmarked text outside the main element
    ((15, 0.0, 0, 0, 0, 0), (6, 0.0, 1, 0, 1, 1), (50, 0.0, 1, 0, 0, 1), (10, 0.0, 0, 0, 0, 0), (30, 0.0, 0, 0, 0, 0)),
    # paragraphs and lists of links inside the main element
    ((7, 0.0, 1, 0, 1, 1), (40, 0.2, 1, 0, 0, 1), (9, 1.0, 1, 0, 0, 1), (11, 0.95, 1, 0, 0, 1), (12, 1.0, 1, 0, 0, 1)),
    # main elements with blocks of any length
    ((3, 1.0, 0, 1, 0, 0), (8, 0.0, 1, 0, 1, 1), (1, 0.0, 1, 0, 0, 1), (2, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 0, 0, 1), (5, 0.0, 1, 0, 0, 1),
     (8, 0.0, 1, 0, 0, 1), (13, 0.1, 1, 0, 0, 1), (21, 0.0, 1, 0, 0, 1), (34, 0.2, 1, 0, 0, 1), (55, 0.0, 1, 0, 0, 1), (6, 0.0, 0, 1, 0, 0)),
    ((12, 0.0, 0, 1, 0, 0), (2, 0.0, 1, 0, 1, 1), (90, 0.0, 1, 0, 0, 1), (2, 0.0, 1, 0, 0, 1), (150, 0.05, 1, 0, 0, 1), (1, 0.0, 1, 0, 1, 1),
     (30, 0.0, 1, 0, 0, 1), (4, 0.0, 1, 0, 0, 1), (200, 0.0, 1, 0, 0, 1), (9, 0.25, 1, 0, 0, 1), (22, 0.0, 0, 0, 0, 0), (60, 0.0, 0, 0, 0, 0)),
    ((7, 0.0, 0, 0, 0, 0), (6, 0.0, 1, 0, 1, 1), (5, 0.0, 1, 0, 0, 1), (4, 0.0, 1, 0, 0, 1), (45, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 0, 0, 1),
     (18, 0.0, 1, 0, 0, 1), (75, 0.0, 1, 0, 0, 1), (14, 0.0, 1, 0, 0, 1), (1, 0.0, 1, 0, 0, 1), (40, 0.0, 0, 0, 0, 0), (5, 0.0, 0, 0, 0, 0)),
    # no main element: long text blocks between link lists
    ((4, 1.0, 0, 0, 0, 0), (3, 1.0, 0, 0, 0, 0), (9, 0.0, 0, 0, 1, 1), (70, 0.0, 0, 0, 0, 1), (50, 0.05, 0, 0, 0, 1), (8, 0.7, 0, 0, 0, 0)),
    ((2, 1.0, 0, 1, 0, 0), (12, 0.0, 0, 0, 1, 1), (30, 0.0, 0, 0, 0, 1), (6, 0.0, 0, 0, 0, 1), (25, 0.0, 0, 0, 0, 1), (14, 0.0, 0, 1, 0, 0)),
    ((5, 0.8, 0, 0, 0, 0), (40, 0.0, 0, 0, 0, 1), (3, 0.0, 0, 0, 0, 1), (40, 0.1, 0, 0, 0, 1), (20, 0.9, 0, 0, 0, 0), (60, 0.0, 0, 1, 0, 0)),
    # no main element: unmarked snippets between link lists
    ((4, 1.0, 0, 0, 0, 0), (2, 0.0, 0, 0, 0, 0), (5, 1.0, 0, 0, 0, 0), (50, 0.0, 0, 0, 0, 1), (40, 0.0, 0, 0, 0, 1), (3, 0.9, 0, 0, 0, 0), (6, 0.0, 0, 0, 0, 0)),
    ((3, 1.0, 0, 0, 0, 0), (35, 0.0, 0, 0, 0, 1), (5, 0.0, 0, 0, 0, 1), (33, 0.0, 0, 0, 0, 1), (4, 1.0, 0, 0, 0, 0), (7, 0.0, 0, 0, 0, 0), (5, 1.0, 0, 0, 0, 0)),
    # no main element: short articles between furniture
    ((4, 1.0, 0, 1, 0, 0), (1, 0.0, 0, 0, 1, 1), (14, 0.0, 0, 0, 0, 1), (2, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 1, 0, 0)),
    ((9, 0.0, 0, 1, 0, 0), (4, 0.0, 0, 0, 1, 1), (8, 0.0, 0, 0, 0, 1), (5, 0.0, 0, 0, 0, 1), (12, 0.1, 0, 0, 0, 1), (6, 0.0, 0, 1, 0, 0)),
    ((3, 0.0, 0, 0, 1, 1), (22, 0.0, 0, 0, 0, 1), (4, 0.0, 0, 0, 0, 1)),
    ((2, 1.0, 0, 1, 0, 0), (11, 0.0, 0, 0, 0, 1), (9, 0.0, 0, 0, 0, 1), (16, 0.0, 0, 0, 0, 1), (10, 1.0, 0, 1, 0, 0)),
    # no main element: furniture with text
    ((30, 0.0, 0, 1, 0, 0), (10, 0.0, 0, 0, 1, 1), (55, 0.0, 0, 0, 0, 1), (45, 0.0, 0, 1, 0, 0), (6, 0.0, 0, 1, 1, 0)),
    # a page that is one block, and pages of furniture only
    ((20, 0.0, 0, 0, 0, 1),),
    ((12, 0.0, 1, 0, 0, 1),),
    ((2, 1.0, 0, 0, 0, 0), (3, 1.0, 0, 0, 0, 0), (4, 1.0, 0, 0, 0, 0)),
    ((6, 0.0, 0, 1, 0, 0), (15, 0.5, 0, 1, 0, 0)),
)


def neighbours(blocks: list[tuple]) -> np.ndarray:
    """Feature rows of a page's blocks (words, links, main, furniture, heading).

    At the edges of a page a block is its own neighbour: nothing there tells
    an article that ends the page from one with furniture behind it.
    """
    b = np.array([x[:5] for x in blocks], float).reshape(-1, 5)
    before, after = np.vstack((b[:1, :2], b[:-1, :2])), np.vstack((b[1:, :2], b[-1:, :2]))
    some = np.full(len(b), b[:, 2].max(initial=0))
    return np.column_stack((b[:, 0], b[:, 1], before, after, b[:, 2], some, b[:, 3], b[:, 4]))


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """A CART tree by Gini impurity: (feature, threshold, low branch, high branch) or a label."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() > len(y))
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, k] < cut
            a, b = y[low], y[~low]
            cost = sum(len(p) * p.mean() * (1 - p.mean()) for p in (a, b))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, k, float(cut), low)
    if best is None:
        return int(2 * y.sum() > len(y))
    _, k, cut, low = best
    return k, cut, grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1)


def cut_pages(pages=LABELLED) -> list[list[tuple]]:
    """Every labelled page as it is, and cut off before its first and behind its last block of text, and both."""
    out = []
    for page in pages:
        text = [i for i, b in enumerate(page) if b[5]] or [0, len(page) - 1]
        for first, last in {(0, len(page) - 1), (text[0], len(page) - 1), (0, text[-1]), (text[0], text[-1])}:
            out.append(list(page[first:last + 1]))
    return sorted(out)


@cache
def trained_tree():
    pages = cut_pages()
    return grow_tree(np.vstack([neighbours(page) for page in pages]), np.array([b[5] for page in pages for b in page]))


def verdict(tree, row: np.ndarray) -> int:
    while isinstance(tree, tuple):
        k, cut, low, high = tree
        tree = low if row[k] < cut else high
    return tree


OUTSIDE = ("", False, False, None, False, False, False)


def attribute_values(attrs: str) -> list[str]:
    return [next(filter(None, m.groups()[1:]), "") for m in ATTRIBUTE.finditer(attrs)]


def named_parts(attrs: str) -> list[str]:
    """The tokens of class, id and role, those of a state left out or cut off."""
    out = []
    for value in attribute_values(attrs):
        out.extend(STATE_TAIL.sub("", t) for t in value.split() if not STATE_TOKEN.fullmatch(t))
    return [t for t in out if t]


def is_comment(attrs: str) -> bool:
    return any(COMMENT_WORD.search(t) for t in named_parts(attrs))


def furniture_by_tag(tag: str, in_main: bool) -> bool:
    """Menus, headers, asides and forms; an article's own header is text."""
    return tag in FURNITURE_TAGS and not (tag == "header" and in_main)


def hinted(attrs: str) -> bool:
    """A word of furniture stands somewhere in class, id or role."""
    return any(FURNITURE_WORD.search(t) for t in named_parts(attrs))


def furniture_by_name(tag: str, attrs: str, in_main: bool) -> bool:
    """Sidebars, notices, adverts and comments by their class, id or role."""
    if tag in ("body", *MAIN) and not is_comment(attrs):
        return False
    if in_main:     # "related-work" and "share-price" are titles of sections there
        return any(ARTICLE_FURNITURE.fullmatch(t) for t in named_parts(attrs))
    return any(FURNITURE_WORD.search(t) or HEADER_WORD.search(t) for t in named_parts(attrs))


def is_main(attrs: str) -> bool:
    return any(MAIN_WORD.search(v) for v in attribute_values(attrs))


@dataclass
class Mark:
    """An element that is furniture by its name, and what stands in it."""
    outer: int | None   # the mark around it
    depth: int
    bare: bool          # its name is a word of furniture and nothing else
    firm: bool          # its name is never that of a layout wrapper
    words: int = 0      # unlinked words outside elements that are furniture by their tag
    main: bool = False  # a main element stands in it
    article: bool = False   # text of an article element stands in it
    opens: bool = False     # without it, text of a main element or class would be free


def flat_blocks(page: str) -> list[tuple]:
    """(words, link share, main, furniture, heading, text) of each block in page order.

    A name makes an element furniture only if the article is not inside it:
    layout wrappers are named after what stands beside the article, too.
    """
    blocks, marks, held = marked_blocks(page, frozenset())
    wrappers = layout_wrappers(blocks, marks, held) if marks else frozenset()
    return marked_blocks(page, wrappers)[0] if wrappers else blocks


def layout_wrappers(blocks: list[tuple], marks: dict[int, Mark], held: list[tuple]) -> frozenset[int]:
    """The marks of elements that hold the article, from the outermost inwards.

    These hold a main element; or, where no main block stands free of marks,
    they hold the most words of their depth and an article or over half of the
    page's unlinked words. An element named by a bare word of furniture, such
    as "sidebar", must hold the article or all there is.
    """
    total = loose = 0   # unlinked words of the page, and those outside marks
    free = False        # a main block stands outside marks
    for block, (hard, within, main, in_article) in zip(blocks, held, strict=True):
        n = 0 if hard else round(block[0] * (1 - block[1]))
        total += n
        if within is None:
            loose, free = loose + n, free or bool(n and main)
        elif n:
            mark = marks[within]
            mark.words += n
            mark.article, mark.opens = mark.article or in_article, mark.opens or main
    levels: dict[int, list[int]] = {}
    for k in reversed(marks):  # inner marks first
        mark = marks[k]
        levels.setdefault(mark.depth, []).append(k)
        if mark.outer is not None:
            around = marks[mark.outer]
            around.words, around.article, around.main = around.words + mark.words, around.article or mark.article, around.main or mark.main
    out: set[int] = set()
    for depth in sorted(levels):
        reached = [k for k in reversed(levels[depth]) if marks[k].outer is None or marks[k].outer in out]
        chosen = [k for k in reached if marks[k].main]
        rest = [k for k in reached if not marks[k].main and not marks[k].firm]
        if rest and not chosen and not free:
            k = max(rest, key=lambda k: marks[k].words)
            if marks[k].words and (marks[k].article or (not loose if marks[k].bare else 2 * marks[k].words > total)):
                chosen = [k]
        if not chosen:
            break
        out.update(chosen)
        free = free or any(marks[k].opens for k in chosen)
        inner = {j for j in levels.get(depth + 1, ()) if marks[j].outer in out}
        loose += sum(marks[k].words for k in chosen) - sum(marks[j].words for j in inner)
    return frozenset(out)


def marked_blocks(page: str, wrappers: frozenset[int]) -> tuple[list[tuple], dict[int, Mark], list[tuple]]:
    """The blocks; the elements marked by name, known by their place in the page, but for ``wrappers``; and of each
    block: furniture by a tag, the innermost mark, in a main element or class whatever the marks, in an article."""
    blocks, parts, linked, held = [], [], [], []
    marks: dict[int, Mark] = {}
    # container, main, furniture by tag, innermost mark, main whatever the marks, in an article, name of furniture in an article
    stack: list[tuple[str, bool, bool, int | None, bool, bool, bool]] = []
    opened: dict[str, int] = {}
    links, heading, own, at = 0, False, (False, None, False), 0

    def flush():
        words = entities.unescape("".join(parts)).split()
        if words:
            n = len(entities.unescape("".join(linked)).split())
            _, main, hard, within, any_main, in_article, hint = stack[-1] if stack else OUTSIDE
            hard, within = hard or own[0], within if own[1] is None else own[1]
            hard = hard or ((hint or own[2]) and n >= LINKED * len(words))
            blocks.append((len(words), min(1.0, n / len(words)), int(main), int(hard or within is not None), int(heading), " ".join(words)))
            held.append((hard, within, any_main, in_article))
        parts.clear(), linked.clear()

    def mark(tag, attrs, main, outer, place):
        """The innermost mark within the element."""
        if place in wrappers or not furniture_by_name(tag, attrs, main):
            return outer
        names = [t for t in named_parts(attrs) if FURNITURE_WORD.search(t) or HEADER_WORD.search(t)]
        marks[place] = Mark(outer, 0 if outer is None else marks[outer].depth + 1, any(t.isalpha() for t in names),
                            any(NEVER_TEXT.search(t) for t in names))
        return place

    def text(s):
        if s:
            parts.append(s)
            linked.append(s if links else " ")

    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"]:
                text(" ")
            continue
        if tag == "a":
            links = max(0, links + (-1 if m["end"] else 1))
        if tag in INLINE:
            continue
        if tag == "br":
            text(" ")
            continue
        flush()
        own = (False, None, False)
        if m["end"]:
            heading = False if re.fullmatch("h[1-6]", tag) else heading
            links = 0
            if opened.get(tag):     # it ends with all that was left open in it
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
        elif tag in CONTAINERS:
            _, main, hard, outer, any_main, in_article, hint = stack[-1] if stack else OUTSIDE
            hard = hard or furniture_by_tag(tag, main)
            within = mark(tag, m["attrs"], main, outer, m.start())
            if tag == "main" and within is not None and within == outer and not hard:
                marks[within].main = True
            named_main = not hard and is_main(m["attrs"])
            stack.append((tag, main or tag in MAIN or (named_main and within is None), hard, within, any_main or tag in MAIN or named_main,
                          in_article or (tag == "article" and within == outer), hint or (main and hinted(m["attrs"]))))
            opened[tag] = opened.get(tag, 0) + 1
            heading = False
        else:
            _, main, _, outer, _, _, _ = stack[-1] if stack else OUTSIDE
            # a paragraph or list entry marked by itself
            own = (furniture_by_tag(tag, main), mark(tag, m["attrs"], main, outer, m.start()), main and hinted(m["attrs"]))
            heading = re.fullmatch("h[1-6]", tag) is not None
    tail = page[at:]
    cut = tail.rfind("<")
    text(tail if cut < 0 or not re.match(r"</?[a-zA-Z!]", tail[cut:]) else tail[:cut])  # a tag cut off by the end of the page
    flush()
    return blocks, marks, held


def main_text(page: str | None) -> str:
    blocks = flat_blocks(page or "")
    if not blocks:
        return ""
    tree = trained_tree()
    return " ".join(b[5] for b, row in zip(blocks, neighbours(blocks), strict=True) if verdict(tree, row))


def extract_main_text(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (blocks joined by one space) and ``n_chars`` in place of the markup column.

    Defined cases: NULL and empty markup give an empty text; markup cut off
    anywhere keeps the text before the cut; repeated rows are extracted alike;
    an empty table gives no rows; input columns called text or n_chars are
    replaced.
    """
    @F.pandas_udf("string")
    def extract(column):
        return column.map(main_text, na_action=None)

    short_batches(pages.sparkSession)
    others = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in others], extract(F.coalesce(F.col(f"`{html}`"), F.lit(""))).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_query(spark, sf_dir):
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

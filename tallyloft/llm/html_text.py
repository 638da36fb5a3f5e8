"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element, and each line gets a weight: the length of its text, nothing inside menus, headers,
footers, sidebars, notices, adverts, forms and reader comments or where most of it is links outside an article. Where the page marks an
article, lines within it weigh ``MARKED`` times as much. Over windows of WINDOW lines the weights are summed up. A region begins where the sum
surges above the threshold and ends where it dives to nothing; the threshold is half of the page's highest sum, on pages without a marked
article 86 at most. So the sums pick the region, and the mark only weighs: a teaser marked as article loses to a text twenty times as
long. Then the region is extended over lines that are not boilerplate: to all lines of the marked article if it lies in it, else to
lines of the same container and to those that follow each other without a boilerplate line between, so that headings,
bylines, short paragraphs and what follows an insert stay.

Defined results: a NULL or empty page, and one without content, gives an empty text. Tags left open, truncated or nested wrongly are
closed by the next fitting end tag; scripts, styles and remarks left open run to the end of the page, other elements without text of the
page (a select, a drawing) that are left open are ignored. Character references are decoded once,
after the markup is gone; white space within a block, also no-break space and line-break tags, is one space. Nothing else is dropped
or cut. Ids and other columns are not read; repeated rows are handled each.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 3
THRESHOLD = 86

MARKED = 10

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|[^<>]*>?)|<[!?][^>]*>?", re.S | re.I)

# Elements of HTML, and words in class, id and role that name parts of a page.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mtable mtr mtd semantics".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ARTICLE = frozenset(["article", "main"])
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_TO_THE_END = frozenset(["script", "style"])
_TEXTLESS = frozenset("script style noscript template textarea svg iframe object select title".split())
_OUTSIDE = frozenset("nav header footer aside form button menu dialog head fieldset audio video canvas".split())
_OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
_OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar rail widget widgets related "
    "recommended recommendations share sharing social newsletter subscribe subscription signup login comment comments commentlist respond disqus "
    "replies disclaimer announcement toolbar pagination pager skip hidden".split())
# Of these, words that name such a part in any company; the others only beside words of the next list.
_PLAIN_WORDS = frozenset(
    "adverts advertisement advertising adbox adslot cookie cookies gdpr nav navbar navigation breadcrumb breadcrumbs masthead topbar footer sidebar "
    "newsletter comments commentlist disqus pagination".split())
_PART_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content default desktop fixed form group hint icon icons inline inner item "
    "items large left line link links list main middle mobile module mpu outer page panel post posts reader readers right row section side site slot small "
    "social sticky story stories strip text thread title top unit user users view wrap wrapper zone".split())
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption td th address".split())
# Layouts tell by these that they have, or lack, such a part.
_ABOUT = frozenset("has have with no without".split())
# End tags that HTML lets authors leave out: a new one of the group closes the old.
_CLOSED_BY = {"p": frozenset("p div ul ol dl table section article aside header footer nav form h1 h2 h3 h4 h5 h6 pre blockquote main figure hr".split()),
              "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
              "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]), "head": frozenset(["body"])}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-hidden|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names_a_part(value: str, in_article: bool) -> bool:
    """Whether one class or id names a part that is no article: side-bar, sideBar and sidebar are one.

    All its words must be known, so that market-share or related-work stay; outside an article some words do alone.
    """
    words = [w.lower() for w in _NAME.findall(value)]
    if not words or not _ABOUT.isdisjoint(words):
        return False
    pairs = [a + b for a, b in zip(words, words[1:])]
    if not in_article and not _PLAIN_WORDS.isdisjoint([*words, *pairs]):
        return True
    if "".join(words) in _OUTSIDE_WORDS:
        return True
    known = {w for w in words if w in _OUTSIDE_WORDS} | {w for pair, ws in zip(pairs, zip(words, words[1:])) if pair in _OUTSIDE_WORDS for w in ws}
    return bool(known) and all(w in known or w in _PART_WORDS for w in words)


def _outside(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of an article. Headings are, and so is an article's own header."""
    if tag in _OUTSIDE:
        return not (tag == "header" and in_article)
    if not attributes or tag in ("html", "body") or tag in _ARTICLE:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in _OUTSIDE_ROLES:
            return True
        if name in ("class", "id") and tag not in _HEADING and any(_names_a_part(v, in_article) for v in value.split()):
            return True
    return False


class Line(NamedTuple):
    text: str
    length: int  # of its text, 0 if it is boilerplate
    inside: bool  # an article
    container: int  # number of the element that holds its paragraph


def _lines(page: str) -> tuple[list[Line], bool]:
    """The page's lines, and whether it marks its article."""
    lines: list[Line] = []
    stack: list[tuple[str, bool, int]] = []  # open elements, whether each is outside, and its number
    words: list[str] = []
    depth = {"outside": 0, "article": 0, "link": 0}
    linked = numbered = start = at = 0
    marked = False
    lower, open_ended = page.lower(), set()

    def opened(tag: str, outside: bool) -> None:
        nonlocal numbered
        numbered += 1
        stack.append((tag, outside, numbered))
        depth["outside"] += outside
        depth["article"] += tag in _ARTICLE
        depth["link"] += tag == "a"

    def closed() -> None:
        tag, outside, _ = stack.pop()
        depth["outside"] -= outside
        depth["article"] -= tag in _ARTICLE
        depth["link"] -= tag == "a"

    def flush() -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                inside = not depth["outside"] and depth["article"] > 0
                length = 0 if depth["outside"] else len(text) if inside or linked * 2 <= len(text) else 0
                blocks = [(t, n) for t, _, n in stack[-8:] if t not in _INLINE]
                held = blocks[-2] if len(blocks) > 1 and blocks[-1][0] in _PARAGRAPH else blocks[-1] if blocks and blocks[-1][0] not in _PARAGRAPH else ("", 0)
                lines.append(Line(text, length, inside, held[1]))
            words.clear()
        linked = 0

    while token := _TOKEN.search(page, at):
        at = token.end()
        if token.start() > start:
            text = page[start:token.start()]
            words.append(text)
            if depth["link"]:
                linked += len(text.strip())
        start = at
        if token[2] is None:  # a remark or a declaration
            continue
        tag, attributes = token[2].lower(), token[3]
        if tag in _TEXTLESS:
            if not token[1] and not attributes.endswith("/>"):
                end = lower.find(f"</{tag}", at) if tag not in open_ended else -1
                if end >= 0:
                    closing = lower.find(">", end)
                    start = at = closing + 1 if closing >= 0 else len(page)
                elif tag in _TO_THE_END:
                    start = at = len(page)
                else:
                    open_ended.add(tag)  # there is no end tag from here on
            continue
        outside = not token[1] and _outside(tag, attributes, depth["article"] > 0)
        inline = tag in _INLINE and not outside
        if tag == "br":
            words.append(" ")
            continue
        if inline and tag != "a":
            continue
        if not inline:
            flush()
        if token[1]:
            names = [t for t, _, _ in stack]
            if tag in names:
                # An end tag does not reach out of the article or of a part outside it, unless it is theirs.
                own = len(names) - 1 - names[::-1].index(tag)
                if tag not in ("a", "p", "li") or not any(o or t in _ARTICLE for t, o, _ in stack[own + 1:]):
                    while len(stack) > own:
                        closed()
        elif tag not in _VOID:
            while stack and tag in _CLOSED_BY.get(stack[-1][0], ()):
                closed()
            if not attributes.endswith("/>") or tag == "a":
                opened(tag, outside)
                marked |= tag in _ARTICLE and not depth["outside"]
    words.append(page[start:])
    flush()
    return lines, marked


def lines_of(page: str) -> tuple[list[tuple[str, int]], bool]:
    """Lines with their content length in the part that the page marks, and whether it marks one."""
    lines, marked = _lines(page)
    return [(x.text, x.length if x.inside or not marked else 0) for x in lines], marked


def region(lines: list[Line], marked: bool) -> list[int]:
    """The lines between surge and dive points."""
    weights = [x.length * (MARKED if marked and x.inside else 1) for x in lines] + [0] * WINDOW
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(lines))]
    threshold = max(sums, default=0) // 2 if marked else min(THRESHOLD, max(sums, default=0) // 2)
    found: list[int] = []
    i = 0
    while i < len(lines):
        if sums[i] > threshold:  # surge, of the kind of its heaviest line
            inside = lines[max(range(i, min(i + WINDOW, len(lines))), key=weights.__getitem__)].inside
            while i < len(lines) and sums[i] > 0:  # up to the dive
                if weights[i] and lines[i].inside == inside:
                    found.append(i)
                i += 1
        else:
            i += 1
    return found


def main_text(page: str | None) -> str:
    """The region of highest sums and the lines that belong to it, blocks two line ends apart."""
    lines, marked = _lines(page or "")
    core = region(lines, marked)
    if any(lines[i].inside for i in core):
        kept = {i for i, x in enumerate(lines) if x.length and x.inside}
    else:
        containers = {lines[i].container for i in core}
        kept = set(core) | {i for i, x in enumerate(lines) if x.length and not x.inside and x.container in containers}
        for order in (range(len(lines)), range(len(lines) - 1, -1, -1)):
            joined = False
            for i in order:
                joined = lines[i].length > 0 and not lines[i].inside and (joined or i in kept)
                if joined:
                    kept.add(i)
    return "\n\n".join(lines[i].text for i in sorted(kept))


def extract(page: Column) -> Column:
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype="object")

    return of(page)

"""Main text of web pages by block rules in two passes.

A page becomes blocks: runs of text between tags of block level. The first pass decides what it can from the
block alone: its place (scripts, menus, headers, footers, sidebars, adverts, notices, forms, comments:
never text), the share of its text inside links, its length, and the share of stop words
of several languages. Short blocks, and long ones whose words tell nothing, stay open. In the second pass an
open block takes the label of its nearest neighbours that were decided by their own text, at first inside its own
article; where the two sides disagree at equal distance a heading goes with what follows and any other block
with what precedes. A block of middle length with enough stop words needs only one side to be text.
An article with nothing decided is all text; outside an article what has no decided neighbour is text if the page has
no article.

Null or empty html gives an empty text. Pages are taken whole, unclosed and truncated tags are tolerated, and
repeated pages are treated one by one. The time is linear in the page, however broken it is: open elements are found by
name, an end tag that is missing is looked for once, and after `TOLERATED` tags whose quotes never close
quotes no longer hide a `>`.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from aerolith.llm.common import column, ship_package, whole_row

# Elements by their role.
SKIPPED = frozenset(
    "script style noscript template iframe svg math canvas audio video object head title textarea select".split()
)
RAW = frozenset("script style noscript template iframe svg math textarea title".split())
BOILERPLATE = frozenset("nav footer aside form button menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())
# Words of class, id and role attributes that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar widget "
    "nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "comment comments reply replies disqus related recommended pagination pager skip toolbar complementary "
    "contentinfo search".split()
)
HEADER_MARKS = frozenset(("header", "masthead", "banner"))
# The commonest words of six languages.
STOP_WORDS = frozenset(
    """
a about after all also an and any are as at be because been but by can could did do for from had has have he her
him his how i if in into is it its like more most my no not now of on one only or other our out over she so some
such than that the their them then there these they this to up was we were what when which who will with would you your
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais me ne nous on ou par pas
plus pour qu que qui sa se ses son sont sur un une vous
aber als am auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer er es
für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sich sie sind so und uns von vor war was wenn wie wir
zu zum zur über
al algo como con cual de del donde el ella en entre era es esta este fue ha hay la las lo los me mi muy no nos o para
pero por porque que se ser si sin sobre su sus también tan todo un una y ya
che da dal dei della di e gli ha il io nel non per più quello sono suo tra
ao com da do dos e em foi mais mas na nas no nos não os para pela por quando sem seu sua são também um uma
""".split()
)

MAX_LINK_SHARE = 0.35
SHORT = 70
LONG = 200
TOLERATED = 16
STOP_SHARE = 0.2

TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))""",
    re.DOTALL,
)
BROKEN_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)()()())", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORD = re.compile(r"[^\W\d_]+")
SPACES = re.compile(r"\s+")
WORD_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    excluded: bool  # by its place in the page
    heading: bool
    article: int  # number of the article it lies in, 0 outside
    label: bool | None = None
    leaning: bool = False  # reads like text, but is too short to be sure


class _Open:
    """An element that has not been closed."""

    __slots__ = ("name", "excluded", "article", "heading", "link")

    def __init__(self, name, excluded, article, heading, link):
        self.name, self.excluded, self.article = name, excluded, article
        self.heading, self.link = heading, link


def _set_apart(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is marked as something other than the article."""
    if name in BOILERPLATE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body") or name in ARTICLE:
        return False
    for attribute, value in ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), value.strip("\"'").lower()
        if attribute == "hidden" or (attribute == "aria-hidden" and value == "true"):
            return True
        if attribute == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif attribute in ("class", "id", "role"):
            found = MARKS.intersection(WORD_PARTS.findall(value))
            if found and not (in_article and found <= HEADER_MARKS):
                return True
    return False


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in their order, labels still open."""
    stack = [_Open("", False, 0, False, False)]
    blocks: list[Block] = []
    parts: list[str] = []
    linked = 0
    articles = 0
    open_at: dict[str, list[int]] = {}  # depths of the open elements of a name
    articles_at: list[int] = []
    unended: set[str] = set()  # names of raw elements without another end tag
    pattern, broken = TAG, 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            name = stack.pop().name
            open_at[name].pop()
            if name in ARTICLE:
                articles_at.pop()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                blocks.append(Block(text, linked, top.excluded, top.heading, top.article))
            parts.clear()
            linked = 0

    place = 0
    while place < len(page):
        tag = pattern.search(page, place)
        text = page[place : tag.start() if tag else len(page)]
        if text:
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())
        if not tag:
            break
        place = tag.end()
        name = tag[2] or tag[5]
        if tag[5]:
            broken += 1
            pattern = BROKEN_TAG if broken >= TOLERATED else TAG
        if name is None:
            continue  # comment or declaration
        name = name.lower()
        closing = bool(tag[1] or tag[4])
        attributes = (tag[3] or tag[6] or "").strip()
        if closing:
            if name in BLOCK:
                flush()
            depths = open_at.get(name)
            around = name in ("body", "html", "article", "main")
            # A stray tag inside an article closes nothing around it.
            if depths and (around or not articles_at or articles_at[-1] <= depths[-1]):
                close(depths[-1])
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            # What opens a block ends an open paragraph, and an item the one before it.
            if stack[-1].name == "p" or (name == stack[-1].name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
                close(len(stack) - 1)
            elif any(x.name == "p" for x in stack[-4:]):
                close(open_at["p"][-1])
        if name in RAW:
            end = None if name in unended else re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, place)
            if end is None:
                unended.add(name)
            place = end.end() if end else (len(page) if name in ("script", "style") else place)
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        top = stack[-1]
        if name == "article" and top.excluded and not articles_at:
            # Menus and headers left open end where the article starts.
            close(1)
            top = stack[-1]
        article = top.article
        if name in ARTICLE and not top.excluded and not article:
            articles += 1
            article = articles
        open_at.setdefault(name, []).append(len(stack))
        if name in ARTICLE:
            articles_at.append(len(stack))
        stack.append(
            _Open(
                name,
                top.excluded or name in SKIPPED or _set_apart(name, attributes, bool(article)),
                article,
                name in HEADINGS or (top.heading and name not in BLOCK),
                name == "a" or (top.link and name not in BLOCK),
            )
        )
    flush()
    return blocks


def first_pass(blocks: list[Block]) -> None:
    """Labels what a block's own text decides."""
    for block in blocks:
        size = len(block.text)
        if block.excluded or block.linked > MAX_LINK_SHARE * size or (not block.article and "©" in block.text):
            block.label = False
        elif size >= SHORT:
            words = WORD.findall(block.text.lower())
            stops = sum(word in STOP_WORDS for word in words)
            if words and stops >= STOP_SHARE * len(words):
                block.leaning = True
                if size >= LONG or block.article:
                    block.label = True


def second_pass(blocks: list[Block]) -> None:
    """Open blocks take the label of the nearest decided ones; labels given here are no neighbours."""
    decided_in = {b.article for b in blocks if b.label}
    has_article = any(b.article for b in blocks)
    before: list[tuple[int, bool] | None] = [None] * len(blocks)
    after: list[tuple[int, bool] | None] = [None] * len(blocks)
    for found, order in ((before, range(len(blocks))), (after, range(len(blocks) - 1, -1, -1))):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            block = blocks[i]
            found[i] = last.get(block.article)
            if block.label is not None and not block.excluded:
                last[block.article] = (i, block.label)
    for i, block in enumerate(blocks):
        if block.label is not None:
            continue
        left, right = before[i], after[i]
        if block.article and block.article not in decided_in:
            block.label = True
        elif left is None and right is None:
            block.label = not has_article  # nothing to go by
        elif left is None or right is None:
            block.label = (left or right)[1]
        elif left[1] == right[1] or block.leaning:
            block.label = left[1] or right[1]
        else:
            back, on = i - left[0], right[0] - i
            block.label = right[1] if on < back or (on == back and block.heading) else left[1]


def main_text(page: str | None) -> str:
    """The article's blocks, one per line."""
    blocks = blocks_of(page or "")
    first_pass(blocks)
    second_pass(blocks)
    return "\n".join(block.text for block in blocks if block.label)


@F.pandas_udf(StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def with_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """`doc` (each row as it was) with `text`, its main text."""
    ship_package(pages.sparkSession)
    return pages.select(whole_row(pages).alias("doc"), _main_texts(column(html)).alias("text"))


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return with_text(pages.select("page_id", "url", "html")).select(
        "doc.page_id", "doc.url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
